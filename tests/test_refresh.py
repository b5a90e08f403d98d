"""Change-driven refresh: equal to the full jobs, untouched years keep their files; metrics from stored states."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import gold, states
from tessera.plans import layers, refresh
from tessera.sources import ingest
from tessera.sources.sinks import append_partitioned

TS = dt.datetime(2025, 1, 1)


def add_price(spark, lake, months, run):
    """months: {(year, month): value}"""
    rows = [("f.csv", f"{m:02d}/{y}", float(v), "f.xlsx", f"hash-{run}", TS, f"r{run}", TS + dt.timedelta(days=run), m, y)
            for (y, m), v in months.items()]
    kinds = ", ".join(f"{c} {t}" for c, t in layers.BRONZE_PRICE_CONTRACT.items())
    append_partitioned(spark.createDataFrame(rows, kinds), lake.path("bronze", lake.price_table))


def add_index(spark, lake, months, run, series=433):
    rows = [(dt.date(y, m, 1), v if v is None else float(v), "s", series, "a", "b", "u", f"p-{run}", f"r{run}", TS + dt.timedelta(days=run), y, m)
            for (y, m), v in months.items()]
    kinds = ", ".join(f"{c} {t}" for c, t in layers.BRONZE_INDEX_CONTRACT.items())
    append_partitioned(spark.createDataFrame(rows, kinds), lake.path("bronze", lake.index_table))


def window(first, last, f):
    return {(y, m): f(y, m) for y in range(first, last + 1) for m in range(1, 13)}


def price(y, m):
    return 100 + (y * 37 + m * 11) % 29


def index(y, m):
    return 1 + (y * 5 + m * 7) % 13 / 10


def files(lake, layer, table):
    """{file: time} per year folder"""
    root = lake.path(layer, table)
    out = {}
    for folder, _, names in os.walk(root):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(os.path.basename(folder), {})[n] = os.stat(os.path.join(folder, n)).st_mtime_ns
    return out


def table(spark, lake, layer, name):
    df = lake.read(spark, layer, name)
    cols = sorted(df.columns)
    rounded = [F.round(c, 9).alias(c) if dict(df.dtypes)[c] == "double" else F.col(c) for c in cols]
    return cols, sorted((tuple(r) for r in df.select(*rounded).collect()), key=str)


def full_copy(spark, lake, root):
    """Silver and gold of the same bronze by the full jobs."""
    other = layers.Lakehouse(root)
    for t in (lake.price_table, lake.index_table):
        lake.read(spark, "bronze", t).write.partitionBy("ano", "mes").parquet(other.path("bronze", t))
    layers.run_silver(spark, other, register=False)
    layers.run_gold(spark, other, register=False)
    return other


GOLD = ("boi_ipca", "insights", "analitico")


def assert_equal(spark, lake, root):
    other = full_copy(spark, lake, root)
    for layer, names in (("silver", (lake.price_table, lake.index_table)), ("gold", GOLD)):
        for n in names:
            assert table(spark, lake, layer, n) == table(spark, other, layer, n), n


def test_refresh_equals_the_full_jobs_and_leaves_other_years(spark, tmp_dir):
    lake = layers.Lakehouse(os.path.join(tmp_dir, "lake"))
    add_price(spark, lake, window(2000, 2005, price), 1)
    add_index(spark, lake, window(2000, 2004, index), 1)
    done = refresh.run_refresh(spark, lake, register=False)
    assert done.full and done.gold == (2000, 2001, 2002, 2003, 2004)
    assert_equal(spark, lake, os.path.join(tmp_dir, "full1"))
    assert refresh.run_refresh(spark, lake, register=False) == refresh.Refreshed((), ())

    was = {n: files(lake, "gold", n) for n in GOLD[:2]} | {"silver": files(lake, "silver", lake.price_table)}
    add_price(spark, lake, {(2001, 12): 555, (2001, 3): None or 7}, 2)  # corrections
    add_index(spark, lake, {(2005, 1): 2.5, (2005, 2): None}, 2)  # new months
    done = refresh.run_refresh(spark, lake, register=False)
    assert done == refresh.Refreshed((2001, 2005), (2001, 2002, 2005))  # 2002: its January looks back to December
    assert_equal(spark, lake, os.path.join(tmp_dir, "full2"))
    now = {n: files(lake, "gold", n) for n in GOLD[:2]} | {"silver": files(lake, "silver", lake.price_table)}
    for n, written in (("boi_ipca", {2001, 2005}), ("insights", {2001, 2002, 2005}), ("silver", {2001})):
        kept = {f"ano={y}" for y in range(2000, 2006)} - {f"ano={y}" for y in written}
        assert all(now[n].get(y) == was[n].get(y) for y in kept), n
        assert all(now[n][f"ano={y}"] != was[n].get(f"ano={y}") for y in written), n

    # a second series with more months takes over: gold is written whole
    add_index(spark, lake, window(1999, 2005, lambda y, m: index(m, y)), 3, series=7)
    done = refresh.run_refresh(spark, lake, register=False)
    assert done.full
    assert_equal(spark, lake, os.path.join(tmp_dir, "full3"))


def test_a_stopped_run_is_repeated(spark, tmp_dir, monkeypatch):
    lake = layers.Lakehouse(os.path.join(tmp_dir, "lake"))
    add_price(spark, lake, window(2000, 2002, price), 1)
    add_index(spark, lake, window(2000, 2002, index), 1)
    refresh.run_refresh(spark, lake, register=False)
    add_price(spark, lake, {(2001, 5): 1.5}, 2)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(refresh, "pair_states", stop)
        with pytest.raises(RuntimeError):
            refresh.run_refresh(spark, lake, register=False)
    assert refresh.run_refresh(spark, lake, register=False).silver == (2001,)
    assert_equal(spark, lake, os.path.join(tmp_dir, "full"))


def test_only_written_partitions_are_registered(spark, tmp_dir):
    lake = layers.Lakehouse(os.path.join(tmp_dir, "lake"))
    add_price(spark, lake, window(2000, 2001, price), 1)
    add_index(spark, lake, window(2000, 2001, index), 1)
    try:
        refresh.run_refresh(spark, lake)
        assert spark.table("gold.vw_gold_dashboard").count() == 24
        add_price(spark, lake, window(2002, 2002, price), 2)
        add_index(spark, lake, window(2002, 2002, index), 2)
        os.makedirs(os.path.join(lake.path("silver", lake.price_table), "ano=1900"))  # no run wrote it
        assert not refresh.run_refresh(spark, lake).full
        assert spark.table("gold.vw_gold_dashboard").count() == 36
        parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS silver.{lake.price_table}").collect()]
        assert sorted(parts) == ["ano=2000", "ano=2001", "ano=2002"]
    finally:
        for db in ("gold", "silver"):
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


@pytest.mark.parametrize(
    ("changed", "years", "write", "read"),
    [
        ([2001], [2000, 2001, 2002], [2001, 2002], [2000, 2001, 2002]),
        ([2000], [2000, 2005, 2006], [2000, 2005], [2000, 2005]),  # over a gap
        ([2003], [2000, 2005, 2006], [2005], [2000, 2005]),  # a changed year without rows
        ([2006], [2000, 2005, 2006], [2006], [2005, 2006]),
        ([], [2000], [], []),
        ([2000], [], [], []),
    ],
)
def test_lag_reach(changed, years, write, read):
    assert refresh.lag_reach(changed, years) == (write, read)


def changes(spark, rows):
    return spark.createDataFrame(rows, "k int, variacao_ipca double, variacao_boi double")


def same(a, b):
    a, b = a.first().asDict(), b.first().asDict()
    assert a.keys() == b.keys()
    for c in a:
        assert a[c] == b[c] if a[c] is None or b[c] is None else abs(a[c] - b[c]) <= 1e-9 * max(1, abs(b[c])), c


@pytest.mark.parametrize("shift", [0.0, 1e8])
def test_merged_states_give_the_metrics(spark, shift):
    rows = [(i % 7, shift + (i * 31 % 17) / 3, shift + (i * 13 % 11) / 7) for i in range(200)]
    rows += [(1, None, 5.0), (2, 5.0, None), (9, None, None), (None, 1.0, 2.0)]
    df = changes(spark, rows)
    leaf = states.pair_states(df, ["k"], "variacao_ipca", "variacao_boi")
    assert {r.k: r.n for r in leaf.collect()}[9] == 0
    got, want = states.metrics_from_states(leaf).first(), gold.global_metrics(df).first()
    assert abs(got.correlacao_global - want.correlacao_global) < 1e-6
    assert abs(got.media_ipca_global - want.media_ipca_global) <= 1e-9 * max(1, shift)


@pytest.mark.parametrize("rows", [[], [(1, 2.0, 3.0)], [(1, 2.0, 3.0), (2, 2.0, 4.0)], [(1, None, None)]])
def test_states_of_few_or_constant_rows(spark, rows):
    df = changes(spark, rows)
    same(states.metrics_from_states(states.pair_states(df, ["k"], "variacao_ipca", "variacao_boi")), gold.global_metrics(df))


def test_stored_states_take_corrections(spark, tmp_dir):
    old = changes(spark, [(i % 5, i * 1.5, (i * i) % 7 * 1.0) for i in range(50)])
    new = old.filter("k <> 3").union(changes(spark, [(3, 8.0, 1.0), (4, 1.0, 1.0), (6, 2.5, 9.0)]))
    store = states.StoredStates(spark, tmp_dir + "/states", ["k"])
    assert store.current() is None
    store.update(states.pair_states(old, ["k"], "variacao_ipca", "variacao_boi"))
    part = new.filter("k in (3, 4, 6)")
    store.update(states.pair_states(part, ["k"], "variacao_ipca", "variacao_boi"))
    same(states.metrics_from_states(store.current()), gold.global_metrics(new))

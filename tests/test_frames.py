"""Block/halo windows equal Spark's plain windows (lag, rolling, running sum)."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import panel
from tessera.operators.frames import running_sums, with_lag, with_rolling


def gapped_series(spark, n_series=3, n=150, seed=7):
    rnd = random.Random(seed)
    rows = []
    for s in range(n_series):
        day = dt.date(1990, 1, 1)
        for _ in range(n):
            day = day + dt.timedelta(days=rnd.choice([1, 1, 2, 40, 400]))  # gaps, empty years
            v = None if rnd.random() < 0.1 else round(rnd.uniform(-5, 5), 3)
            rows.append((f"s{s}", day, v))
    return spark.createDataFrame(rows, "series string, data date, valor double")


def as_set(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize(
    "method,block_rows", [("blocks", 1), ("blocks", 3), ("blocks", 7), ("blocks", 4096), ("bucketed", 0)]
)
@pytest.mark.parametrize("by", [[], ["series"]])
def test_lag_equals_plain_lag(spark, method, block_rows, by):
    df = gapped_series(spark)
    if not by:
        df = df.filter(F.col("series") == "s1").drop("series")
    ours = with_lag(df, "data", {"prev": "valor"}, by=by, block_rows=max(block_rows, 1), method=method)
    plain = df.withColumn("prev", F.lag("valor").over(Window.partitionBy(*by).orderBy("data")))
    cols = [*by, "data", "valor", "prev"]
    assert as_set(ours, cols) == as_set(plain, cols)


@pytest.mark.parametrize("block_rows", [2, 5, 4096])
def test_rolling_equals_plain_frame(spark, block_rows):
    df = gapped_series(spark)
    k = 4
    w_plain = Window.partitionBy("series").orderBy("data").rowsBetween(-(k - 1), 0)
    ours = with_rolling(
        df, "data", ["series"], k,
        {"s": lambda w: F.sum("valor").over(w), "n": lambda w: F.count(F.lit(1)).over(w)},
        method="blocks",
        block_rows=block_rows,
    )
    plain = df.withColumn("s", F.sum("valor").over(w_plain)).withColumn("n", F.count(F.lit(1)).over(w_plain))
    cols = ["series", "data", "n"]
    assert as_set(ours, cols) == as_set(plain, cols)
    a = {(r[0], r[1]): r[2] for r in ours.select("series", "data", "s").collect()}
    b = {(r[0], r[1]): r[2] for r in plain.select("series", "data", "s").collect()}
    assert a.keys() == b.keys()
    for key in a:
        assert (a[key] is None and b[key] is None) or a[key] == pytest.approx(b[key], abs=1e-9)


@pytest.mark.parametrize("method", ["window", "bucketed"])
@pytest.mark.parametrize("by", [[], ["series"]])
def test_running_sums_equal_plain(spark, by, method):
    df = gapped_series(spark, n_series=2, n=60)
    if not by:
        df = df.filter(F.col("series") == "s1")
    ours = running_sums(df, "data", {"cum": F.col("valor"), "n": F.lit(1)}, by=by, method=method)
    w = Window.partitionBy(*by).orderBy("data").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("cum", F.sum("valor").over(w)).withColumn("n", F.count(F.lit(1)).over(w).cast("double"))
    a = {(r[0], r[1]): (r[2], r[3]) for r in ours.select("series", "data", "cum", "n").collect()}
    b = {(r[0], r[1]): (r[2], r[3]) for r in plain.select("series", "data", "cum", "n").collect()}
    assert a.keys() == b.keys()
    for key in a:
        assert a[key][1] == b[key][1]
        assert (a[key][0] is None and b[key][0] is None) or a[key][0] == pytest.approx(b[key][0], abs=1e-9)


def null_keyed(spark):
    """A NULL series, and a NULL date in two of the series."""
    df = gapped_series(spark, n_series=3, n=40)
    df = df.withColumn("series", F.nullif(F.col("series"), F.lit("s1")))
    more = spark.createDataFrame([("s0", None, 4.5), (None, None, -1.25)], df.schema)
    return df.union(more)


@pytest.mark.parametrize("method", ["window", "blocks", "bucketed"])
def test_null_series_and_dates_stay(spark, method):
    df = null_keyed(spark)
    w = Window.partitionBy("series").orderBy("data")
    ours = with_lag(df, "data", {"prev": "valor"}, by=["series"], method=method, block_rows=5)
    plain = df.withColumn("prev", F.lag("valor").over(w))
    key = lambda rows: sorted(map(str, rows))
    assert key(map(tuple, ours.collect())) == key(map(tuple, plain.collect()))
    if method == "blocks":
        k = 4
        got = with_rolling(
            df, "data", ["series"], k, {"m": lambda x: F.round(F.avg("_c").over(x), 9)},
            before={"_c": lambda o: F.col("valor") - F.lag("valor").over(o)}, method=method, block_rows=6,
        )
        want = df.withColumn("_c", F.col("valor") - F.lag("valor").over(w))
        want = want.withColumn("m", F.round(F.avg("_c").over(w.rowsBetween(-(k - 1), 0)), 9))
        assert key(map(tuple, got.collect())) == key(map(tuple, want.collect()))
    if method == "bucketed":
        got = running_sums(df, "data", {"s": F.col("valor")}, by=["series"], method=method)
        want = df.withColumn("s", F.sum("valor").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        rounded = lambda d: d.withColumn("s", F.round("s", 6))
        assert key(map(tuple, rounded(got).collect())) == key(map(tuple, rounded(want).collect()))


@pytest.mark.parametrize(
    "operator",
    [
        lambda d, m: panel.moving_avg(d, "valor", 3, by=["series"], method=m),
        lambda d, m: panel.volatility(d, "valor", 4, by=["series"], method=m),
        lambda d, m: panel.accumulate(d, "valor", 3, by=["series"], method=m),
        lambda d, m: panel.rolling_corr(d.withColumn("b", F.col("valor") * 2 + 1), "valor", "b", 5, by=["series"], method=m),
    ],
)
def test_operators_agree_in_both_methods(spark, operator):
    df = null_keyed(spark)
    rows = []
    for method in ("window", "blocks"):
        out = operator(df, method)
        assert out.count() == df.count()
        rows.append(sorted(str((r[0], r[1], None if r[-1] is None else round(r[-1], 6) + 0.0)) for r in out.collect()))
    assert rows[0] == rows[1]


@pytest.mark.parametrize("method", ["window", "bucketed"])
def test_deflate_is_unknown_from_a_gap_on(spark, method):
    rates = [1.0, 2.0, None, 1.0, -100.0, 1.0]
    rows = [("a", dt.date(2020 + i // 2, 1 + i % 2, 1), 10.0, r) for i, r in enumerate(rates)]
    rows += [("b", dt.date(2020, 1, 1), 10.0, 1.0), (None, dt.date(2020, 1, 1), 10.0, -100.0)]
    df = spark.createDataFrame(rows, "s string, data date, p double, r double")
    out = panel.deflate(df, "p", "r", by=["s"], method=method).orderBy("s", "data").collect()
    got = [None if x.indice_acumulado is None else round(x.indice_acumulado, 6) for x in out]
    assert got == [None, 1.01, 1.0302, None, None, None, None, 1.01]


def test_yoy_has_one_match_at_most(spark):
    days = [dt.date(2019, 2, 28), dt.date(2020, 2, 28), dt.date(2020, 2, 29), dt.date(2021, 2, 28), dt.date(2021, 3, 1)]
    rows = [(s, d, float(i + 1)) for s in ("a", None) for i, d in enumerate(days)] + [("a", None, 9.0)]
    df = spark.createDataFrame(rows, "s string, data date, v double")
    out = panel.yoy_change(df, "v", by=["s"])
    got = {(r.s, r.data): r.variacao_12m for r in out.collect()}
    assert out.count() == len(rows)
    for s in ("a", None):
        assert [got[s, d] for d in days] == [None, 100.0, None, 100.0, None]


def test_rollup_keeps_null_dates(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1.0), (None, 5.0)], "data date, v double")
    got = {(r.ano, r.trimestre, r.n_meses, r.media) for r in panel.period_rollup(df, "v").collect()}
    assert got == {(2020, 1, 1, 1.0), (2020, None, 1, 1.0), (None, None, 1, 5.0)}
    assert panel.period_rollup(df, "v").count() == 4  # the NULL year's quarter and its subtotal


def test_lag_offset_two(spark):
    df = gapped_series(spark, n_series=2, n=40)
    ours = with_lag(df, "data", {"p2": "valor"}, by=["series"], offset=2, method="blocks", block_rows=3)
    plain = df.withColumn("p2", F.lag("valor", 2).over(Window.partitionBy("series").orderBy("data")))
    cols = ["series", "data", "p2"]
    assert as_set(ours, cols) == as_set(plain, cols)


def test_bucketed_lag_two_columns(spark):
    df = gapped_series(spark).withColumn("w", F.col("valor") * 2)
    ours = with_lag(df, "data", {"a": "valor", "b": "w"}, by=["series"], method="bucketed")
    w = Window.partitionBy("series").orderBy("data")
    plain = df.withColumn("a", F.lag("valor").over(w)).withColumn("b", F.lag("w").over(w))
    cols = ["series", "data", "a", "b"]
    assert as_set(ours, cols) == as_set(plain, cols)


def test_first_row_lag_is_null_and_gap_bridged(spark):
    df = spark.createDataFrame(
        [(dt.date(2025, 1, 1), 1.0), (dt.date(2025, 3, 1), 3.0)], "data date, valor double"
    )
    got = sorted(tuple(r) for r in with_lag(df, "data", {"prev": "valor"}).collect())
    assert got == [(dt.date(2025, 1, 1), 1.0, None), (dt.date(2025, 3, 1), 3.0, 1.0)]


def test_no_single_partition_over_rows(spark):
    """Raw-grained frames run on (series, bucket); only bounded summaries may be single-partition."""
    df = gapped_series(spark)
    plan = with_lag(df, "data", {"prev": "valor"}, by=["series"], method="bucketed")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan

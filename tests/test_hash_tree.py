"""Hash trees: mergeable states, the changed months, and appends of those only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.sources import hash_tree as H
from tessera.sources import ingest

KEYS = list(H.MONTH_KEYS)


def rows(spark, items, payload="p1"):
    """items: (series, year, month, day, value)"""
    data = [(s, y, m, dt.date(y, m, d) if y else None, v) for s, y, m, d, v in items]
    return spark.createDataFrame(data, "series_id int, ano int, mes int, data_ref date, valor double").withColumn(
        "payload_hash", F.lit(payload)
    )


def window(n=24, **changed):
    """One value per month from 2023 on; ``changed`` maps m<index> to another value."""
    return [(433, 2023 + i // 12, i % 12 + 1, 1, float(changed.get(f"m{i}", i))) for i in range(n)]


def found(df):
    return sorted(((tuple(r[k] for k in KEYS), r.status, r.n_old, r.n_new) for r in df.collect()), key=str)


def leaf(spark, items):
    return H.leaves(rows(spark, items), KEYS, ["data_ref", "valor"])


def test_parents_merge_to_the_payload_hash(spark):
    df = rows(spark, window())
    leaves = H.leaves(df, KEYS, ["data_ref", "valor"])
    root = H.nodes(H.nodes(leaves, KEYS[:2]), []).select(H.node_hash().alias("h")).first().h
    assert root == ingest.payload_hash(df, ["data_ref", "valor"]).first()["payload_hash"]


def test_changed_added_and_removed_months(spark):
    old = leaf(spark, window(24) + [(7, 2023, 1, 1, 1.0), (None, 2023, 1, 1, 1.0)])
    new = leaf(spark, window(25, m3=99)[1:] + [(7, 2023, 1, 1, 1.0), (None, 2023, 1, 1, 2.0), (8, 2024, 2, 1, None)])
    assert found(H.changed_nodes(old, new, KEYS)) == sorted(
        [
            ((433, 2023, 1), "removed", 1, None), ((433, 2023, 4), "changed", 1, 1), ((433, 2025, 1), "added", None, 1),
            ((None, 2023, 1), "changed", 1, 1), ((8, 2024, 2), "added", None, 1),
        ],
        key=str,
    )


def test_equal_versions_differ_in_nothing_and_order_does_not_matter(spark):
    items = window(30)
    assert found(H.changed_nodes(leaf(spark, items), leaf(spark, items[::-1]), KEYS)) == []
    assert found(H.changed_nodes(leaf(spark, items).limit(0), leaf(spark, items).limit(0), KEYS)) == []


def test_only_changed_months_are_appended(spark, tmp_dir):
    target = f"{tmp_dir}/idx"
    put = lambda items, p: H.ingest_payload_changes(spark, rows(spark, items, p), target)
    assert put(window(24), "p1") == 24
    assert put(window(24), "p1") == 0  # the same payload
    assert put(window(24)[::-1], "p2") == 0  # another payload with the same rows
    assert put(window(25, m5=50), "p3") == 2  # one correction, one new month
    table = spark.read.parquet(target)
    assert table.count() == 26
    assert sorted((r.ano, r.mes, r.valor) for r in table.filter("payload_hash = 'p3'").collect()) == [(2023, 6, 50.0), (2025, 1, 24.0)]
    assert put(window(25, m5=50)[1:], "p4") == 0  # a month that went: nothing to append
    assert put(window(25, m5=50), "p5") == 1  # and it is new when it comes back


@pytest.mark.parametrize("step", ["ingest_new", "record", "commit"])
def test_a_stopped_ingest_loses_and_repeats_nothing(spark, tmp_dir, monkeypatch, step):
    target = f"{tmp_dir}/idx"
    H.ingest_payload_changes(spark, rows(spark, window(12)), target)

    def crash(*args, **kw):
        raise RuntimeError("stopped")

    new = rows(spark, window(13, m2=7), "p2")
    with monkeypatch.context() as m:
        m.setattr(*{"ingest_new": (H, step), "record": (H.HashTree, step), "commit": (ingest.HashLedger, step)}[step], crash)
        with pytest.raises(RuntimeError):
            H.ingest_payload_changes(spark, new, target)
    assert H.ingest_payload_changes(spark, new, target) == (2 if step == "ingest_new" else 0)
    assert H.ingest_payload_changes(spark, new, target) == 0
    assert spark.read.parquet(target).filter("payload_hash = 'p2'").count() == 2


def test_rows_without_a_date_are_refused(spark, tmp_dir):
    bad = rows(spark, [(433, None, None, None, 1.0)])
    with pytest.raises(ingest.DataQualityError):
        H.ingest_payload_changes(spark, bad, f"{tmp_dir}/idx")

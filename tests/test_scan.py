"""Prefix scan and prefix moments against plain windows."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import panel
from tessera.operators.frames import frame_sums, running_sums, with_lag
from tessera.operators.scan import range_scan

SCHEMA = "series string, t int, u int, v double, name string"


def events(n, seed, hot=0.5, series=("a", "b", None, "é"), nulls=0.2):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        s = "hot" if r.random() < hot else r.choice(series)
        t = None if r.random() < 0.02 else r.randint(0, n // 2)
        rows.append((s, t, i, None if r.random() < nulls else float(r.randint(-50, 50)), r.choice(["x", "y", None])))
    r.shuffle(rows)
    return rows


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) if isinstance(a, float) else a == b


def assert_equal(found, wanted):
    assert found.columns == wanted.columns
    a, b = ({r.u: r for r in x.collect()} for x in (found, wanted))
    assert a.keys() == b.keys()
    for u in a:
        assert all(same(x, y) for x, y in zip(a[u], b[u])), (a[u], b[u])


def plain(df, by):
    w = Window.partitionBy(*by).orderBy("t", "u")
    return df.withColumns(
        {"pv": F.lag("v").over(w), "pn": F.lag("name").over(w), "total": F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))}
    )


def scanned(df, by):
    return range_scan(df, ["t", "u"], by, {"pv": "v", "pn": "name"}, {"total": F.col("v")})


@pytest.mark.parametrize("by", [["series"], []])
@pytest.mark.parametrize("batch", [3, 10_000])
def test_scan_equals_plain_windows(spark, by, batch):
    df = spark.createDataFrame(events(400, 1), SCHEMA)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        assert_equal(scanned(df, by), plain(df, by))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 60), st.integers(0, 10**6), st.sampled_from([0.0, 1.0]), st.sampled_from([0.0, 0.9, 1.0]))
def test_scan_of_small_random_tables(spark, n, seed, hot, nulls):
    df = spark.createDataFrame(events(n, seed, hot, nulls=nulls), SCHEMA)
    assert_equal(scanned(df, ["series"]), plain(df, ["series"]))


def test_scan_of_an_empty_table_and_of_one_method(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert scanned(df, ["series"]).collect() == []
    one = spark.createDataFrame([("a", i, i, float(i), "x") for i in range(5)], SCHEMA)
    assert_equal(with_lag(one, "t", {"p": "v"}, ["series"], method="scan"), with_lag(one, "t", {"p": "v"}, ["series"]))
    sums = {"s": F.col("v") + 1}
    assert_equal(running_sums(one, "t", sums, ["series"], method="scan"), running_sums(one, "t", sums, ["series"]))
    with pytest.raises(ValueError):
        with_lag(one, "t", {"p": "v"}, offset=2, method="scan")


def test_scan_shuffles_all_rows_once(spark):
    """Only the written copy is read afterwards, and one row per partition is broadcast."""
    df = spark.createDataFrame(events(300, 2), SCHEMA)
    plan = scanned(df, ["series"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    big = plan.split("BroadcastExchange")[0]  # the branch of the rows
    assert "Exchange" not in big


def test_deflate_by_scan_equals_the_window(spark):
    rows = [("a", i, i, 100.0 + i, "x") for i in range(40)] + [("b", i, 100 + i, 5.0, "y") for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rate", F.when(F.col("u") != 104, F.col("t") / 10.0))
    args = dict(price="v", rate="rate", order="t", by=["series"])
    assert_equal(panel.deflate(df, **args, method="scan"), panel.deflate(df, **args))


# ------------------------------------------------------------- prefix moments


def frames(seed, n=300):
    r = random.Random(seed)
    return [
        (r.choice(["a", "b", None]), i, i, None if r.random() < 0.1 else 1000 + r.gauss(0, 10), "x") for i in range(n)
    ]


@pytest.mark.parametrize("k", [1, 2, 7, 50, 250])
def test_frame_sums_equal_a_sliding_frame(spark, k):
    df = spark.createDataFrame(frames(k), SCHEMA)
    w = Window.partitionBy("series").orderBy("t").rowsBetween(-(k - 1), 0)
    wanted = df.withColumns({"s": F.sum("v").over(w), "n": F.count("v").over(w).cast("double")})
    found = frame_sums(df, "t", ["series"], k, {"s": F.col("v"), "n": F.when(F.col("v").isNotNull(), F.lit(1))})
    assert_equal(found.withColumn("n", F.coalesce("n", F.lit(0.0))), wanted)


@pytest.mark.parametrize("k", [2, 12, 50])
def test_moment_methods_equal_the_windows(spark, k):
    df = spark.createDataFrame(frames(9), SCHEMA)
    rate = df.withColumn("rate", F.col("v") / 500 - 1)
    for make in (
        lambda m: panel.moving_avg(df, "v", k, "t", ["series"], out="o", method=m),
        lambda m: panel.volatility(df, "v", k, "t", ["series"], out="o", method=m),
        lambda m: panel.accumulate(rate, "rate", k, "t", ["series"], out="o", method=m),
    ):
        assert_equal(make("moments"), make("window"))


def test_moment_correlation_and_constant_frames(spark):
    r = random.Random(4)
    rows = [("a", i, i, 5.0 if 40 <= i < 80 else r.random() * 100, "x") for i in range(150)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("y", F.sin(F.col("t") * 1.7) + F.col("v") / 50)
    make = lambda m: panel.rolling_corr(df, "v", "y", 12, "t", ["series"], out="o", method=m)
    found, wanted = make("moments"), make("window")
    assert_equal(found, wanted)
    constant = [x.o for x in found.filter("t between 52 and 79").collect()]
    assert constant == [None] * 28

"""Every registered query against its DuckDB oracle (sf0.001), plus plan shape checks."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from table_dirs import SF001
from tessera.plans.registry import ORACLES, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 60
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name].replace("/root/testdata/sf0.01", SF001))
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, srows) == canon(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "media_combinada_global" in df.columns


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_globals_attached_without_cross_join(spark):
    plan = plan_of(E.queries()["analytic"](spark, SF001))
    assert "Subquery" in plan
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_panel_windows_keyed(spark):
    for name in ("panel_pct_change", "moving_avg", "volatility", "yoy_change"):
        plan = plan_of(E.queries()[name](spark, SF001))
        assert "SinglePartition" not in plan, name


def test_dominant_series_broadcasts_one_row(spark):
    plan = plan_of(E.queries()["dominant_series"](spark, SF001))
    assert "TakeOrderedAndProject" in plan or "limit" in plan.lower()
    assert "Broadcast" in plan


def test_scan_prunes_columns(spark):
    df = E.queries()["temporal_join"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<l_discount:double,l_shipdate:timestamp_ntz>" in plan


def exchanges(df):
    """Shuffles and broadcasts of the plan that ran (reused ones are not run again)."""
    plan = plan_of(df).split("== Initial Plan ==")[0]
    return len(re.findall(r"[+:]- (?:Broadcast)?Exchange ", plan))


@pytest.mark.parametrize(
    "name,most",
    [("rolling_corr", 4), ("volatility", 4), ("moving_avg", 4), ("accum_12m", 4), ("panel_corr", 5), ("panel_analytic", 5)],
)
def test_rolling_operators_take_few_exchanges(spark, name, most):
    assert exchanges(QUERIES[name](spark, SF001)) <= most


@pytest.mark.parametrize(
    "name,scans",
    # idempotent_ingest: the arriving documents, and the index of the ledgered ones
    [("layer_counts", 2), ("idempotent_ingest", 2), ("manifest_union", 2), ("hash_exists", 2), ("landing_canonical", 1)],
)
def test_each_table_is_scanned_once_per_branch(spark, name, scans):
    df = QUERIES[name](spark, SF001)
    plan = plan_of(df).split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == scans and "Scan ExistingRDD" not in plan


def test_no_job_runs_while_a_lineage_join_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-lineage", "")
    QUERIES["bronze_lineage"](spark, SF001)
    jobs = tracker.getJobIdsForGroup("build-lineage")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # at most the schema inference of the two tables
    assert len(jobs) <= 2


@pytest.mark.parametrize(
    "name", ["bronze_lineage", "landing_canonical", "silver_conform", "dedupe_latest", "analytic", "bronze_payload"]
)
def test_results_independent_of_session_zone(spark, con, name):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        df = E.queries()[name](spark, SF001)
        srows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert canon(df.columns, srows) == canon(dcols, res.fetchall())


def test_dedupe_and_series_preaggregate_map_side(spark):
    plan = plan_of(E.queries()["dedupe_latest"](spark, SF001))
    assert "partial_max_by" in plan
    plan = plan_of(E.queries()["temporal_join"](spark, SF001))
    assert "partial_sum" in plan and "partial_count" in plan


def test_landing_text_is_parsed_once(spark):
    plan = QUERIES["landing_canonical"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(") + plan.count("cast(translate") <= 8 and plan.count("format_number") <= 8
    parsed = [x for x in plan.split("\n") if "Filter" in x and "regexp_extract" in x]
    assert not parsed


def test_results_unchanged_under_scaled_partitioning(spark, con):
    """Sizing the session for the input (tiny tasks, many partitions) does not change results."""
    from tessera.session import configure, scale_conf

    keep = {k: spark.conf.get(k, None) for k in scale_conf(1, 1)}
    try:
        configure(spark, scale_conf(2 * 1024**2, 16))
        for name in ("analytic", "dedupe_latest", "bronze_lineage", "panel_analytic"):
            df = E.queries()[name](spark, SF001)
            res = con.execute(E.oracle_sql()[name])
            dcols = [d[0] for d in res.description]
            assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(dcols, res.fetchall())
    finally:
        for k, v in keep.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

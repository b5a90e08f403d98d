"""One-write quarantine and the registration of noted partitions."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators.quality import MONTH_TEXT, DataQualityError
from tessera.plans import layers
from tessera.sources import ingest
from tessera.sources.files import load_if_exists
from tessera.sources.sinks import partitions_path, split_write

RUN_TS = dt.datetime(2025, 2, 1)

def rules():
    return {"month": F.col("m").isNull() | ~F.col("m").rlike(MONTH_TEXT), "value": F.col("v") < 0}


def counted(df, calls):
    """``df`` through a task that counts the rows it passes on."""

    def run(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema)


def test_split_is_one_pass_with_reasons(spark, tmp_dir):
    rows = [("01/2025", 1.0), ("1/2025", 1.0), (None, -1.0), ("02/2025", None), ("02/2025", -2.0), ("02/2025", -2.0)]
    calls = spark.sparkContext.accumulator(0)
    df = counted(spark.createDataFrame(rows, "m string, v double"), calls)
    split = split_write(df, os.path.join(tmp_dir, "s"), rules())
    assert calls.value == len(rows)  # computed once: the counts are observed by the write
    assert (split.n_good, split.n_bad, split.broken) == (2, 4, {"month": 2, "value": 3})
    assert sorted(map(tuple, split.good.collect()), key=str) == [("01/2025", 1.0), ("02/2025", None)]
    bad = sorted(((r.m, r.v, tuple(r._reasons)) for r in split.bad.collect()), key=str)
    assert bad == sorted(
        [("1/2025", 1.0, ("month",)), (None, -1.0, ("month", "value")), ("02/2025", -2.0, ("value",)), ("02/2025", -2.0, ("value",))],
        key=str,
    )
    assert calls.value == len(rows)
    plan = split.good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_status" in plan  # the other side's files are not opened


def test_empty_table_and_no_bad_rows(spark, tmp_dir):
    none = spark.createDataFrame([], "m string, v double")
    split = split_write(none, os.path.join(tmp_dir, "a"), rules())
    assert (split.n_good, split.n_bad, split.good.count(), split.bad.count()) == (0, 0, 0, 0)
    one = split_write(spark.createDataFrame([("01/2025", 1.0)], "m string, v double"), os.path.join(tmp_dir, "b"), rules())
    assert (one.n_good, one.n_bad, one.bad.count()) == (1, 0, 0)
    with pytest.raises(ValueError, match="62"):
        split_write(none, os.path.join(tmp_dir, "c"), {str(i): F.lit(False) for i in range(63)})


def bronze(spark, rows):
    raw = spark.createDataFrame(rows, "file_hash string, mes_ano string, valor double")
    return raw.withColumns({"ano": F.try_to_number(F.right("mes_ano", F.lit(4)), F.lit("9999")).cast("int"),
                            "mes": F.try_to_number(F.left("mes_ano", F.lit(2)), F.lit("99")).cast("int")})


def test_bad_rows_are_kept_and_good_ones_go_on(spark, tmp_dir):
    target = os.path.join(tmp_dir, "bronze")
    rows = bronze(spark, [("h", "01/2025", 1.0), ("h", "13/2025", 2.0), (None, "02/2025", 3.0)])
    with pytest.raises(DataQualityError, match="1 row.s. without file_hash, 1 row.s. invalid mes_ano"):
        ingest.ingest_new(rows, None, target)
    assert not os.path.exists(target)
    rejected = ingest.rejected_path(target)
    assert ingest.rejected_rows(spark, rejected) is None
    assert ingest.ingest_new(rows, None, target, rejected=rejected) == 1
    assert [r.valor for r in spark.read.parquet(target).collect()] == [1.0]
    ingest.ingest_new(rows, None, os.path.join(tmp_dir, "again"), rejected=rejected)  # a repeated run
    found = {r.valor: tuple(r._reasons) for r in ingest.rejected_rows(spark, rejected).collect()}
    assert found == {2.0: ("invalid mes_ano",), 3.0: ("without file_hash",)}
    assert ingest.rejected_rows(spark, rejected).count() == 2


def test_written_partitions_are_noted(spark, tmp_dir):
    target = os.path.join(tmp_dir, "bronze")
    bronze(spark, [("h0", "12/2024", 1.0)]).write.partitionBy("ano", "mes").parquet(target)  # from before the notes
    ingest.ingest_new(bronze(spark, [("h", "01/2025", 1.0), ("h", "02/2025", 2.0)]), None, target)
    ingest.ingest_new(bronze(spark, [("g", "02/2025", 1.0)]), None, target)
    noted = load_if_exists(spark, partitions_path(target)).select("ano", "mes").distinct()
    assert sorted(map(tuple, noted.collect())) == [(2024, 12), (2025, 1), (2025, 2)]


def test_validation_adds_noted_partitions_without_a_listing(spark, tmp_dir, monkeypatch):
    lake = layers.Lakehouse(tmp_dir)
    price, index = lake.path("bronze", lake.price_table), lake.path("bronze", lake.index_table)
    price_rows = lambda rows: bronze(spark, rows).withColumns(
        {c: F.lit("x") for c in ("csv_file", "source_file", "ingest_run_id")}
        | {c: F.lit(RUN_TS).cast("timestamp_ntz") for c in ("converted_at_utc", "ingested_at_utc")}
    ).select(*ingest.BRONZE_PRICE_COLUMNS)
    meta = {"source": "s", "series_id": 1, "data_inicial": "a", "data_final": "b", "request_url": "u", "ingest_run_id": "r"}
    payload = lambda d, h: ingest.bronze_from_payload(
        spark.createDataFrame([(d, "0,5")], "data string, valor string"), {**meta, "payload_hash": h}, RUN_TS)
    ingest.ingest_new(price_rows([("h", "01/2025", 1.0)]), None, price)
    ingest.ingest_payload(spark, payload("01/01/2025", "p1"), index)
    for t in (lake.price_table, lake.index_table):
        spark.sql(f"DROP TABLE IF EXISTS bronze.{t}")
    layers.run_validate_bronze(spark, lake)
    ingest.ingest_new(price_rows([("g", "02/2025", 1.0)]), None, price)
    ingest.ingest_payload(spark, payload("01/02/2025", "p2"), index)
    ran = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (ran.append(q), sql(self, q, *a, **k))[1])
    layers.run_validate_bronze(spark, lake)
    assert not any("MSCK" in q or "RECOVER" in q for q in ran)
    for t in (lake.price_table, lake.index_table):
        assert sorted(r.mes for r in spark.table(f"bronze.{t}").collect()) == [1, 2]
        spark.sql(f"DROP TABLE bronze.{t}")

"""Sources, sinks, ingestion, catalog and the streaming landing ingest (S*, J1, J3, Q1-Q3, Q8, Q9)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators.quality import DataQualityError
from tessera.sources import catalog, files, ingest, sinks
from tessera.streaming.landing import stream_landing

RUN_TS = "2025-02-01 00:00:00"


def write_csv(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def landing(tmp, name, rows):
    write_csv(os.path.join(tmp, "csv", name), ["mes_ano,valor", *[f"{m},{v}" for m, v in rows]])


def manifest(tmp, entries):
    lines = ["file_hash,source_file,csv_file,converted_at_utc"]
    lines += [f"{h},{s},{c},2025-01-15T10:00:00Z" for h, s, c in entries]
    write_csv(os.path.join(tmp, "ledger", "manifest.csv"), lines)


def test_canonicalize(spark):
    raw = spark.createDataFrame(
        [("Data", "Valor"), ("1/2025", "1.234,56"), ("02/2025", " 310,5 "), ("13/2025", "1,0"), ("03/2025", "abc")],
        "data_raw string, valor_raw string",
    )
    got = sorted(tuple(r) for r in ingest.canonicalize(raw).collect())
    assert got == [("01/2025", 1234.56), ("02/2025", 310.5)]


def test_failfast_landing(spark, tmp_dir):
    landing(tmp_dir, "bad.csv", [("01/2025", "abc")])
    with pytest.raises(Exception):
        files.read_landing(spark, os.path.join(tmp_dir, "csv", "bad.csv")).collect()


def test_lineage_and_idempotent_ingest(spark, tmp_dir):
    landing(tmp_dir, "a b.csv", [("01/2025", "10.5"), ("02/2025", "11.0")])
    landing(tmp_dir, "orphan.csv", [("03/2025", "12.0")])
    manifest(tmp_dir, [("h1", "a b.xlsx", "a b.csv")])
    rows = files.read_landing(spark, [os.path.join(tmp_dir, "csv", "a b.csv"), os.path.join(tmp_dir, "csv", "orphan.csv")])
    ledger = files.read_manifest(spark, os.path.join(tmp_dir, "ledger", "manifest.csv"))
    bronze = ingest.with_lineage(rows, ledger, "run-1", run_ts=RUN_TS)
    assert tuple(bronze.columns) == ingest.BRONZE_PRICE_COLUMNS
    got = {r["csv_file"]: r for r in bronze.collect()}
    assert got["a b.csv"]["file_hash"] == "h1"  # percent-encoded path decoded before the join
    assert got["a b.csv"]["converted_at_utc"] == dt.datetime(2025, 1, 15, 10, 0)
    assert got["orphan.csv"]["file_hash"] is None  # kept, lineage NULL

    target = os.path.join(tmp_dir, "bronze")
    with pytest.raises(DataQualityError):  # rows without a hash could never be recognised again
        ingest.ingest_new(bronze, None, target)
    assert not os.path.exists(target)
    listed = ingest.with_lineage(rows, ledger, "run-1", run_ts=RUN_TS, how="inner")
    assert ingest.ingest_new(listed, None, target) == 2
    existing = spark.read.parquet(target)
    assert ingest.ingest_new(listed, existing, target) == 0  # second run appends nothing
    assert spark.read.parquet(target).count() == 2
    assert [d for d in os.listdir(target) if not d.startswith((".", "_"))] == ["ano=2025"]


def test_a_repeated_file_name_has_one_entry(spark):
    rows = spark.createDataFrame([("a.csv", "01/2025", 1.0), ("a.csv", "02/2025", 2.0)], "csv_file string, mes_ano string, valor double")
    led = spark.createDataFrame(
        [("h1", "old.xlsx", "a.csv", "2025-01-01T00:00:00Z"), ("h2", "new.xlsx", "a.csv", "2025-01-02T00:00:00Z")],
        files.MANIFEST_SCHEMA,
    )
    got = ingest.with_lineage(rows, led, "r", run_ts=RUN_TS).collect()
    assert [r["file_hash"] for r in got] == ["h2", "h2"]


def test_the_ingest_winner_is_decided(spark):
    df = spark.createDataFrame([("01/2025", "h", v, f"f{v}") for v in (3.0, 9.0, 1.0)], "mes_ano string, file_hash string, valor double, csv_file string")
    got = [tuple(r) for n in (1, 3) for r in ingest.new_rows(df.repartition(n), None).select("valor", "csv_file").collect()]
    assert got == [(9.0, "f9.0")] * 2


def price_job(spark, tmp, **kw):
    from tessera.plans import layers

    lake = layers.Lakehouse(os.path.join(tmp, "lake"))
    ledger = os.path.join(tmp, "ledger", "manifest.csv")
    return lake, lambda: layers.run_bronze_price(spark, lake, os.path.join(tmp, "csv"), ledger, "r", RUN_TS, **kw)


def bronze_rows(spark, lake):
    return sorted(tuple(r) for r in lake.read(spark, "bronze", lake.price_table).select("mes_ano", "valor", "csv_file", "file_hash").collect())


def test_price_ingest_takes_listed_files_once(spark, tmp_dir):
    from tessera.plans import layers

    for name, month in (("a.csv", "01/2025"), ("b.csv", "02/2025"), ("c.csv", "01/2025")):
        landing(tmp_dir, name, [(month, "1.0"), ("03/2025", "2.0")])
    manifest(tmp_dir, [("h1", "a.xlsx", "a.csv")])
    lake, run = price_job(spark, tmp_dir)
    assert [run(), run(), run()] == [2, 0, 0]
    path = os.path.join(tmp_dir, "ledger", "manifest.csv")
    unlisted = layers.unlisted_files(spark, os.path.join(tmp_dir, "csv"), path)
    assert sorted(r["file_name"] for r in unlisted.collect()) == ["b.csv", "c.csv"]
    with pytest.raises(DataQualityError):
        price_job(spark, tmp_dir, on_unlisted="raise")[1]()
    # a file that is listed later comes in then; the old one is not opened again (it would fail to parse)
    landing(tmp_dir, "a.csv", [("broken", "not a number")])
    manifest(tmp_dir, [("h1", "a.xlsx", "a.csv"), ("h2", "b.xlsx", "b.csv"), ("h3", "c.xlsx", "c.csv")])
    assert [run(), run()] == [4, 0]
    assert len(bronze_rows(spark, lake)) == 6 and {r[3] for r in bronze_rows(spark, lake)} == {"h1", "h2", "h3"}


def test_price_ingest_in_groups_of_files(spark, tmp_dir, monkeypatch):
    from tessera.plans import layers

    monkeypatch.setattr(layers, "FILES_PER_APPEND", 2)
    for i in range(5):
        landing(tmp_dir, f"f{i}.csv", [(f"0{i + 1}/2025", "1.0")])
    manifest(tmp_dir, [(f"h{i}", "x", f"f{i}.csv") for i in range(5)])
    lake, run = price_job(spark, tmp_dir)
    assert [run(), run()] == [5, 0] and len(bronze_rows(spark, lake)) == 5


@pytest.mark.parametrize("stop", ["before_append", "after_append"])
def test_a_stopped_price_ingest_loses_and_repeats_nothing(spark, tmp_dir, monkeypatch, stop):
    landing(tmp_dir, "a.csv", [("01/2025", "1.0"), ("02/2025", "2.0")])
    manifest(tmp_dir, [("h1", "a.xlsx", "a.csv")])
    lake, run = price_job(spark, tmp_dir)

    def crash(*args, **kw):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        if stop == "before_append":
            m.setattr(ingest, "append_partitioned", crash)
        else:
            m.setattr(ingest.HashLedger, "commit", crash)
        with pytest.raises(RuntimeError):
            run()
    first = run()
    assert first == (2 if stop == "before_append" else 0)
    assert run() == 0
    assert bronze_rows(spark, lake) == [("01/2025", 1.0, "a.csv", "h1"), ("02/2025", 2.0, "a.csv", "h1")]


def test_a_table_without_a_ledger_is_asked_itself(spark, tmp_dir):
    import shutil

    landing(tmp_dir, "a.csv", [("01/2025", "1.0")])
    manifest(tmp_dir, [("h1", "a.xlsx", "a.csv")])
    lake, run = price_job(spark, tmp_dir)
    assert run() == 1
    target = lake.path("bronze", lake.price_table)
    for name in ("_ingested_hashes", "_ingested_hashes_pending"):
        shutil.rmtree(target + name)
    assert run() == 0


def test_a_damaged_table_is_no_first_run(spark, tmp_dir):
    landing(tmp_dir, "a.csv", [("01/2025", "1.0")])
    manifest(tmp_dir, [("h1", "a.xlsx", "a.csv")])
    lake, run = price_job(spark, tmp_dir)
    target = lake.path("bronze", lake.price_table)
    os.makedirs(target)
    with open(os.path.join(target, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        run()
    assert os.listdir(target) == ["part-0.parquet"]


def test_manifest_strictness(spark, tmp_dir):
    with pytest.raises(files.SourceError):
        files.read_manifest(spark, os.path.join(tmp_dir, "_manifest.csv"))
    missing = os.path.join(tmp_dir, "nope.csv")
    with pytest.raises(files.SourceError):
        files.read_manifest(spark, missing, strict=True)
    assert files.read_manifest(spark, missing, strict=False).count() == 0
    write_csv(missing, ["file_hash,csv_file", "h,a.csv"])
    with pytest.raises(files.SourceError):
        files.read_manifest(spark, missing, strict=True)


def test_append_manifest(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ledger")
    new = spark.createDataFrame([("h1", "a.xls", "a.csv", "2025-01-01T00:00:00Z")], files.MANIFEST_SCHEMA)
    assert sinks.append_manifest(new, path) == 1
    assert sinks.append_manifest(new.limit(0), path) == 0
    assert files.read_manifest(spark, path).count() == 1


def test_payload_ingest(spark, tmp_dir):
    p = os.path.join(tmp_dir, "payload.json")
    with open(p, "w") as f:
        json.dump([{"data": "01/01/2025", "valor": "0,16"}, {"data": "01/02/2025", "valor": "1,31"}], f)
    payload = files.read_payload(spark, p)
    h = ingest.payload_hash(payload, ["data", "valor"]).first()["payload_hash"]
    meta = {"source": "api", "series_id": 433, "data_inicial": "01/01/2025", "data_final": "31/12/2025",
            "request_url": "file:payload", "payload_hash": h, "ingest_run_id": "r1"}
    rows = ingest.bronze_from_payload(payload, meta, run_ts=RUN_TS)
    assert tuple(rows.columns) == ingest.BRONZE_INDEX_COLUMNS
    target = os.path.join(tmp_dir, "bronze_index")
    assert ingest.ingest_payload(spark, rows, target) is True
    assert ingest.ingest_payload(spark, rows, target) is False  # same payload hash: no-op
    got = sorted((r["data_ref"], r["valor"], r["ano"], r["mes"]) for r in spark.read.parquet(target).collect())
    assert got == [(dt.date(2025, 1, 1), 0.16, 2025, 1), (dt.date(2025, 2, 1), 1.31, 2025, 2)]
    empty = os.path.join(tmp_dir, "empty.json")
    with open(empty, "w") as f:
        f.write("[]")
    with pytest.raises(files.SourceError):
        files.read_payload(spark, empty)


def test_payload_hash_order_insensitive(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("a"), (F.col("id") % 7).alias("b"))
    h1 = ingest.payload_hash(df, ["a", "b"]).first()["payload_hash"]
    h2 = ingest.payload_hash(df.orderBy(F.rand(1)).repartition(5), ["b", "a"]).first()["payload_hash"]
    h3 = ingest.payload_hash(df.filter("id > 0"), ["a", "b"]).first()["payload_hash"]
    assert h1 == h2 and h1 != h3


def test_hash_files(spark, tmp_dir):
    landing(tmp_dir, "x y.csv", [("01/2025", "1.0")])
    got = files.hash_files(spark, os.path.join(tmp_dir, "csv"), "*.csv").collect()
    import hashlib
    raw = open(os.path.join(tmp_dir, "csv", "x y.csv"), "rb").read()
    assert [(r["file_name"], r["file_hash"], r["length"]) for r in got] == [
        ("x y.csv", hashlib.sha256(raw).hexdigest(), len(raw))
    ]


def test_catalog_registration(spark, tmp_dir):
    df = spark.createDataFrame([(1.0, 2025, 1), (2.0, 2025, 2)], "valor double, ano int, mes int")
    path = os.path.join(tmp_dir, "tbl")
    sinks.append_partitioned(df, path)
    catalog.ensure_database(spark, "t_bronze", os.path.join(tmp_dir, "db"))
    t = catalog.register_table(spark, "t_bronze.price", path, partitioned=True)
    assert t.count() == 2
    sinks.overwrite_table(df, os.path.join(tmp_dir, "gold"))
    sinks.overwrite_table(df, os.path.join(tmp_dir, "gold"))  # rerun = same content
    catalog.register_table(spark, "t_bronze.gold", os.path.join(tmp_dir, "gold"))
    v = catalog.create_dashboard_view(spark, "t_bronze.vw", "t_bronze.gold")
    assert v.count() == 2
    spark.sql("DROP DATABASE t_bronze CASCADE")


def test_stream_landing_incremental(spark, tmp_dir):
    landing(tmp_dir, "jan.csv", [("01/2025", "10.0"), ("02/2025", "11.0")])
    manifest(tmp_dir, [("h1", "jan.xlsx", "jan.csv"), ("h2", "feb.xlsx", "feb.csv")])
    args = dict(
        landing_dir=os.path.join(tmp_dir, "csv"),
        manifest_path=os.path.join(tmp_dir, "ledger", "manifest.csv"),
        target=os.path.join(tmp_dir, "bronze"),
        checkpoint=os.path.join(tmp_dir, "chk"),
        run_id="run-s",
        run_ts=RUN_TS,
    )
    assert stream_landing(spark, **args) == 2
    landing(tmp_dir, "feb.csv", [("03/2025", "12.0")])
    assert stream_landing(spark, **args) == 1  # only the new file
    assert stream_landing(spark, **args) == 0  # nothing landed
    assert spark.read.parquet(args["target"]).count() == 3
    hashes = sorted(r[0] for r in spark.read.parquet(args["target"] + "_ingested_hashes").collect())
    assert hashes == ["h1", "h2"]
    landing(tmp_dir, "unlisted.csv", [("04/2025", "13.0")])
    assert stream_landing(spark, **args) == 0
    assert spark.read.parquet(args["target"]).count() == 3
    assert [r["csv_file"] for r in spark.read.parquet(args["target"] + "_quarantine").collect()] == ["unlisted.csv"]


def test_raw_pairs_table_and_landing_roundtrip(spark, tmp_dir):
    src = os.path.join(tmp_dir, "raw.txt")
    write_csv(src, ["Data;Valor;extra", "01/2025;1.234,56;x", "02/2025;310,5;y"])
    raw = files.read_raw_pairs(spark, src, sep=";")
    assert raw.columns == ["data_raw", "valor_raw"]
    canon = ingest.canonicalize(raw)
    out = os.path.join(tmp_dir, "landing")
    sinks.write_landing(canon, out)
    back = files.read_landing(spark, out).select("mes_ano", "valor")
    assert sorted(tuple(r) for r in back.collect()) == [("01/2025", 1234.56), ("02/2025", 310.5)]
    sinks.overwrite_table(canon, os.path.join(tmp_dir, "t"), sort_by=["mes_ano"])
    assert files.read_table(spark, os.path.join(tmp_dir, "t")).count() == 2


def test_rebalanced_append_counts_hot_partition(spark, tmp_dir):
    # one month holds most rows: the append still writes everything and reports it
    df = spark.range(3000).select(
        F.lit(2025).alias("ano"), F.when(F.col("id") < 2000, 1).otherwise(F.col("id") % 12 + 1).alias("mes"),
        F.col("id").cast("double").alias("valor"),
    )
    assert sinks.append_partitioned(df, os.path.join(tmp_dir, "hot")) == 3000
    assert spark.read.parquet(os.path.join(tmp_dir, "hot")).count() == 3000


def test_silver_conform_latest_version(spark):
    from tessera.operators.basic import keep_series
    from tessera.operators.silver import silver_index, silver_price

    t1, t2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
    bronze_index = spark.createDataFrame(
        [
            (dt.date(2025, 1, 1), 0.16, "api", 433, "h1", "r1", t1, 2025, 1),
            (dt.date(2025, 1, 1), 0.17, "api", 433, "h2", "r2", t2, 2025, 1),  # re-appended month
            (None, 0.5, "api", 433, "h2", "r2", t2, 2025, 2),  # unparseable date
            (dt.date(2025, 1, 1), 9.0, "api", 7, "h1", "r1", t1, 2025, 1),
        ],
        "data_ref date, valor double, source string, series_id int, payload_hash string, "
        "ingest_run_id string, ingested_at_utc timestamp_ntz, ano int, mes int",
    )
    si = silver_index(bronze_index)
    assert si.columns == ["data", "ano", "mes", "ipca_mensal", "series_id", "source", "payload_hash",
                          "ingest_run_id", "ingested_at_utc"]
    got = sorted((r["series_id"], r["ipca_mensal"]) for r in si.collect())
    assert got == [(7, 9.0), (433, 0.17)]
    assert [r["ipca_mensal"] for r in keep_series(si, "series_id", 433).collect()] == [0.17]

    bronze_price = spark.createDataFrame(
        [("a.csv", "01/2025", 10.0, "a.xlsx", "h1", t1, "r1", t1, 1, 2025),
         ("b.csv", "01/2025", 11.0, "b.xlsx", "h2", t1, "r2", t2, 1, 2025),
         ("b.csv", "13/2025", 12.0, "b.xlsx", "h2", t1, "r2", t2, 13, 2025)],
        "csv_file string, mes_ano string, valor double, source_file string, file_hash string, "
        "converted_at_utc timestamp_ntz, ingest_run_id string, ingested_at_utc timestamp_ntz, mes int, ano int",
    )
    sp = silver_price(bronze_price).collect()
    assert [(r["data"], r["preco_boi_gordo"]) for r in sp] == [(dt.date(2025, 1, 1), 11.0)]


def test_gold_prep_takes_the_latest_version_of_a_month(spark):
    from tessera.operators.silver import gold_prep

    t1, t2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
    price = spark.createDataFrame(
        [(2025, 1, 9.0, t1, "z"), (2025, 1, 0.5, t2, "a"), (2025, 1, 0.25, t2, "A")],
        "ano int, mes int, preco_boi_gordo double, ingested_at_utc timestamp_ntz, file_hash string",
    )
    index = spark.createDataFrame(
        [(2025, 1, 7.0, 433, t1, "h"), (2025, 1, 0.1, 433, t2, "h")],
        "ano int, mes int, ipca_mensal double, series_id int, ingested_at_utc timestamp_ntz, payload_hash string",
    )
    got = [tuple(r) for r in gold_prep(price, index).collect()]
    assert got == [(dt.date(2025, 1, 1), 2025, 1, 0.5, 0.1)]


def test_payload_hash_covers_the_whole_row_hash(spark):
    from tessera.functions.hashing import LIMBS

    assert [a for a, _ in LIMBS] == [1, 16, 31, 46, 61] and sum(n for _, n in LIMBS) == 64

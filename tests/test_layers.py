"""End-to-end layer jobs on files derived from sf0.01: bronze -> silver -> gold."""

import hashlib
import json
import os

from tessera.plans import layers
from tessera.plans.registry import QUERIES
from tessera.plans.series import index_series, price_series

from table_dirs import SF01

RUN_TS = "2025-03-01 00:00:00"


def build_landing(spark, root):
    """Per-year canonical CSVs of the price series + a hashed ledger + an index payload."""
    land = os.path.join(root, "landing")
    os.makedirs(land)
    by_year = {}
    for r in price_series(spark, SF01).collect():
        by_year.setdefault(r["ano"], []).append(f"{r['mes']:02d}/{r['ano']},{r['preco_boi_gordo']!r}")
    ledger = ["file_hash,source_file,csv_file,converted_at_utc"]
    for year, lines in sorted(by_year.items()):
        name = f"boi {year}.csv"  # a space: exercises percent-decoding of file names
        body = ("mes_ano,valor\n" + "\n".join(lines) + "\n").encode()
        with open(os.path.join(land, name), "wb") as f:
            f.write(body)
        ledger.append(f"{hashlib.sha256(body).hexdigest()},boi {year}.xlsx,{name},2025-02-01T12:00:00Z")
    os.makedirs(os.path.join(root, "ledger"))
    manifest = os.path.join(root, "ledger", "manifest.csv")
    with open(manifest, "w") as f:
        f.write("\n".join(ledger) + "\n")
    payload = [
        {"data": r["data"].strftime("%d/%m/%Y"), "valor": repr(r["ipca_mensal"]).replace(".", ",")}
        for r in index_series(spark, SF01).collect()
    ]
    pfile = os.path.join(root, "payload.json")
    with open(pfile, "w") as f:
        json.dump(payload, f)
    return land, manifest, pfile


def test_layer_jobs_end_to_end(spark, tmp_dir):
    land, manifest, pfile = build_landing(spark, tmp_dir)
    lake = layers.Lakehouse(os.path.join(tmp_dir, "lake"))
    meta = {"source": "payload", "series_id": 433, "data_inicial": "01/01/1995", "data_final": "31/12/2001",
            "request_url": "file:payload.json", "ingest_run_id": "r1"}
    try:
        assert layers.run_bronze_price(spark, lake, land, manifest, "r1", RUN_TS) == 80
        assert layers.run_bronze_price(spark, lake, land, manifest, "r2", RUN_TS) == 0  # idempotent
        ledger = spark.read.parquet(lake.path("bronze", lake.price_table) + "_ingested_hashes")
        assert ledger.count() == ledger.distinct().count() == 7  # one hash per landed year file
        assert layers.run_bronze_index(spark, lake, pfile, meta, RUN_TS) is True
        assert layers.run_bronze_index(spark, lake, pfile, meta, RUN_TS) is False
        report = layers.run_validate_bronze(spark, lake)
        assert {r["status"] for r in report.collect()} == {"ok"}
        assert spark.table("bronze.boi_gordo").count() == 80
        assert spark.table("bronze.ipca").count() == 83
        layers.run_silver(spark, lake)
        assert spark.table("silver.boi_gordo").count() == 80
        assert spark.table("silver.ipca").count() == 83
        dash = layers.run_gold(spark, lake)
        assert dash.count() == 80
        assert spark.table("gold.vw_gold_dashboard").count() == 80

        layers.run_silver(spark, lake)  # a rerun rewrites the files under registered tables
        layers.run_gold(spark, lake)
        assert spark.table("gold.vw_gold_dashboard").count() == 80
        got = {r["data"]: r for r in spark.table("gold.analitico").collect()}
        want = {r["data"]: r for r in QUERIES["analytic"](spark, SF01).collect()}
        assert got.keys() == want.keys()
        for d, w in want.items():
            g = got[d]
            for c in ("destaque", "classe_impacto", "ano", "mes"):
                assert g[c] == w[c]
            for c in ("variacao_ipca", "variacao_boi", "correlacao_global", "media_combinada_global"):
                assert (g[c] is None and w[c] is None) or round(g[c], 6) == w[c]
    finally:
        for db in ("gold", "silver", "bronze"):
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_landing_job(spark, tmp_dir):
    """Raw pt-BR sheets -> landing + ledger; copies and re-runs are skipped; bronze lineage is unique."""
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    sheet_a = "Data,Valor\n01/2025,\"1.234,56\"\nData,Valor\n2/2025,\"310,5\"\n13/2025,\"9,9\"\n"
    sheet_b = "Data,Valor\n03/2025,\"1.000,00\"\n"
    for name, body in (("a.csv", sheet_a), ("a copy.csv", sheet_a), ("b.csv", sheet_b)):
        with open(os.path.join(raw, name), "w") as f:
            f.write(body)
    landing = os.path.join(tmp_dir, "landing")
    ledger = os.path.join(tmp_dir, "ledger")
    assert layers.run_landing(spark, raw, landing, ledger, run_ts=RUN_TS) == 2  # copy skipped
    assert layers.run_landing(spark, raw, landing, ledger, run_ts=RUN_TS) == 0  # nothing new
    # b.csv re-landed with new content: same name, new hash
    with open(os.path.join(raw, "b.csv"), "w") as f:
        f.write("Data,Valor\n04/2025,\"7,5\"\n")
    assert layers.run_landing(spark, raw, landing, ledger, run_ts="2025-03-02 00:00:00") == 1
    assert sorted(d for d in os.listdir(landing) if "=" in d) == ["lote=20250301000000", "lote=20250302000000"]

    lake = layers.Lakehouse(os.path.join(tmp_dir, "lake"))
    assert layers.run_bronze_from_landing(spark, lake, landing, ledger, "r1", RUN_TS) == 4
    assert layers.run_bronze_from_landing(spark, lake, landing, ledger, "r2", RUN_TS) == 0
    bronze = lake.read(spark, "bronze", lake.price_table)
    got = sorted((r["mes_ano"], r["valor"], r["csv_file"], r["file_hash"] is not None) for r in bronze.collect())
    assert [g[:3] for g in got] == [  # "a copy.csv" < "a.csv": the first name wins
        ("01/2025", 1234.56, "a copy.csv"), ("02/2025", 310.5, "a copy.csv"),
        ("03/2025", 1000.0, "b.csv"), ("04/2025", 7.5, "b.csv"),
    ]
    assert all(g[3] for g in got)


def test_landing_opens_only_files_it_has_not_seen(spark, tmp_dir, monkeypatch):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    names = ["a [1].csv", "b {x}.csv", "c*.csv", "d.csv", "e.csv"]
    for i, name in enumerate(names):
        with open(os.path.join(raw, name), "w") as f:
            f.write(f"Data,Valor\n0{i + 1}/2025,\"{i},5\"\n")
    landing, ledger = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ledger")
    monkeypatch.setattr(layers, "FILES_PER_APPEND", 2)
    assert layers.run_landing(spark, raw, landing, ledger, run_ts=RUN_TS) == 5
    at = os.stat(os.path.join(raw, "d.csv"))
    with open(os.path.join(raw, "d.csv"), "w") as f:
        f.write("Data,Valor\n09/2025,\"3,5\"\n")  # same length and time: not opened again
    os.utime(os.path.join(raw, "d.csv"), ns=(at.st_atime_ns, at.st_mtime_ns))
    assert layers.run_landing(spark, raw, landing, ledger, run_ts=RUN_TS) == 0
    lake = layers.Lakehouse(os.path.join(tmp_dir, "lake"))
    assert layers.run_bronze_from_landing(spark, lake, landing, ledger, "r", RUN_TS) == 5
    rows = lake.read(spark, "bronze", lake.price_table).collect()
    assert sorted((r["mes_ano"], r["csv_file"]) for r in rows) == [(f"0{i + 1}/2025", n) for i, n in enumerate(names)]


def test_cli_steps(spark, tmp_dir):
    from tessera.__main__ import main

    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    with open(os.path.join(raw, "jan.csv"), "w") as f:
        f.write("Data,Valor\n01/2025,\"10,5\"\n02/2025,\"11,0\"\n")
    root = os.path.join(tmp_dir, "lake")
    landing, ledger = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ledger")
    payload = os.path.join(tmp_dir, "p.json")
    with open(payload, "w") as f:
        json.dump([{"data": "01/01/2025", "valor": "0,16"}, {"data": "01/02/2025", "valor": "1,31"}], f)
    meta = json.dumps({"source": "api", "series_id": 433, "data_inicial": "01/01/2025",
                       "data_final": "31/12/2025", "request_url": "file:p.json"})
    try:
        assert main(["--root", root, "landing", "--raw", raw, "--landing", landing, "--ledger", ledger]) == {"new_files": 1}
        assert main(["--root", root, "bronze-price", "--landing", landing, "--ledger", ledger]) == {"rows": 2}
        assert main(["--root", root, "bronze-index", "--payload", payload, "--meta", meta]) == {"appended": True}
        assert main(["--root", root, "validate-bronze"]) == {"not_ok": []}
        main(["--root", root, "silver"])
        assert main(["--root", root, "gold"]) == {"dashboard_rows": 2}
        assert main(["--root", root, "refresh"]) == {"silver_years": [2025], "gold_years": [2025], "full": True}
        assert main(["--root", root, "refresh"]) == {"silver_years": [], "gold_years": [], "full": False}
    finally:
        for db in ("gold", "silver", "bronze"):
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_landing_then_stream_bronze(spark, tmp_dir):
    from tessera.streaming.landing import stream_landing

    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    with open(os.path.join(raw, "a.csv"), "w") as f:
        f.write("Data,Valor\n01/2025,\"1,5\"\n02/2025,\"2,5\"\n")
    landing, ledger = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ledger")
    assert layers.run_landing(spark, raw, landing, ledger, run_ts=RUN_TS) == 1
    args = dict(landing_dir=landing, manifest_path=ledger, target=os.path.join(tmp_dir, "bronze"),
                checkpoint=os.path.join(tmp_dir, "chk"), run_id="s1", run_ts=RUN_TS, layout="partitioned")
    assert stream_landing(spark, **args) == 2
    with open(os.path.join(raw, "b.csv"), "w") as f:
        f.write("Data,Valor\n03/2025,\"3,5\"\n")
    assert layers.run_landing(spark, raw, landing, ledger, run_ts=RUN_TS) == 1
    assert stream_landing(spark, **args) == 1
    rows = spark.read.parquet(args["target"]).collect()
    assert sorted((r["mes_ano"], r["csv_file"]) for r in rows) == [
        ("01/2025", "a.csv"), ("02/2025", "a.csv"), ("03/2025", "b.csv")]
    assert all(r["file_hash"] and r["source_file"] for r in rows)


def test_stream_takes_a_file_whose_rows_lie_in_several_parts(spark, tmp_dir):
    from tessera.streaming.landing import stream_landing

    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    months = [f"{m:02d}/{y}" for y in range(1990, 2020) for m in range(1, 13)]
    with open(os.path.join(raw, "a.csv"), "w") as f:
        f.write("Data,Valor\n" + "".join(f'{m},"1,5"\n' for m in months))
    landing, ledger = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ledger")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert layers.run_landing(spark, raw, landing, ledger, run_ts=RUN_TS) == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(n.endswith(".csv") for _, _, names in os.walk(landing) for n in names) > 1
    args = dict(landing_dir=landing, manifest_path=ledger, target=os.path.join(tmp_dir, "bronze"), checkpoint=os.path.join(tmp_dir, "chk"),
                run_id="s1", run_ts=RUN_TS, layout="partitioned", max_files_per_trigger=1)
    assert stream_landing(spark, **args) == len(months)
    assert sorted(r["mes_ano"] for r in spark.read.parquet(args["target"]).collect()) == sorted(months)
    assert not os.path.exists(args["target"] + "_quarantine")

"""Layer jobs: bronze ingest -> silver conform -> gold tables and dashboard view.

Each job reads the previous layer from storage and writes its own, so every
layer boundary cuts lineage (a lost executor never forces a recompute from
the landing files) and each job is one short plan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import gold
from tessera.operators.basic import dedupe_earliest
from tessera.operators.joins import new_only
from tessera.operators.quality import DataQualityError, schema_contract
from tessera.operators.silver import gold_prep, silver_index, silver_price
from tessera.session import shared_copy
from tessera.sources import catalog
from tessera.sources.files import (
    MANIFEST_COLUMNS,
    hash_files,
    listed_files,
    literal_path,
    load_if_exists,
    read_landing,
    read_landing_batches,
    read_manifest,
    read_payload,
    read_raw_pairs,
)
from tessera.sources.hash_tree import ingest_payload_changes
from tessera.sources.ingest import (
    HashLedger,
    bronze_from_payload,
    canonicalize,
    current_entries,
    ingest_files,
    ingest_payload,
    rejected_path,
    payload_hash,
    with_lineage,
)
from tessera.sources.sinks import append_manifest, overwrite_table, partitions_path

# New landing files opened by one append; their names are all that the driver holds of them.
FILES_PER_APPEND = 10_000


@dataclass(frozen=True)
class Lakehouse:
    """Where the layers live: ``{root}/{layer}/{table}``."""

    root: str
    fmt: str = "parquet"
    price_table: str = "boi_gordo"
    index_table: str = "ipca"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return spark.read.format(self.fmt).load(self.path(layer, table))

    def exists(self, spark: SparkSession, layer: str, table: str) -> bool:
        return load_if_exists(spark, self.path(layer, table), self.fmt) is not None


def landing_batch(converted_at_utc):
    """Name of the landing run's directory: the digits of its UTC time."""
    return F.regexp_replace(converted_at_utc, "[^0-9]", "")


def run_landing(
    spark: SparkSession,
    raw_path: str,
    landing_root: str,
    ledger_path: str,
    glob: str = "*.csv",
    sep: str = ",",
    run_ts=None,
) -> int:
    """Raw two-column sheets -> canonical landing rows + ledger entries (landing step).

    Raw files that an earlier run has seen (path, length, modification time in
    ``<ledger>_seen``) are not opened.  The others are hashed, in groups of
    :data:`FILES_PER_APPEND`; files whose content hash is in the ledger are
    skipped — a renamed copy too.  Rows of the new files are canonicalized and
    written as a few large files under ``lote=<time of this run>/``, with
    ``csv_file`` and ``file_hash`` as columns.  The ledger gets one row per new
    file; its ``converted_at_utc`` names the directory.  A run that stops
    before that leaves rows which no entry names.  Returns the number of new
    files.
    """
    at = datetime.now(timezone.utc) if run_ts is None else datetime.fromisoformat(str(run_ts))
    stamp = at.strftime("%Y-%m-%dT%H:%M:%SZ")
    seen_path = f"{ledger_path.rstrip('/')}_seen"
    files = listed_files(spark, raw_path, glob).drop("file_name")
    seen = load_if_exists(spark, seen_path)
    if seen is not None and load_if_exists(spark, ledger_path, "csv") is not None:
        files = files.join(seen, files.columns, "left_anti")
    files = shared_copy(files, "raw-files")
    n = 0
    for part in _chunks((r[0] for r in files.select("path").toLocalIterator()), FILES_PER_APPEND):
        n += _land(spark, [literal_path(x) for x in part], landing_root, ledger_path, sep, stamp)
    if not files.isEmpty():
        files.write.mode("append").parquet(seen_path)
    return n


def _land(spark: SparkSession, paths: list[str], landing_root: str, ledger_path: str, sep: str, stamp: str) -> int:
    fresh = new_only(hash_files(spark, paths), read_manifest(spark, ledger_path, strict=False), "file_hash")
    # identical copies: the first file name wins (deterministic)
    fresh = dedupe_earliest(fresh.select("path", "file_name", "file_hash"), ["file_hash"], ["file_name", "path"])
    fresh = shared_copy(
        fresh.withColumn("csv_file", F.concat(F.regexp_replace("file_name", r"\.csv$", ""), F.lit(".csv"))), "new-files"
    )
    raw = read_raw_pairs(spark, paths, sep, path_column="path")
    rows = raw.join(fresh.select("path", "csv_file", "file_hash"), on="path", how="inner")
    canon = canonicalize(rows, keep=("csv_file", "file_hash")).withColumn("lote", landing_batch(F.lit(stamp)))
    canon.write.mode("append").option("header", True).partitionBy("lote").csv(landing_root)
    ledger_rows = fresh.select(
        "file_hash",
        F.col("file_name").alias("source_file"),
        "csv_file",
        F.lit(stamp).alias("converted_at_utc"),
    ).select(*MANIFEST_COLUMNS)
    return append_manifest(ledger_rows, ledger_path)


def price_ledger(spark: SparkSession, lake: Lakehouse) -> HashLedger:
    return HashLedger(spark, lake.path("bronze", lake.price_table), lake.fmt)


def _new_entries(spark: SparkSession, lake: Lakehouse, entries: DataFrame) -> DataFrame:
    """Ledger entries not yet in bronze; an entry without a hash is an error."""
    if not entries.filter(F.col("file_hash").isNull()).isEmpty():
        raise DataQualityError("ledger entries without file_hash")
    return price_ledger(spark, lake).new(entries)


def run_bronze_from_landing(
    spark: SparkSession,
    lake: Lakehouse,
    landing_root: str,
    ledger_path: str,
    run_id: str,
    run_ts=None,
    reject: bool = False,
) -> int:
    """Landing root (``run_landing`` layout) -> bronze price, new files first.

    The ledger says which files are new; only the landing runs that hold them
    are read, and rows meet their entry by name and hash.  Bad rows raise;
    with ``reject`` they are kept beside the table, with the reasons.
    """
    fresh = _new_entries(spark, lake, read_manifest(spark, ledger_path, strict=True))
    batches = [r[0] for r in fresh.select(landing_batch("converted_at_utc")).distinct().collect()]
    if not batches:
        return 0
    rows = read_landing_batches(spark, landing_root, sorted(batches))
    enriched = with_lineage(rows, fresh, run_id, run_ts, on=("csv_file", "file_hash"), how="inner")
    return ingest_files(enriched, fresh, price_ledger(spark, lake), _rejected(lake) if reject else None)


def _rejected(lake: Lakehouse) -> str:
    return rejected_path(lake.path("bronze", lake.price_table))


def unlisted_files(spark: SparkSession, landing_dir: str, manifest_path: str) -> DataFrame:
    """Landing files that no ledger entry names (they are never read); contents are not opened."""
    known = read_manifest(spark, manifest_path, strict=True)
    return new_only(listed_files(spark, landing_dir, "*.csv"), known, "file_name", "csv_file")


def _chunks(names: Iterator[str], size: int) -> Iterator[list[str]]:
    part: list[str] = []
    for name in names:
        part.append(name)
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part


def run_bronze_price(
    spark: SparkSession,
    lake: Lakehouse,
    landing_dir: str,
    manifest_path: str,
    run_id: str,
    run_ts=None,
    on_unlisted: str = "ignore",
    reject: bool = False,
) -> int:
    """Flat landing CSVs + ledger -> bronze price rows not yet ingested; returns rows appended.

    The ledger drives it: its current entries minus those in bronze are the
    new files, and only these are opened (in groups of
    :data:`FILES_PER_APPEND`).  A file that no entry names is not read;
    ``on_unlisted="raise"`` makes it an error.  Bad rows raise; with ``reject``
    they are kept beside the table, with the reasons.
    """
    if on_unlisted == "raise" and not unlisted_files(spark, landing_dir, manifest_path).isEmpty():
        raise DataQualityError(f"files under {landing_dir} are not in the ledger")
    fresh = _new_entries(spark, lake, current_entries(read_manifest(spark, manifest_path, strict=True)))
    names = (r[0] for r in fresh.select("csv_file").toLocalIterator())
    n = 0
    for part in _chunks(names, FILES_PER_APPEND):
        entries = fresh.filter(F.col("csv_file").isin(part))
        rows = read_landing(spark, [literal_path(f"{landing_dir.rstrip('/')}/{name}") for name in part])
        enriched = with_lineage(rows, entries, run_id, run_ts, how="inner")
        n += ingest_files(enriched, entries, price_ledger(spark, lake), _rejected(lake) if reject else None)
    return n


def run_bronze_index(
    spark: SparkSession,
    lake: Lakehouse,
    payload_path: str,
    meta: dict,
    run_ts=None,
    changed_only: bool = False,
) -> bool:
    """JSON payload -> typed bronze index rows, unless this payload was ingested.

    With ``changed_only`` only the months that differ from the last payload
    are appended, not the whole window again.  Returns True when rows were.
    """
    payload = read_payload(spark, payload_path)
    h = payload_hash(payload, ["data", "valor"]).first()["payload_hash"]
    rows = bronze_from_payload(payload, {**meta, "payload_hash": h}, run_ts)
    target = lake.path("bronze", lake.index_table)
    if changed_only:
        return ingest_payload_changes(spark, rows, target, lake.fmt) > 0
    return ingest_payload(spark, rows, target, lake.fmt)


def publish(spark: SparkSession, lake: Lakehouse, layer: str, table: str, written: list[dict] | None = None) -> None:
    """Register a layer's table; ``written`` as in :func:`tessera.sources.catalog.register_table`."""
    catalog.ensure_database(spark, layer, lake.path(layer, "")[:-1])
    catalog.register_table(spark, f"{layer}.{table}", lake.path(layer, table), lake.fmt, True, written)


# The bronze layer schemas (column -> type) the layer jobs write.
BRONZE_PRICE_CONTRACT = {
    "csv_file": "string", "mes_ano": "string", "valor": "double", "source_file": "string",
    "file_hash": "string", "converted_at_utc": "timestamp_ntz", "ingest_run_id": "string",
    "ingested_at_utc": "timestamp_ntz", "mes": "int", "ano": "int",
}
BRONZE_INDEX_CONTRACT = {
    "data_ref": "date", "valor": "double", "source": "string", "series_id": "int",
    "data_inicial": "string", "data_final": "string", "request_url": "string",
    "payload_hash": "string", "ingest_run_id": "string", "ingested_at_utc": "timestamp_ntz",
    "ano": "int", "mes": "int",
}


def run_validate_bronze(spark: SparkSession, lake: Lakehouse, register: bool = True) -> DataFrame:
    """Schema contract of both bronze tables (one report, ``table`` column first);
    registers them as ``bronze.*``, after the first time with the noted
    partitions only (no listing of the table)."""
    reports = []
    for table, contract in ((lake.price_table, BRONZE_PRICE_CONTRACT), (lake.index_table, BRONZE_INDEX_CONTRACT)):
        rep = schema_contract(lake.read(spark, "bronze", table), contract)
        reports.append(rep.select(F.lit(table).alias("table"), *rep.columns))
        if register:
            noted = load_if_exists(spark, partitions_path(lake.path("bronze", table)))
            # a row per partition of the table, which the catalog holds on the driver too
            written = None if noted is None else [r.asDict() for r in noted.distinct().na.drop().collect()]
            publish(spark, lake, "bronze", table, written)
    return reports[0].unionByName(reports[1])


def run_silver(spark: SparkSession, lake: Lakehouse, register: bool = True) -> dict[str, str]:
    """Bronze -> silver (conformed, latest version per key), full refresh; one partition per year."""
    out = {}
    for table, conform in ((lake.index_table, silver_index), (lake.price_table, silver_price)):
        overwrite_table(conform(lake.read(spark, "bronze", table)), lake.path("silver", table), lake.fmt, by=["ano"])
        if register:
            publish(spark, lake, "silver", table)
        out[table] = lake.path("silver", table)
    return out


GOLD_JOINED, GOLD_INSIGHTS, GOLD_ANALYTIC, GOLD_VIEW = "boi_ipca", "insights", "analitico", "vw_gold_dashboard"


def run_gold(
    spark: SparkSession, lake: Lakehouse, how: str = "inner", register: bool = True
) -> DataFrame:
    """Silver -> gold: joined table, insights, analytic table and dashboard view.

    The joined monthly table is written first and read back, so insights
    and the analytic table (whose global metrics scan it again) run on the
    small written table, not on the silver lineage.  Returns the dashboard
    projection of the analytic table.
    """
    joined = gold_prep(
        lake.read(spark, "silver", lake.price_table), lake.read(spark, "silver", lake.index_table), how
    )
    overwrite_table(joined, lake.path("gold", GOLD_JOINED), lake.fmt, sort_by=["data"], by=["ano"])
    j = lake.read(spark, "gold", GOLD_JOINED)
    overwrite_table(gold.insights(j), lake.path("gold", GOLD_INSIGHTS), lake.fmt, sort_by=["data"], by=["ano"])
    overwrite_table(gold.analytic(j), lake.path("gold", GOLD_ANALYTIC), lake.fmt, sort_by=["data"], by=["ano"])
    for t in (GOLD_JOINED, GOLD_INSIGHTS, GOLD_ANALYTIC):
        if register:
            publish(spark, lake, "gold", t)
    if register:
        view = catalog.create_dashboard_view(spark, f"gold.{GOLD_VIEW}", f"gold.{GOLD_ANALYTIC}")
    else:
        view = lake.read(spark, "gold", GOLD_ANALYTIC)
    return gold.dashboard(view).orderBy(F.col("data"))

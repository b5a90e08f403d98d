"""Incremental bronze ingest of landing CSVs with Structured Streaming.

The file stream source records every processed file in its checkpoint, so a
file is read once even across restarts; each micro-batch then goes through
the same steps as the batch jobs (:func:`tessera.sources.ingest.ingest_files`):
ledger entries not yet in bronze, pending note, one checked append, done note.
A retried batch or a re-landed copy of an ingested file adds nothing.
``trigger(availableNow=True)`` processes what has landed and stops, which is
how a scheduled ingest job runs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.parse import file_basename
from tessera.plans.layers import landing_batch
from tessera.sources.files import LANDING_BATCH_SCHEMA, LANDING_SCHEMA, read_landing_batches, read_manifest
from tessera.sources.ingest import HashLedger, current_entries, ingest_files, with_lineage


def quarantine_path(target: str) -> str:
    return f"{target.rstrip('/')}_quarantine"


def whole_runs(spark: SparkSession, landing_root: str, entries: DataFrame) -> DataFrame:
    """All rows of the landing runs that ``entries`` name.

    A file's rows may lie in several part files, of which a micro-batch sees
    some.  The entry was written after them all, so they are complete here.
    """
    batches = [r[0] for r in entries.select(landing_batch("converted_at_utc")).distinct().collect()]
    return read_landing_batches(spark, landing_root, sorted(batches))


def stream_landing(
    spark: SparkSession,
    landing_dir: str,
    manifest_path: str,
    target: str,
    checkpoint: str,
    run_id: str,
    fmt: str = "parquet",
    run_ts=None,
    max_files_per_trigger: int | None = None,
    hash_ledger: str | None = None,
    layout: str = "files",
) -> int:
    """Ingest every landing CSV not yet seen; returns the number of rows appended.

    ``hash_ledger`` (default ``<target>_ingested_hashes``) holds one row per
    ingested file hash.  ``layout``: "files" (flat CSVs, the file name is the
    ledger key) or "partitioned" (the ``lote=`` root written by
    ``run_landing``; lineage joins on name and hash, and a new entry's landing
    run is read whole, however its part files fall into micro-batches).  The
    stream passes each file once, so rows of a file that the ledger does not name are kept under
    ``<target>_quarantine`` (a retried batch may repeat them there).
    """
    partitioned = layout == "partitioned"
    reader = (
        spark.readStream.schema(LANDING_BATCH_SCHEMA if partitioned else LANDING_SCHEMA)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", "*.csv")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.csv(landing_dir)
    if not partitioned:
        rows = rows.withColumn("csv_file", file_basename(F.col("_metadata.file_path")))
    on = ["csv_file", "file_hash"] if partitioned else ["csv_file"]
    appended = {"n": 0}

    def batch(df: DataFrame, batch_id: int) -> None:
        ledger = HashLedger(spark, target, fmt, path=hash_ledger)
        # files of this batch are few; the rows are read again for the append and the quarantine
        df = df.persist()
        try:
            entries = read_manifest(spark, manifest_path, strict=True)
            entries = entries if partitioned else current_entries(entries)
            here = entries.join(df.select(*on).distinct(), on, "left_semi")
            fresh = ledger.new(here)
            if not fresh.isEmpty():
                taken = whole_runs(spark, landing_dir, fresh) if partitioned else df
                enriched = with_lineage(taken, fresh, run_id, run_ts, on=on, how="inner")
                appended["n"] += ingest_files(enriched, fresh, ledger)
            unknown = df.join(entries.select(*on).distinct(), on, "left_anti")
            if not unknown.isEmpty():
                unknown.write.mode("append").parquet(quarantine_path(target))
        finally:
            df.unpersist()

    query = (
        rows.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return appended["n"]

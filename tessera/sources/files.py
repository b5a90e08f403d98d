"""File scans (S1-S6): hashes, manifest, raw pairs, landing CSV, JSON payload, tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.parse import decoded_path, file_basename
from tessera.sources.json_array import SourceError, read_json_array

# Column names of the landed files, the file ledger and the payload.
LANDING_SCHEMA = T.StructType(
    [T.StructField("mes_ano", T.StringType()), T.StructField("valor", T.DoubleType())]
)
MANIFEST_COLUMNS = ("file_hash", "source_file", "csv_file", "converted_at_utc")
MANIFEST_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in MANIFEST_COLUMNS])
PAYLOAD_SCHEMA = T.StructType(
    [T.StructField("data", T.StringType()), T.StructField("valor", T.StringType())]
)
# Landing root written by `run_landing`: lote=<landing run>/part-*.csv, file name and hash as columns
LANDING_BATCH_SCHEMA = T.StructType(
    [
        *LANDING_SCHEMA.fields,
        T.StructField("csv_file", T.StringType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("lote", T.StringType()),
    ]
)


# Files above this many bytes are hashed in chunks of CHUNK bytes (a binary value must stay under 2 GiB).
STREAM_ABOVE = 256 * 1024 * 1024
CHUNK = 8 * 1024 * 1024


def landing_line(c) -> Column:
    """One canonical landing line ("MM/yyyy,valor") that arrives as a column; FAILFAST like the file scan."""
    return F.from_csv(F.col(c), LANDING_SCHEMA.simpleString()[len("struct<") : -1].replace(":", " "), {"mode": "FAILFAST"})


def payload_items(c) -> Column:
    """The ``{data, valor}`` items of a JSON payload text that arrives as a column."""
    return F.from_json(F.col(c), T.ArrayType(PAYLOAD_SCHEMA), {"mode": "FAILFAST"})


def load_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table under ``path``, or None if there is no such path; any other failure is raised."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def literal_path(path: str) -> str:
    """``path`` with the characters escaped that Spark's file sources read as patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def hash_files(
    spark: SparkSession, path: str | Sequence[str], glob: str | None = None, stream_above: int = STREAM_ABOVE
) -> DataFrame:
    """SHA-256 of every file under ``path`` (one or several) matching ``glob``.

    The scan deals files to tasks by their size; only the hash leaves the
    task.  Files of up to ``stream_above`` bytes are hashed as binary values;
    larger ones (a binary value ends at 2 GiB) are read in chunks inside the
    task, so its memory does not grow with the file.  Files without a byte
    are left out (Spark's scans plan none for them; they hold no rows).
    Output: ``path, file_name, file_hash, length``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    # the bound is pushed to the scan, which then does not open the larger files
    whole = files.filter(F.col("length") <= stream_above).select("path", F.sha2("content", 256).alias("file_hash"), "length")
    large = files.filter(F.col("length") > stream_above).select("path", "length")
    streamed = large.mapInPandas(_stream_hashes, "path string, file_hash string, length bigint")
    return whole.unionByName(streamed).select("path", file_basename("path").alias("file_name"), "file_hash", "length")


def _stream_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(file_hash=[_stream_hash(p, n) for p, n in zip(batch["path"], batch["length"])])


def _stream_hash(path: str, length: int) -> str:
    """SHA-256 of one file, read in chunks; ``path`` as Spark names it (not percent-encoded)."""
    local = re.match(r"file:/+(.*)", path, re.DOTALL)
    if local:
        system, name = arrow_fs.LocalFileSystem(), "/" + local[1]
    else:
        scheme, rest = path.split(":", 1)
        system, name = arrow_fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")
    digest, read = hashlib.sha256(), 0
    with system.open_input_stream(name, compression=None) as f:
        while chunk := f.read(CHUNK):
            digest.update(chunk)
            read += len(chunk)
    if read != length:
        raise SourceError(f"{path}: {read} bytes read, {length} listed; the file changed meanwhile")
    return digest.hexdigest()


def read_manifest(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Read the ledger CSV.

    ``strict`` (bronze): a missing file raises.  Non-strict (landing): a
    missing file is an empty ledger.  Anything else that is wrong with the
    ledger raises either way.  ``path`` may be one CSV file or a directory of
    CSV parts (as :func:`append_manifest` writes).  Spark's file sources skip
    names starting with ``_`` or ``.``, so the ledger must not be named so.
    """
    base = path.rstrip("/").rsplit("/", 1)[-1]
    if base.startswith(("_", ".")):
        raise SourceError(f"ledger name {base!r} is hidden from Spark file sources; rename it")
    try:
        df = spark.read.option("header", True).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        if strict:
            raise SourceError(f"manifest not found: {path}") from e
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    missing = [c for c in MANIFEST_COLUMNS if c not in df.columns]
    if missing:
        raise SourceError(f"manifest lacks columns {missing}")
    return df.select(*[F.col(c).cast("string") for c in MANIFEST_COLUMNS])


def read_raw_pairs(
    spark: SparkSession,
    paths: Sequence[str] | str,
    sep: str = ",",
    header: bool = False,
    path_column: str | None = None,
) -> DataFrame:
    """First two columns of delimited text files as ``data_raw, valor_raw`` strings (S3).

    ``path_column`` adds the path of each row's file.
    """
    df = spark.read.option("sep", sep).option("header", header).csv(paths)
    a, b = df.columns[:2]
    path = [decoded_path(F.col("_metadata.file_path")).alias(path_column)] if path_column else []
    return df.select(F.col(a).alias("data_raw"), F.col(b).alias("valor_raw"), *path)


def read_landing(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Canonical landing CSVs, many files in one scan, FAILFAST on bad rows.

    Adds ``csv_file`` (decoded base name of the source file) for lineage.
    """
    df = (
        spark.read.schema(LANDING_SCHEMA)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(paths)
    )
    return df.withColumn("csv_file", file_basename(F.col("_metadata.file_path")))


def read_landing_batches(spark: SparkSession, root: str, batches: Sequence[str]) -> DataFrame:
    """Rows of the given landing runs (``lote=`` directories of ``run_landing``) only."""
    return (
        spark.read.schema(LANDING_BATCH_SCHEMA)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("basePath", root)
        .csv([f"{root.rstrip('/')}/lote={b}" for b in batches])
    )


def listed_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path, file_name, length, modificationTime`` of the files under ``path``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", file_basename("path").alias("file_name"), "length", "modificationTime")


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of ``{data, valor}`` strings (S5), split over tasks; an empty payload is an error."""
    df = read_json_array(spark, path, PAYLOAD_SCHEMA)
    if df.isEmpty():
        raise SourceError(f"empty payload: {path}")
    return df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Table scan by path."""
    return spark.read.format(fmt).load(path)

"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import materialize, shared_copy, shared_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Written once as Parquet in the shared folder and read again; used where later stages need only some columns.
saved = shared_copy


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that is no column of ``df`` (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does just that for pure ASCII and is much faster."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, LOWER)
    )


def count_rows(df: DataFrame) -> int:
    """Row count (one number); Parquet answers it from its footers."""
    return df.count()


__all__ = [
    "count_rows",
    "free_name",
    "lower_ascii",
    "materialize",
    "read_table",
    "remove_folder",
    "saved",
    "shared_path",
    "text_or_empty",
]

"""Catalog registration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS, optionally at a location."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(name)}{loc}")


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str = "parquet",
    partitioned: bool = False,
    written: Sequence[Mapping[str, int]] | None = None,
) -> DataFrame:
    """Register an external table over an existing path.

    A partitioned parquet table reads 0 rows until its partitions are known
    to the catalog.  ``written`` names the partitions that a run wrote: a
    table that is registered already gets these only (ADD IF NOT EXISTS), at
    no listing of the table.  Without it, or on the first registration, the
    whole folder is synchronised.  An existing registration is refreshed (its
    files may have been rewritten).
    """
    existed = spark.catalog.tableExists(name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(name)} USING {fmt} LOCATION '{path}'")
    if partitioned and (written is None or not existed):
        spark.sql(f"MSCK REPAIR TABLE {_q(name)} SYNC PARTITIONS")
    elif partitioned and written:
        specs = " ".join("PARTITION (" + ", ".join(f"`{c}` = {int(v)}" for c, v in p.items()) + ")" for p in written)
        spark.sql(f"ALTER TABLE {_q(name)} ADD IF NOT EXISTS {specs}")
    if existed:
        # the files under LOCATION were rewritten: drop the cached listing
        spark.catalog.refreshTable(name)
    return spark.table(name)


def create_dashboard_view(spark: SparkSession, view: str, table: str) -> DataFrame:
    """CREATE OR REPLACE VIEW view AS SELECT * FROM table."""
    spark.sql(f"CREATE OR REPLACE VIEW {_q(view)} AS SELECT * FROM {_q(table)}")
    return spark.table(view)

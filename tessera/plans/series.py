"""Series derived from the given tables (stand-ins for the price and index layers).

Each builder aggregates a large fact table down to one row per period (and
series).  Sums run over integer cents so every engine gets identical values;
the aggregation is partial on the map side, so a hot month or series is
combined before the shuffle.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_SCHEMAS: dict[tuple[str, float], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given parquet tables.

    The schema is inferred once per file (and file version) and then passed
    to the reader, so later reads skip the footer-inference job.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    try:
        key = (path, os.path.getmtime(path))
    except OSError:  # not a local path: let Spark infer every time
        return spark.read.parquet(path)
    schema = _SCHEMAS.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def cents(c: str):
    return F.round(F.col(c) * F.lit(100)).cast("bigint")


def month_of_ts(c: str):
    return F.trunc(F.col(c).cast("date"), "month")


def price_series(spark: SparkSession, sf_dir: str, rows: str | None = None) -> DataFrame:
    """P: monthly mean order price -> (data, ano, mes, preco_boi_gordo); ``rows`` names a count column."""
    o = table(spark, sf_dir, "orders")
    return (
        o.groupBy(month_of_ts("o_orderdate").alias("data"))
        .agg(F.sum(cents("o_totalprice")).alias("_c"), F.count(F.lit(1)).alias("_n"))
        .select(
            "data",
            F.year("data").alias("ano"),
            F.month("data").alias("mes"),
            (F.col("_c") / F.col("_n") / F.lit(100)).alias("preco_boi_gordo"),
            *([F.col("_n").alias(rows)] if rows else []),
        )
    )


def index_series(
    spark: SparkSession, sf_dir: str, by_line: bool = False, rows: str | None = None
) -> DataFrame:
    """I: monthly mean discount in percent -> (data, ano, mes, ipca_mensal, series_id).

    With ``by_line`` each ``l_linenumber`` is its own series (several index
    series, as when more than one series id was ingested).
    """
    li = table(spark, sf_dir, "lineitem")
    sid = F.col("l_linenumber") if by_line else F.lit(1)
    return (
        li.groupBy(month_of_ts("l_shipdate").alias("data"), sid.cast("int").alias("series_id"))
        .agg(F.sum(cents("l_discount")).alias("_c"), F.count(F.lit(1)).alias("_n"))
        .select(
            "data",
            F.year("data").alias("ano"),
            F.month("data").alias("mes"),
            (F.col("_c") / F.col("_n")).alias("ipca_mensal"),
            "series_id",
            *([F.col("_n").alias(rows)] if rows else []),
        )
    )


def priority_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel: monthly mean order price per order priority -> (series, data, valor)."""
    o = table(spark, sf_dir, "orders")
    return (
        o.groupBy(F.col("o_orderpriority").alias("series"), month_of_ts("o_orderdate").alias("data"))
        .agg(F.sum(cents("o_totalprice")).alias("_c"), F.count(F.lit(1)).alias("_n"))
        .select("series", "data", (F.col("_c") / F.col("_n") / F.lit(100)).alias("valor"))
    )


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series: mean event value per event type and day -> (series, data, valor)."""
    e = table(spark, sf_dir, "events")
    return (
        e.groupBy(F.col("event_type").alias("series"), F.col("ts").cast("date").alias("data"))
        .agg(F.sum(cents("value")).alias("_c"), F.count(F.lit(1)).alias("_n"))
        .select("series", "data", (F.col("_c") / F.col("_n") / F.lit(100)).alias("valor"))
    )

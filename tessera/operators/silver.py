"""Silver conform and gold preparation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.parse import month_key
from tessera.operators.basic import dedupe_latest, project, require_key
from tessera.operators.joins import temporal_join


def conform(
    df: DataFrame,
    mapping: Mapping[str, Column | str],
    key: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Project to a layer schema, drop NULL keys, keep the latest row per key (Q10).

    ``order`` decides which version of a key wins (e.g. ingest time, then
    hash), so re-appended payloads resolve deterministically.
    """
    projected = project(df, mapping)
    return dedupe_latest(require_key(projected, *key), key, order)


# Silver columns, (name, type, bronze column); None is the month key of (ano, mes).
_VERSION = [("ingest_run_id", "string", "ingest_run_id"), ("ingested_at_utc", "timestamp_ntz", "ingested_at_utc")]
_PERIOD = [("ano", "int", "ano"), ("mes", "int", "mes")]
INDEX_SILVER = [
    ("data", "date", "data_ref"),
    *_PERIOD,
    ("ipca_mensal", "double", "valor"),
    ("series_id", "int", "series_id"),
    ("source", "string", "source"),
    ("payload_hash", "string", "payload_hash"),
    *_VERSION,
]
PRICE_SILVER = [
    ("data", "date", None),
    *_PERIOD,
    ("preco_boi_gordo", "double", "valor"),
    ("source_file", "string", "source_file"),
    ("file_hash", "string", "file_hash"),
    *_VERSION,
    ("converted_at_utc", "timestamp_ntz", "converted_at_utc"),
]


def layer_mapping(schema: Sequence[tuple[str, str, str | None]]) -> dict[str, Column]:
    """Projection to a layer schema: each column from its source, cast to its type."""
    return {
        name: month_key("ano", "mes") if source is None else F.col(source).cast(kind)
        for name, kind, source in schema
    }


def silver_index(bronze: DataFrame) -> DataFrame:
    """Bronze index rows -> silver index, latest version per (series_id, data)."""
    return conform(bronze, layer_mapping(INDEX_SILVER), ["series_id", "data"], ["ingested_at_utc", "payload_hash"])


def silver_price(bronze: DataFrame) -> DataFrame:
    """Bronze price rows -> silver price, latest version per month."""
    return conform(bronze, layer_mapping(PRICE_SILVER), ["data"], ["ingested_at_utc", "file_hash"])


def dominant_series(df: DataFrame, id_col: str = "series_id") -> DataFrame:
    """Rows of the series with the most rows; ties go to the lowest id.

    The choice is a one-row frame (group counts -> top 1), joined back with a
    broadcast whose size is one row by construction; nothing reaches the
    driver.  With a single series this returns the input rows.
    """
    counts = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"))
    chosen = counts.orderBy(F.col("_n").desc(), F.col(id_col).asc()).limit(1).select(id_col)
    return df.join(F.broadcast(chosen), on=id_col, how="left_semi")


def _monthly(silver: DataFrame, value: str, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Typed silver rows at month grain: the latest version of each month (NULL months go)."""
    months = silver.withColumn("data", month_key("ano", "mes")).select(
        *dict.fromkeys([*keys, "ano", "mes", value, *version])
    )
    return dedupe_latest(require_key(months, "data"), keys, [*version, value]).drop(*version)


def monthly_price(silver: DataFrame) -> DataFrame:
    """Silver prices at month grain: ``data, ano, mes, preco_boi_gordo``, the latest version of each month."""
    return _monthly(silver, "preco_boi_gordo", ["data"], ["ingested_at_utc", "file_hash"])


def monthly_index(silver: DataFrame) -> DataFrame:
    """Silver index at month grain, per series."""
    return _monthly(silver, "ipca_mensal", ["series_id", "data"], ["ingested_at_utc", "payload_hash"])


def gold_prep(price: DataFrame, index: DataFrame, how: str = "inner") -> DataFrame:
    """Month key, one row per month, dominant index series, temporal join (Q11).

    Of several rows of a month the latest ``(ingested_at_utc, hash)`` wins.
    Output: ``data, ano, mes, preco_boi_gordo, ipca_mensal``; the order by
    ``data`` is left to the writer (``sortWithinPartitions``) or presentation.
    """
    i = dominant_series(monthly_index(index), "series_id").drop("series_id")
    return temporal_join(monthly_price(price), i, on=["data"], how=how, coalesce_cols=["ano", "mes"])

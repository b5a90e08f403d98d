"""Projection, filter, grouping and de-duplication operators (P*, A*, O*, U1)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.util import as_col


def project(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Select exactly ``mapping`` (output name -> expression), in order."""
    return df.select(*[as_col(e).alias(name) for name, e in mapping.items()])


def with_constants(df: DataFrame, meta: Mapping[str, object]) -> DataFrame:
    """Append literal lineage columns (P3); a Column value is used as is."""
    return df.withColumns(
        {k: (v if isinstance(v, Column) else F.lit(v)) for k, v in meta.items()}
    )


def require_key(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows whose key columns are all non-NULL (P5)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def drop_header_rows(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Drop repeated header rows: every listed column equals its name, case-insensitively."""
    is_header = F.lit(True)
    for c, name in names.items():
        is_header = is_header & (F.lower(F.col(c).cast("string")).eqNullSafe(name.lower()))
    return df.filter(~is_header)


def matches(c, regex: str) -> Column:
    """Regex predicate; NULL input stays NULL."""
    return as_col(c).rlike(regex)


def keep_series(df: DataFrame, col: str, value) -> DataFrame:
    """Keep one series by equality."""
    return df.filter(F.col(col) == F.lit(value))


def group_count(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key (A1); partial counts are combined map-side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def duplicate_keys(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Keys that occur more than once, with their count (A2)."""
    return group_count(df, *keys, name=name).filter(F.col(name) > 1)


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct values of ``cols`` (A3)."""
    return df.select(*cols).distinct()


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple (A4).

    ``max_by`` is an ordinary aggregate, so a hot key is pre-aggregated on the
    map side instead of being sorted whole in one task as a
    ``row_number()`` window would.  NULL keys form their own group.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order])
    winner = F.max_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("_w")
    return df.groupBy(*keys).agg(winner).select(*keys, "_w.*").select(*df.columns)


def dedupe_earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order`` tuple (``min_by``)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order])
    winner = F.min_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("_w")
    return df.groupBy(*keys).agg(winner).select(*keys, "_w.*").select(*df.columns)


def union_ledger(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union all by column name."""
    return old.unionByName(new)


def layer_counts(df: DataFrame, layers: Mapping[str, Column]) -> DataFrame:
    """``layer, n``: one row per layer with its row count (A7), all from one pass over ``df``.

    ``layers`` gives each layer's count as an aggregate over ``df``, whose rows
    may stand for many (a sum of counts).
    """
    return df.agg(*[n.alias(name) for name, n in layers.items()]).unpivot([], list(layers), "layer", "n")


def hash_exists(df: DataFrame, col: str, value) -> bool:
    """Point probe: does ``col == value`` occur (P9)?  Filter + limit 1."""
    return not df.filter(F.col(col) == F.lit(value)).limit(1).isEmpty()

"""Join operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def temporal_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] = ("data",),
    how: str = "inner",
    coalesce_cols: Sequence[str] = (),
) -> DataFrame:
    """Equi-join two keyed series on their period key(s).

    ``coalesce_cols`` are present on both sides and merged with
    ``coalesce(left, right)`` (F11) — only matters for outer joins.
    Output: keys, coalesced columns, the rest of left, the rest of right.
    """
    on = list(on)
    l, r = left.alias("l"), right.alias("r")
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in on]
    joined = l.join(r, on=cond, how=how)
    keys = [F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in on]
    merged = [F.coalesce(F.col(f"l.{c}"), F.col(f"r.{c}")).alias(c) for c in coalesce_cols]
    skip = set(on) | set(coalesce_cols)
    rest_l = [F.col(f"l.{c}").alias(c) for c in left.columns if c not in skip]
    rest_r = [F.col(f"r.{c}").alias(c) for c in right.columns if c not in skip]
    return joined.select(*keys, *merged, *rest_l, *rest_r)


def with_ledger(df: DataFrame, ledger: DataFrame, on: str | Sequence[str] = "csv_file", how: str = "left") -> DataFrame:
    """Join rows to their ledger entry.

    The ledger must be unique on ``on`` (see
    :func:`tessera.sources.ingest.current_entries`).  Spark chooses the join
    from measured sizes at run time, and AQE splits a file that holds a large
    share of the rows.
    """
    return df.join(ledger, on=on, how=how)


def new_only(df: DataFrame, existing: DataFrame, key: str, existing_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is absent from ``existing``.

    A left-anti join: nothing is collected to the driver.  Copies of a known
    key collapse in their own tasks before the shuffle.
    """
    ek = existing_key or key
    known = existing.select(F.col(ek).alias("_known")).where(F.col("_known").isNotNull()).distinct()
    return df.join(known, df[key] == known["_known"], "left_anti")


def first_of_new(df: DataFrame, key: str, known: str, order: Sequence[str]) -> DataFrame:
    """Per ``key`` without a row marked ``known``: its smallest row by ``order``.

    For arrivals and known rows that lie in one table: one scan and one
    aggregate (combined map-side) instead of an anti-join.  Null keys go.
    """
    rest = [c for c in order if c != key]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.bool_or(known).alias("_known"), first)
        .filter(~F.col("_known"))
        .select(key, *[F.col(f"_first.{c}").alias(c) for c in rest])
    )


def attach_globals(df: DataFrame, metrics: DataFrame) -> DataFrame:
    """Append every column of a one-row ``metrics`` frame to each row.

    The metrics row is one scalar subquery (executed once, its result inlined
    as a value), so there is no collect to the driver and no cross join.
    """
    cols = metrics.columns
    packed = metrics.select(F.struct(*cols).alias("_m")).scalar()
    return df.withColumn("_m", packed).select(*df.columns, *[F.col(f"_m.{c}").alias(c) for c in cols])


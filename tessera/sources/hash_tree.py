"""Change detection by a tree of mergeable hashes.

A leaf holds the batch hash state of one month of one series: the number of
rows and one exact sum per limb of their row hashes.  A parent's state is the
sum of its children's, so the hashes of years and series come from the leaves
without reading a row again.  Two versions are compared from the top: only
nodes whose hashes differ are opened, down to the months that changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.hashing import LIMBS, row_limbs
from tessera.operators.basic import dedupe_latest
from tessera.session import shared_copy
from tessera.sources.files import load_if_exists
from tessera.sources.ingest import DataQualityError, HashLedger, ingest_new

STATE = ("n_rows", *(f"limb_{i}" for i in range(len(LIMBS))))
MONTH_KEYS = ("series_id", "ano", "mes")
_EXACT = "decimal(38,0)"


def leaves(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``*keys`` and the hash state of the rows under them; combined map-side."""
    sums = [F.sum(x.cast(_EXACT)).cast(_EXACT).alias(name) for x, name in zip(row_limbs(cols), STATE[1:])]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def nodes(leaf: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of the parents named by ``keys`` (the root for none), merged from any deeper level."""
    merged = [F.sum(c).cast("bigint" if c == "n_rows" else _EXACT).alias(c) for c in STATE]
    return leaf.groupBy(*keys).agg(*merged)


def node_hash() -> Column:
    """SHA-256 of a state, as :func:`tessera.sources.ingest.payload_hash` gives it for the same rows."""
    return F.sha2(F.concat_ws(":", *[F.col(c).cast("string") for c in STATE]), 256)


def _matched(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return left.alias("l").join(right.alias("r"), cond, how)


def changed_nodes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``*keys, status, n_old, n_new`` of the leaves that differ: ``added``, ``removed`` or ``changed``.

    ``old`` and ``new`` are leaf tables.  Level by level, only children of
    nodes that differ are compared; equal subtrees are left out whole.  NULL
    keys are values like others.
    """
    found = None
    for depth in range(1, len(keys) + 1):
        level = list(keys[:depth])
        a, b = (nodes(x, level).withColumn("hash", node_hash()) for x in (old, new))
        both = _matched(a, b, level, "full")
        status = (
            F.when(F.col("l.hash").isNull(), F.lit("added")).when(F.col("r.hash").isNull(), F.lit("removed")).otherwise(F.lit("changed"))
        )
        key = [F.when(F.col("l.hash").isNotNull(), F.col(f"l.{k}")).otherwise(F.col(f"r.{k}")).alias(k) for k in level]
        found = both.filter(~F.col("l.hash").eqNullSafe(F.col("r.hash"))).select(
            *key, status.alias("status"), F.col("l.n_rows").alias("n_old"), F.col("r.n_rows").alias("n_new")
        )
        if depth < len(keys):
            open_ = found.select(*level)
            old, new = (_matched(x, open_, level, "left_semi").select("l.*") for x in (old, new))
    return found


class HashTree:
    """The leaves of a table's last version, kept beside it; every run appends the leaves it changed."""

    def __init__(self, spark: SparkSession, target: str, keys: Sequence[str] = MONTH_KEYS):
        self.spark, self.path, self.keys = spark, f"{target.rstrip('/')}_hash_tree", list(keys)

    def current(self) -> DataFrame | None:
        """The latest state per leaf; leaves that were removed are gone."""
        stored = load_if_exists(self.spark, self.path)
        if stored is None:
            return None
        return dedupe_latest(stored, self.keys, ["version"]).filter("n_rows > 0").drop("version")

    def changes(self, new: DataFrame) -> DataFrame:
        """:func:`changed_nodes` against the stored leaves (all added on the first run)."""
        old = self.current()
        return changed_nodes(new.limit(0) if old is None else old, new, self.keys)

    def record(self, new: DataFrame, changes: DataFrame) -> None:
        """Append the states of the changed leaves; a removed one gets a state without rows."""
        stored = load_if_exists(self.spark, self.path)
        version = 1 if stored is None else (stored.agg(F.max("version")).first()[0] or 0) + 1
        kept = _matched(new, changes.filter("status <> 'removed'"), self.keys, "left_semi").select("l.*")
        gone = changes.filter("status = 'removed'").select(
            *self.keys, *[F.lit(0).cast(new.schema[c].dataType).alias(c) for c in STATE]
        )
        kept.unionByName(gone).withColumn("version", F.lit(version)).write.mode("append").parquet(self.path)


def ingest_payload_changes(
    spark: SparkSession,
    bronze_rows: DataFrame,
    target: str,
    fmt: str = "parquet",
    cols: Sequence[str] = ("data_ref", "valor"),
    keys: Sequence[str] = MONTH_KEYS,
) -> int:
    """Append the months of a typed payload that differ from the last version; returns the number of rows.

    A payload that was taken in before appends nothing.  A changed month is
    appended whole, under the new payload hash (the silver layer keeps the
    latest version of a key); a month that the payload no longer holds stays
    in the table.  Safe to run again after any stop, as ``ingest_payload`` is.
    """
    ledger = HashLedger(spark, target, fmt, "payload_hash")
    entry = ledger.new(bronze_rows.select("payload_hash").limit(1))
    if entry.isEmpty():
        return 0
    if not bronze_rows.filter(F.col("data_ref").isNull()).isEmpty():
        raise DataQualityError("payload rows with unparseable data_ref")
    tree = HashTree(spark, target, keys)
    new = shared_copy(leaves(bronze_rows, keys, cols), "leaves")
    changes = shared_copy(tree.changes(new), "changed-leaves")
    rows = _matched(bronze_rows, changes.filter("status <> 'removed'"), keys, "left_semi").select("l.*")
    doubt = ledger.in_doubt(entry)
    ledger.begin(entry)
    unique = ("series_id", "data_ref", "payload_hash")
    n = ingest_new(rows, None, target, "payload_hash", unique, fmt, check_month=None, in_doubt=doubt)
    tree.record(new, changes)
    ledger.commit(entry)
    return n

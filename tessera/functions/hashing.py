"""Content hashes: per-row canonical JSON hash and a mergeable batch hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.util import as_col


def content_hash(c) -> Column:
    """SHA-256 hex of a string or binary column."""
    return F.sha2(as_col(c), 256)


def row_json(cols: Sequence[str]) -> Column:
    """Canonical compact JSON of a row: keys sorted, no spaces."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(cols)]))


def row_hash(cols: Sequence[str]) -> Column:
    """SHA-256 of the canonical JSON of ``cols``."""
    return F.sha2(row_json(cols), 256)


# A SHA-256 as limbs that fit a bigint: (first hex digit, digits); all 64 digits are covered.
LIMBS = tuple((1 + at, min(15, 64 - at)) for at in range(0, 64, 15))


def row_limbs(cols: Sequence[str]) -> list[Column]:
    """All 256 bits of :func:`row_hash` as non-negative bigints."""
    h = row_hash(cols)
    return [F.conv(F.substring(h, at, n), 16, 10).cast("bigint") for at, n in LIMBS]


def batch_hash_aggs(cols: Sequence[str]) -> list[Column]:
    """Aggregates of an order-insensitive batch hash.

    Combines the whole row hashes with the count and one exact sum per limb,
    all partial-aggregated on the map side, so a batch is never gathered into
    one task or one group.  Returns ``[n_rows, payload_hash]``.
    """
    n = F.count(F.lit(1))
    sums = [F.coalesce(F.sum(x.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")) for x in row_limbs(cols)]
    digest = F.sha2(F.concat_ws(":", n.cast("string"), *[x.cast("string") for x in sums]), 256)
    return [n.alias("n_rows"), digest.alias("payload_hash")]

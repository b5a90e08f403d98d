"""Packing: optimal length buckets and token-budget batches.

The histogram of text lengths is counted on Spark over all rows: exact up to
65,536 tokens, and beyond that in 32,768 cells per power of two, each ending
at its largest real length, so it is bounded at any number of rows.  Dynamic
programming over it picks the bucket boundaries with the least padding.
Inside a bucket, rows are numbered without gaps (numbers within slices of the
rows as they lie, plus the sizes of the slices before) and every
``budget // boundary`` of them form a batch, so a bucket with most of the rows
is never in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import materialize

SLICE_ROWS = 20_000


@dataclass(frozen=True)
class PackParams:
    buckets: int = 8
    budget: int = 8192  # tokens of a batch, padding included


EXACT_BITS = 16


def cell(length: Column) -> Column:
    """Number of the length's histogram cell: the length itself to 2**16, then 2**15 cells per power of two."""
    shift = F.greatest(F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double"))) - (EXACT_BITS - 1), F.lit(0))
    step = F.pow(F.lit(2.0), shift).cast("long")
    return F.when(length <= 1 << EXACT_BITS, length.cast("long")).otherwise(length - length % step)


def histogram(lengths: DataFrame) -> DataFrame:
    """``(length, n, tokens)`` per cell over all rows of ``lengths(n_tokens)``; ``length`` is its largest real one."""
    size = F.coalesce("n_tokens", F.lit(0)).cast("long")
    return (
        lengths.groupBy(cell(size).alias("cell"))
        .agg(F.max(size).alias("length"), F.count(F.lit(1)).alias("n"), F.sum(size).alias("tokens"))
        .drop("cell")
    )


def best_boundaries(cells: list[tuple[int, int]], buckets: int) -> list[int]:
    """Boundaries (the last is the largest length) of at most ``buckets`` buckets with the least padding.

    ``cells``: (length, rows).  cost[k][j] = min over i < j of cost[k-1][i] plus
    the padded size of cells i+1..j at boundary j.  As a function of that
    boundary each i is a straight line, whose slope falls with i, so the best
    lines form a hull and one walk along it answers all j: linear in the cells,
    in whole numbers.  Ties go to fewer buckets.
    """
    cells = sorted(cells)
    if not cells:
        return []
    x = [c for c, _ in cells]
    rows = [0]
    for _, n in cells:
        rows.append(rows[-1] + n)
    m = len(x)
    cost: list[int | None] = [0] + [None] * m
    back: list[list[int]] = []
    best_total, best_k = None, 0
    for k in range(1, min(buckets, m) + 1):
        new: list[int | None] = [None] * (m + 1)
        origin = [0] * (m + 1)
        hull: list[int] = []  # cells i whose lines cost[i] - rows[i] * x are lowest somewhere, by rising i
        at = 0

        def value(i: int, boundary: int) -> int:
            return cost[i] - rows[i] * boundary

        for j in range(1, m + 1):
            i = j - 1
            if cost[i] is not None:
                # the middle line goes if the new one beats the first before the middle does
                while len(hull) > 1 and (cost[i] - cost[hull[-2]]) * (rows[hull[-1]] - rows[hull[-2]]) <= (
                    cost[hull[-1]] - cost[hull[-2]]
                ) * (rows[i] - rows[hull[-2]]):
                    hull.pop()
                hull.append(i)
                at = min(at, len(hull) - 1)
            if not hull:
                continue
            boundary = x[j - 1]
            while at + 1 < len(hull) and value(hull[at + 1], boundary) <= value(hull[at], boundary):
                at += 1
            origin[j] = hull[at]
            new[j] = value(hull[at], boundary) + rows[j] * boundary
        cost = new
        back.append(origin)
        if best_total is None or cost[m] < best_total:
            best_total, best_k = cost[m], k
    found, j = [], m
    for k in range(best_k, 0, -1):
        found.append(x[j - 1])
        j = back[k - 1][j]
    return found[::-1]


def boundaries(lengths: DataFrame, p: PackParams) -> list[int]:
    """Global boundaries; only the bounded histogram comes to the driver."""
    return best_boundaries([(r.length, r.n) for r in histogram(lengths).collect()], p.buckets)


def word_count(text_col: str = "text") -> Column:
    """Words between white space; null and empty texts have none."""
    text = F.btrim(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, r"[ \t\n\x0B\f\r]+"))).cast("long")


def packed(docs: DataFrame, p: PackParams = PackParams(), id_col: str = "doc_id", n_tokens: Column | None = None) -> DataFrame:
    """One row per input row: ``id, n_tokens, bucket, padded_to, batch, slot, padding``.

    ``batch`` counts within the bucket, ``slot`` within the batch.  All rows of
    a batch have the bucket's boundary as padded length, and ``padded_to *
    rows <= budget``, except that a text longer than the budget is a batch of
    its own.  Empty texts share a bucket of boundary 0 or the first above.
    Null ids and repeated rows are packed like others; an empty table gives none.
    """
    tokens = word_count() if n_tokens is None else n_tokens
    sized = materialize(docs.select(F.col(id_col).alias("id"), F.coalesce(tokens.cast("long"), F.lit(0)).alias("n_tokens")))
    ends = boundaries(sized, p) or [0]
    end = F.array([F.lit(e).cast("long") for e in ends])
    bucket = F.size(F.filter(end, lambda e: e < F.col("n_tokens")))
    # runs of rows as the checkpoint holds them: equal rows are spread like all others
    place = F.floor(F.monotonically_increasing_id() / F.lit(SLICE_ROWS))
    placed = sized.select("id", "n_tokens", bucket.alias("bucket"), place.alias("slice"))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("bucket", "slice")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("bucket", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("bucket", "slice").orderBy("n_tokens", "id")
    numbered = placed.withColumn("at", F.row_number().over(inside) - 1).join(offsets, ["bucket", "slice"])
    padded = end[F.col("bucket")]
    fit = F.greatest(F.floor(F.lit(p.budget) / F.greatest(padded, F.lit(1))), F.lit(1))
    number = F.col("offset") + F.col("at")
    return numbered.select(
        "id",
        "n_tokens",
        "bucket",
        padded.alias("padded_to"),
        F.floor(number / fit).cast("long").alias("batch"),
        F.pmod(number, fit).cast("int").alias("slot"),
        (padded - F.col("n_tokens")).alias("padding"),
    )

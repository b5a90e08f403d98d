"""Exact dedup: two-pass Bloom filtering, DataFrame functions only.

Pass 1 throws every text hash at ``k`` cells of a Bloom filter that is cut
into blocks of 32,768 cells and counts the rows per cell; the cells hit by at
least two rows are kept as a bitmap, one 4 KiB row per block.  Pass 2 probes
the bitmap: a row with a cell that only it hit is unique for certain and goes
straight to the result.  Only the other rows are shuffled by their digest,
where an exact comparison (SHA-256 of the normalised text) decides.

The filter is sized from the row count (``bits_per_row``), so its error rate
is the same at every size.  The texts themselves never shuffle: every pass
works on ``(id, digest)`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import count_rows, free_name, lower_ascii, materialize, text_or_empty

BLOCK_CELLS = 32_768  # cells of one bitmap_construct_agg bitmap


def text_digest(text_col: str = "text") -> Column:
    """SHA-256 of the text with A-Z lower-cased; null text is empty."""
    return F.unhex(F.sha2(lower_ascii(text_or_empty(text_col)).cast("binary"), 256))


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, digest)`` per row (:func:`text_digest`)."""
    return docs.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest"))


def _with_cells(hashed: DataFrame, rows: int, bits_per_row: int, k: int) -> DataFrame:
    blocks = max(1, -(-rows * bits_per_row // BLOCK_CELLS))
    cells = [
        F.pmod(F.xxhash64("digest", F.lit(i)), F.lit(BLOCK_CELLS)).cast("int") for i in range(1, k + 1)
    ]
    return hashed.withColumns(
        {"block": F.pmod(F.xxhash64("digest"), F.lit(blocks)), "cells": F.array_distinct(F.array(*cells))}
    )


def repeated_cells(probes: DataFrame) -> DataFrame:
    """Pass 1: ``(block, bits)``, a bitmap of the cells that two or more rows hit."""
    hits = (
        probes.select("block", F.explode("cells").alias("cell"))
        .groupBy("block", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    return hits.groupBy("block").agg(F.bitmap_construct_agg(F.col("cell").cast("long")).alias("bits"))


def _is_set(bits: Column, cell: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(cell, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(cell, F.lit(8))) == 1


def possibly_repeated(hashed: DataFrame, bits_per_row: int = 16, k: int = 2) -> DataFrame:
    """Pass 2: ``(id, digest, suspect)``; a row with ``suspect`` false has no equal for certain.

    The filter joins on its block number: Spark broadcasts it while its
    measured size is under the broadcast threshold, and otherwise shuffles
    the narrow ``(id, digest)`` rows.  It is cut off by a checkpoint, so both
    sides are plain exchanges then, and Spark can split a block that the
    copies of one text fill.
    """
    probes = _with_cells(hashed, count_rows(hashed), bits_per_row, k)
    bitmap = materialize(repeated_cells(probes))
    suspect = F.coalesce(
        F.forall("cells", lambda c: _is_set(F.col("bits"), c)), F.lit(False)
    )
    return probes.join(bitmap, "block", "left").select("id", "digest", suspect.alias("suspect"))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = 16, k: int = 2
) -> DataFrame:
    """One row per input row: ``id, digest, keep_id, group_size, kept``.

    Of equal texts the row with the largest id stays; ids count as unique, so
    rows repeated with the same id all count in ``group_size`` and are all
    "kept" by id.  A null id loses to any other; if all ids of a group are
    null, ``keep_id`` is null and the rows stay.  Null texts equal empty ones.
    Extra columns of ``docs`` are ignored; an empty table gives no rows.
    """
    hashed = materialize(text_digests(docs, id_col, text_col))
    flagged = materialize(possibly_repeated(hashed, bits_per_row, k))
    alone = flagged.filter(~F.col("suspect")).select(
        "id", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")
    )
    suspects = flagged.filter("suspect").select("id", "digest")
    # partial aggregation shrinks a hot group before the shuffle; the groups
    # are cut off (checkpoint) so that both join sides are plain exchanges,
    # whose skewed partitions Spark can split
    groups = materialize(
        suspects.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    grouped = suspects.join(groups, "digest").select("id", "digest", "keep_id", "group_size")
    return alone.unionByName(grouped).withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text repeats; all columns stay as they are.

    Rows that repeat id and text stay as often as they occur (ids count as unique).
    Rows go by id and digest: another text under the same id, or under a null id, stays.
    """
    gone, digest = free_name(docs, "__gone"), free_name(docs, "__digest")
    dropped = exact_groups(docs, id_col, text_col).filter(~F.col("kept"))
    dropped = dropped.select(F.struct("id", "digest").alias(gone))
    marked = docs.withColumn(digest, text_digest(text_col))
    same = marked[id_col].eqNullSafe(F.col(f"{gone}.id")) & (F.col(digest) == F.col(f"{gone}.digest"))
    return marked.join(dropped, same, "left_anti").drop(digest)

"""Document fingerprints: threshold-scaled sketches, DataFrame functions only.

A sketch keeps every five-word shingle hash below a fixed fraction of the hash
range, so it grows with its document, the sketch of a union comes from the
sketches, and containment can be estimated between very unequal documents.  A
text with words but no hash below the fraction keeps its smallest one, so only
texts without words have an empty sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import materialize, text_or_empty

WHITE = " \t\n\x0b\f\r"


SIGN = -(1 << 63)


def _below(hashes: Column, scale: int) -> Column:
    """Hashes under 1/``scale`` of the range; the smallest one if there are none.

    Hashes are held with the highest bit turned, so that signed order is theirs.
    """
    under = F.filter(hashes, lambda h: h < F.lit(SIGN + (1 << 64) // scale))
    return F.when(F.size(under) > 0, under).when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(hashes)


def sketch(text: Column, k: int = 5, scale: int = 4) -> Column:
    """Sorted distinct hashes (64 bits) of the ``k``-word shingles under 1/``scale`` of the range, or the smallest.

    Words are lower-cased and split at white space.  Fewer than ``k`` words:
    the whole sequence is the one shingle; no words (or null): no hashes.
    """
    clean = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(WHITE))

    def hashes(words: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(1)))
        return F.transform(at, lambda i: F.xxhash64(F.slice(words, i, k)).bitwiseXOR(F.lit(SIGN)))

    # one-element arrays bind the words and the hashes once for all uses
    words = F.array(F.split(clean, r"[ \t\n\x0B\f\r]+"))
    every = F.transform(words, hashes)
    kept = F.transform(every, lambda e: F.sort_array(F.array_distinct(_below(e, scale))))
    return F.when(clean == "", F.array().cast("array<long>")).otherwise(kept[0])


def sketch_hex(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda h: F.lower(F.lpad(F.hex(h.bitwiseXOR(F.lit(SIGN))), 16, "0"))), "")


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller document's shingles in the other; a text without words is only like another such."""
    least = F.least(F.size(a), F.size(b))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when(least == 0, F.lit(0.0))
        .otherwise(F.size(F.array_intersect(a, b)) / least)
    )


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    whole = F.size(a) + F.size(b) - common
    return F.when(whole == 0, F.lit(1.0)).otherwise(common / F.greatest(whole, F.lit(1)))


def merge(a: Column, b: Column, scale: int = 4) -> Column:
    """The sketch of two documents taken together."""
    return F.sort_array(_below(F.array_union(a, b), scale))


def _neighbours(keys: DataFrame) -> DataFrame:
    """``(k, h)`` of each document with those of the one before it (ids ascending, round at the ends).

    Range partitions hold runs of the order; only their last rows (one per
    partition) meet in one window.
    """
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("id").asc_nulls_first(), F.col("h")]
    dealt = keys.distinct().repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    run = Window.partitionBy("part").orderBy(*order)
    me = F.struct("k", "h", "n")
    inner = materialize(
        dealt.select("part", "k", "h", "n", F.lag(me).over(run).alias("before"), F.lead(F.lit(1)).over(run).alias("more"))
    )
    ends = inner.filter("more IS NULL").select("part", me.alias("end"))
    whole = Window.orderBy("part")
    round_ = F.last("end").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    seams = ends.select("part", F.coalesce(F.lag("end").over(whole), round_).alias("seam"))
    return inner.join(F.broadcast(seams), "part").select(
        "k", "h", F.coalesce("before", "seam").alias("before")
    )


def edited_and_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, scale: int = 4
) -> DataFrame:
    """Sketches of each text, of its edited text and of the next document's text.

    The edited text has its last ``floor(n/2)`` code points replaced by the
    first as many of the next document (ids ascending, null first; after the
    last: the first).  Rows that repeat id and text are one document there,
    and each gets that document's result.  Null texts count as empty; ids of any
    ordered type do.
    """
    text = text_or_empty(text_col)
    whole = docs.schema[id_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    key = F.coalesce("id", F.lit(0)) if whole else F.coalesce(F.col("id").cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id",
        key.alias("k"),
        F.xxhash64("text", F.col("id").isNull()).alias("h"),
        "text",
    )
    order = _neighbours(base.select("id", "k", "h", F.char_length("text").alias("n")))
    placed = base.join(order, ["k", "h"])
    copy = F.row_number().over(Window.partitionBy("k", "h").orderBy(F.lit(1)))
    half = F.floor(F.col("before.n") / 2).cast("int")
    after = (
        placed.withColumn("copy", copy)
        .filter("copy = 1")
        .select(
            F.col("before.k").alias("k"),
            F.col("before.h").alias("h"),
            F.col("id").alias("next_id"),
            F.substring("text", F.lit(1), half).alias("tail"),
            sketch(F.col("text"), k, scale).alias("next_sketch"),
        )
    )
    n = F.char_length("text")
    kept = (n - F.floor(n / 2)).cast("int")
    both = placed.join(after, ["k", "h"]).select(
        "id",
        "next_id",
        n.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), kept), "tail").alias("edited"),
        sketch(F.col("text"), k, scale).alias("sketch"),
        "next_sketch",
    )
    return both.select("*", sketch(F.col("edited"), k, scale).alias("edited_sketch"))

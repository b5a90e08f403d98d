"""JSON arrays of flat objects, read by as many tasks as the file has splits.

A file is scanned as text cut at ``}``, which Spark splits anywhere: a split
begins after its first ``}`` and reads on to the one behind its end.  A cut is
a wrong one if the ``}`` stands inside a string, that is, after an odd number
of quotes.  So the quotes of each split are counted first (one aggregate, a row
per split), and their parities are carried along the file.  Splits without an
odd fragment hold whole items, which go straight to the JSON parser; only the
fragments of the others are put together, across split edges too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import shared_copy

_SPACE = r"[ \t\r\n]*"
_LEAD = rf"^{_SPACE}[\[,]"
_ITEM = rf"^{_SPACE}[\[,]{_SPACE}\{{"
_OPENS = rf"^{_SPACE}\["
_CLOSES = rf"^{_SPACE}(\[{_SPACE})?\]{_SPACE}$"
_SPLIT = ["file", "block"]


class SourceError(ValueError):
    """A source is missing, malformed or empty where that is an error."""


def _fragments(spark: SparkSession, path) -> DataFrame:
    """``file, block, place, value``: the texts between two ``}``, in file order by (block, place)."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def _odd() -> Column:
    """1 if ``value`` has an odd number of quotes that no backslash escapes."""
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    return ((F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))) % 2).cast("int")


def _splits(fragments: DataFrame) -> DataFrame:
    """One row per split: its parity, what it begins and ends with, and the state that it starts in."""
    closes = F.col("value").rlike(_CLOSES)
    rows = (
        fragments.withColumn("odd", _odd())
        .groupBy(*_SPLIT)
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.sum("odd") % 2).cast("int").alias("parity"),
            F.max("odd").alias("any_odd"),
            F.count_if(F.col("value").rlike(_OPENS)).alias("n_open"),
            F.count_if(closes).alias("n_close"),
            F.min_by(F.col("value").rlike(_OPENS), "place").alias("opens"),
            F.max_by(closes, "place").alias("closes"),
        )
    )
    along = Window.partitionBy("file").orderBy("block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2
    rows = rows.select(
        "*",
        inside.cast("int").alias("start"),
        F.lag("block").over(along).isNull().alias("first"),
        F.lead("block").over(along).isNull().alias("last"),
    )
    # a split that leaves a string open holds the beginning of an item that later splits go on with
    leaves_open = ((F.col("start") + F.col("parity")) % 2 == 1) & ((F.col("start") == 0) | (F.col("any_odd") == 1))
    return rows.select(
        "*",
        F.last(F.when(leaves_open, F.col("block")), ignorenulls=True).over(before).alias("origin"),
        ((F.col("start") == 0) & (F.col("any_odd") == 0)).alias("whole"),
    )


def _malformed() -> Column:
    """What is wrong with a split, or NULL; items are looked at later, by the parser."""
    whole, first, last = F.col("whole"), F.col("first"), F.col("last")
    return (
        F.when(last & ((F.col("start") + F.col("parity")) % 2 == 1), "the text ends inside a string")
        .when(first & ~F.col("opens"), "the text does not begin with an array")
        .when(last & ~F.col("closes"), "the array is not closed")
        .when(whole & (F.col("n_open") != first.cast("int")), "a second array begins")
        .when(whole & (F.col("n_close") != last.cast("int")), "text follows the array")
    )


def _mended(fragments: DataFrame, splits: DataFrame) -> DataFrame:
    """``text, is_first, is_last`` of the items of splits with odd fragments, whose fragments are put together."""
    held = splits.filter(~F.col("whole")).select(*_SPLIT, "start", "parity", "first", "last", "origin")
    split = Window.partitionBy(*_SPLIT)
    along = split.orderBy("place")
    rows = fragments.withColumn("odd", _odd()).join(held, _SPLIT)
    # a fragment after which no string is open ends an item
    ends = 1 - (F.col("start") + F.sum("odd").over(along.rowsBetween(Window.unboundedPreceding, 0))) % 2
    rows = rows.withColumn("ends", ends)
    rows = rows.select(
        "*",
        F.coalesce(F.sum("ends").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("item"),
        F.sum("ends").over(split).alias("n_items"),
    )
    goes_on = (F.col("start") == 1) & (F.col("item") == 0)
    stays_open = F.col("item") == F.col("n_items")
    rows = rows.select(
        "file",
        F.when(goes_on, F.col("origin")).otherwise(F.col("block")).alias("at"),
        F.when(goes_on | stays_open, F.lit(-1)).otherwise(F.col("item")).alias("item"),
        F.struct("block", "place", "value").alias("part"),
        (F.col("first") & (F.col("item") == 0)).alias("is_first"),
        (F.col("last") & (F.col("item") == F.col("n_items") - 1)).alias("is_last"),
    )
    # a group is one item's text
    return rows.groupBy("file", "at", "item").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["value"]), "}").alias("text"),
        F.max("is_first").alias("is_first"),
        F.max("is_last").alias("is_last"),
    )


def read_json_array(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """The items of JSON array files of flat objects, as rows of ``schema``.

    ``path`` is a file, a folder or several of them; each file holds one array.
    A file above ``spark.sql.files.maxPartitionBytes`` is read by several
    tasks.  Braces, brackets, quotes and line ends inside strings are kept.
    Raises :class:`SourceError` at once for a text that is no array, does not
    end or goes on behind its end; an item that is no flat object fails the
    query that reads it.  Fields that an item lacks are NULL, unknown ones are
    left out; an array without items, or no file with a byte, gives no rows.
    """
    fragments = _fragments(spark, path)
    splits = shared_copy(_splits(fragments), "array-splits")
    wrong = splits.withColumn("reason", _malformed()).filter("reason IS NOT NULL").select("file", "reason").first()
    if wrong:
        raise SourceError(f"{wrong['file']}: {wrong['reason']}")
    no_flags = [F.lit(None).cast("boolean").alias(c) for c in ("is_first", "is_last")]
    if splits.filter(~F.col("whole")).isEmpty():
        items = fragments.select(F.col("value").alias("text"), *no_flags)
    else:
        # splits are planned again here: one that was not seen before means other split settings since then
        known = fragments.join(splits.select(*_SPLIT, "whole"), _SPLIT, "left")
        lost = F.raise_error(F.lit("the splits of the array changed; read it again")).cast("boolean")
        whole = known.filter(F.coalesce("whole", lost)).select(F.col("value").alias("text"), *no_flags)
        items = whole.unionByName(_mended(fragments, splits).select("text", "is_first", "is_last"))
    text = F.col("text")
    closing = text.rlike(_CLOSES) & F.coalesce("is_last", F.lit(True))
    misplaced = F.col("is_first").isNotNull() & (text.rlike(_OPENS) != F.col("is_first"))
    body = F.concat(F.regexp_replace(text, _LEAD, ""), F.lit("}"))
    bad = F.raise_error(F.concat(F.lit("no flat object in the array: "), F.substring(text, 1, 200)))
    item = F.when(text.rlike(_ITEM) & ~misplaced, F.from_json(body, schema, {"mode": "FAILFAST"})).otherwise(
        bad.cast(schema)
    )
    return items.filter(~closing).select(item.alias("item")).select("item.*")

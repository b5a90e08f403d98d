"""Source divergence audit: how each source's use of terms differs from its language and from other sources.

1. Duplicate-text collapse: rows are grouped by language and digest of the
   text, with one narrow table of multiplicities per source; every distinct
   text is tokenised once, and its counts and document frequencies enter the
   sums weighted by the multiplicities.  Copies collapse in their tasks before
   the shuffle.
2. Kept terms per language are those in at least ``min_docs`` documents.  The
   smoothed shares are integers (parts in a billion), computed exactly.
3. Sparse pair evaluation: the postings of kept terms are dealt by blocks of
   terms and pairs of source tiles.  A source has one base share for every
   term that it lacks, so a pair's distance in a block is that of the base
   shares plus corrections at the terms that one of the two has:

   ``V|a0 - b0|  +  sum over A of (|a - b0| - |a0 - b0|)  +  sum over B of (|a - b| - |a - b0|)``

   (A, B: the terms that the sources have; ``a`` is ``a0`` outside A).  No
   pair is formed per term; a task adds up its blocks and gives out one number
   per pair of sources.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import materialize, saved

SCALE = 1000**3
FLUSH_TERMS = 400_000
#: Every byte of a letter or of a character outside ASCII stays (A-Z lower-cased), all others become spaces.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


@dataclass(frozen=True)
class AuditParams:
    min_docs: int = 30
    smooth: int = 5
    top: int = 50  # ranks of the term part
    block_terms: int = 4096  # terms of a block of the pair evaluation, on average
    tile: int = 256  # sources of a tile


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of letters and of characters outside ASCII in UTF-8, A-Z lower-cased."""
    return (text or b"").translate(LETTERS).split()


def _blank(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


# ------------------------------------------------------ collapse and counting


def collapsed(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, digest, text, sources)`` per distinct text of a language; ``sources`` is ``[(source, n)]``."""
    rows = docs.select(_blank(lang_col).alias("lang"), _blank(source_col).alias("source"), _blank(text_col).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    same = ["lang", "digest"]
    # an array of at most one entry per source
    per_source = (
        rows.groupBy(*same, "source")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*same)
        .agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    )
    texts = rows.groupBy(*same).agg(F.first("text").alias("text"))
    return texts.join(per_source, same)


def term_counts(distinct: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents per source, added up per task.

    Rows of several tasks may share a key; whoever reads them sums.
    """

    def run(batches):
        # (lang, source) -> term -> weighted occurrences, documents
        count: dict[tuple[str, str], Counter] = {}
        docs: dict[tuple[str, str], Counter] = {}

        def flush():
            for key, found in count.items():
                d = docs[key]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key[0]] * len(found), pa.string()),
                        pa.array([key[1]] * len(found), pa.string()),
                        pa.array(list(found), pa.binary()),
                        pa.array(list(found.values()), pa.int64()),
                        pa.array([d[t] for t in found], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )

        size = 0
        for b in batches:
            for lang, text, sources in zip(*(b.column(i) for i in range(3))):
                words, lang, held = terms_of(text.as_py()), lang.as_py(), sources.as_py()
                once = Counter(words) if len(held) > 1 or held[0]["n"] > 1 else None
                for s in held:
                    key, m = (lang, s["source"]), s["n"]
                    c, d = count.setdefault(key, Counter()), docs.setdefault(key, Counter())
                    size -= len(c)
                    if once is None:  # no copies: counted without a table of its own
                        c.update(words)
                        d.update(set(words))
                    else:
                        for t, k in once.items():
                            c[t] += m * k
                            d[t] += m
                    size += len(c)
                if size > FLUSH_TERMS:
                    yield from flush()
                    count, docs, size = {}, {}, 0
        yield from flush()

    rows = distinct.select("lang", F.col("text").cast("binary").alias("text"), "sources").mapInArrow(
        run, "lang string, source string, term binary, n long, docs long"
    )
    return rows.withColumn("term", F.col("term").cast("string"))


def kept_postings(counts: DataFrame, p: AuditParams) -> DataFrame:
    """``(lang, source, term, n, lang_n, first)`` for the terms in at least ``min_docs`` documents of their language.

    ``first`` marks one row per term.  Counts of tasks are added up per source
    first, so a frequent term has one row per source when its language's sums
    are taken; rare terms end there and are written nowhere.
    """
    summed = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    return (
        summed.withColumns(
            {
                "lang_n": F.sum("n").over(term),
                "lang_docs": F.sum("docs").over(term),
                "first": F.row_number().over(term.orderBy("source")) == 1,
            }
        )
        .filter(F.col("lang_docs") >= p.min_docs)
        .select("lang", "source", "term", "n", "lang_n", "first")
    )


def share(count: Column, total: Column, terms: Column, p: AuditParams) -> Column:
    """``1 + floor(SCALE * (count + smooth) / (total + smooth * terms))``, exact in longs.

    Long division, three decimal digits at a time: nothing overflows below
    9 * 10**15 counted terms.
    """
    down = (total + F.lit(p.smooth) * terms).cast("long")
    rest, found = (count + F.lit(p.smooth)).cast("long"), F.lit(0).cast("long")
    for step in (1, 1000, 1000, 1000):
        up = rest * F.lit(step)
        found = found * F.lit(step) + F.call_function("div", up, down)
        rest = up % down
    return found + F.lit(1)


# ------------------------------------------------------------ pair evaluation


def _pair_sums(rows: dict[str, np.ndarray], same_tile: bool):
    """Partial distances of one block: ``(a, b, value)`` over its source pairs, a < b.

    ``rows`` holds the sources' base shares (``term`` null: ``idx, p, terms``;
    ``terms`` is V in the block that counts the base distance, else 0) and the
    postings (``idx, term, p``).
    """
    is_base = rows["base"]
    idx, base, terms = (rows[c][is_base] for c in ("idx", "p", "terms"))
    order = np.argsort(idx, kind="stable")
    idx, base, terms = idx[order], base[order], terms[order]
    side = rows["side"][is_base][order]
    p_src, p_term, p_val = (rows[c][~is_base] for c in ("idx", "term", "p"))
    _, p_term = np.unique(p_term, return_inverse=True)
    at = np.searchsorted(idx, p_src)  # postings name sources of the block's tiles
    order = np.argsort(at, kind="stable")
    at, p_term, p_val = at[order], p_term[order], p_val[order]
    start = np.searchsorted(at, np.arange(len(idx) + 1))
    width = int(p_term.max(initial=-1)) + 1
    left = np.arange(len(idx)) if same_tile else np.flatnonzero(side == 0)
    found = []
    for a in left:
        right = np.arange(a + 1, len(idx)) if same_tile else np.flatnonzero(side == 1)
        if not len(right):
            continue
        lo, hi = start[right[0]], start[right[-1] + 1]
        other, here = p_val[lo:hi], p_term[lo:hi]
        mine = p_val[start[a] : start[a + 1]]
        dense = np.full(width, base[a])
        dense[p_term[start[a] : start[a + 1]]] = mine
        owner = np.repeat(right, np.diff(np.append(start[right], hi)))
        gain = np.abs(dense[here] - other) - np.abs(dense[here] - base[owner])
        cum = np.concatenate([[0], np.cumsum(gain)])
        value = cum[start[right + 1] - lo] - cum[start[right] - lo]
        # sum over a's terms of |share - base of b|, from sorted shares and their running sums
        ranked = np.sort(mine)
        run = np.concatenate([[0], np.cumsum(ranked)])
        x = base[right]
        k = np.searchsorted(ranked, x)
        value += x * k - run[k] + (run[-1] - run[k]) - x * (len(mine) - k)
        value += (terms[a] - len(mine)) * np.abs(base[a] - x)
        found.append((np.full(len(right), idx[a]), idx[right], value))
    return found


def _pairs_of(batches):
    """Streams sorted (lang, tile_a, tile_b, block) rows; one row per pair and (lang, tiles) of the task."""
    names = ["base", "side", "idx", "term", "p", "terms"]
    at = ["lang", "tile_a", "tile_b", "block"]

    def emit(key, sums):
        if sums:
            flat = list(sums.items())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]] * len(flat), pa.string()),
                    pa.array([x[0][0] for x in flat], pa.int32()),
                    pa.array([x[0][1] for x in flat], pa.int32()),
                    pa.array([x[1] for x in flat], pa.int64()),
                ],
                ["lang", "a", "b", "value"],
            )

    def add(sums, group, parts):
        rows = {n: np.concatenate([x[n] for x in parts]) for n in names}
        for a, b, value in _pair_sums(rows, group[1] == group[2]):
            for i, j, v in zip(a.tolist(), b.tolist(), value.tolist()):
                key = (min(i, j), max(i, j))
                sums[key] = sums.get(key, 0) + v

    group, parts, sums = None, [], {}
    for b in batches:
        cols = {n: c.to_numpy(zero_copy_only=False) for n, c in zip([*at, *names], b.columns)}
        keys = [cols.pop(n) for n in at]
        new = np.zeros(max(b.num_rows - 1, 0), bool)
        for k in keys:
            new |= k[1:] != k[:-1]
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            here = tuple(k[lo] for k in keys)
            if here != group:
                if group is not None:
                    add(sums, group, parts)
                    if group[:3] != here[:3]:
                        yield from emit(group, sums)
                        sums = {}
                group, parts = here, []
            parts.append({n: c[lo:hi] for n, c in cols.items()})
    if group is not None:
        add(sums, group, parts)
        yield from emit(group, sums)


def pair_distances(postings: DataFrame, groups: DataFrame, p: AuditParams) -> DataFrame:
    """``(lang, a, b, value)`` for a < b: positions of two sources and their summed difference.

    ``postings``: ``lang, idx, term, p``; ``groups``: ``lang, idx, base, terms``
    per source (base share and kept terms of the language; base null if none).
    """
    tile = F.floor(F.col("idx") / F.lit(p.tile)).cast("int")
    blocks = F.greatest(F.ceil(F.col("terms") / F.lit(p.block_terms)), F.lit(1)).cast("int")
    tiles = groups.groupBy("lang").agg(F.max(tile).alias("last_tile"), F.max(blocks).alias("blocks"))
    # a tile meets every tile of its language once: as the first of the pair or as the second
    met = F.transform(
        F.sequence(F.lit(0), F.col("last_tile")),
        lambda j: F.struct(
            F.least(tile, j).alias("tile_a"), F.greatest(tile, j).alias("tile_b"), (tile > j).cast("int").alias("side")
        ),
    )
    base = (
        groups.join(tiles, "lang")
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        .select("lang", "idx", "block", F.lit(True).alias("base"), F.lit(0).cast("long").alias("term"),
                F.coalesce("base", F.lit(0)).cast("long").alias("p"),
                F.when(F.col("block") == 0, F.col("terms")).otherwise(0).cast("long").alias("terms"), F.inline(met))
    )
    hashed = F.xxhash64("term")
    posted = (
        postings.join(tiles, "lang")
        .select("lang", "idx", F.pmod(hashed, F.col("blocks").cast("long")).cast("int").alias("block"),
                F.lit(False).alias("base"), hashed.alias("term"), F.col("p").cast("long"),
                F.lit(0).cast("long").alias("terms"), F.inline(met))
    )
    dealt = ["lang", "tile_a", "tile_b", "block"]
    rows = base.unionByName(posted).repartition(*dealt).sortWithinPartitions(*dealt)
    sums = rows.select(*dealt, "base", "side", "idx", "term", "p", "terms").mapInArrow(
        _pairs_of, "lang string, a int, b int, value long"
    )
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


# ------------------------------------------------------------------ the audit


def audit(
    docs: DataFrame,
    p: AuditParams = AuditParams(),
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every (lang, source).

    Part ``pair``: each other source of the language, by summed difference of
    the shares of all kept terms (0 if there are none).  Part ``term``: the
    ``top`` kept terms that the source uses and whose share is above that in
    the language.  Ranks fall by value, ties by item.  Null text, language and
    source count as empty strings; repeated rows count as often as they occur;
    other columns are ignored; an empty table gives no rows.
    """
    postings = saved(kept_postings(term_counts(collapsed(docs, text_col, lang_col, source_col)), p), "postings")
    langs = postings.groupBy("lang").agg(F.count_if("first").alias("terms"), F.sum("n").alias("lang_total"))
    totals = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = docs.select(_blank(lang_col).alias("lang"), _blank(source_col).alias("source")).distinct()
    zero = F.lit(0).cast("long")
    groups = (
        every.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")])
        .withColumn("idx", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    )
    # no kept terms: no share
    groups = materialize(
        groups.withColumn("base", F.when(F.col("terms") > 0, share(zero, F.col("total"), F.greatest("terms", F.lit(1)), p)))
    )
    shares = postings.join(groups.drop("base"), ["lang", "source"]).withColumns(
        {
            "p": share(F.col("n"), F.col("total"), F.col("terms"), p),
            "q": share(F.col("lang_n"), F.col("lang_total"), F.col("terms"), p),
        }
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (
        shares.filter(F.col("p") > F.col("q"))
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= p.top)
    )
    distances = pair_distances(shares.select("lang", "idx", "term", "p"), groups, p)
    ways = [F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ("ab", "ba")]
    both = distances.select("lang", "value", F.inline(F.array(*ways)))
    names = groups.select("lang", "idx", "source")
    pairs = (
        both.join(names.withColumnRenamed("idx", "a"), ["lang", "a"])
        .join(names.select("lang", F.col("idx").alias("b"), F.col("source").alias("item")), ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        .withColumn("rank", F.row_number().over(ranked))
    )
    return pairs.unionByName(terms)

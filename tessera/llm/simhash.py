"""SimHash near-dedup with a Gray-order hierarchical index.

1. Fingerprints: the majority of each bit over the XXH64 hashes of the word
   shingles (vectorised in tasks).  Equal fingerprints are one node from here on.
2. Top of the index: shared masked bit patterns.  The 64 bits are cut into
   ``blocks`` parts; fingerprints within ``d`` bits agree in at least
   ``blocks - d`` of them, so each fingerprint goes under one top node per
   choice of that many parts, and every link is under some top node.
3. Below a top node, fingerprints lie in Gray order and nodes of 8 factor out
   the bits that all their members share (mask and pattern).  Two nodes are
   compared by the differences in bits that both share; those add up on the
   way down, and a pair of whole groups is pruned once they exceed ``d``.
   Links are merged in a union-find, which leaves one row per member.
4. Components over the remaining links: alternating large-star and small-star
   steps on Spark, each step written to the shared checkpoint folder.

A top node with more than ``node_rows`` members is cut into chunks, and each
pair of chunks becomes a node of its own, so no task holds an unbounded group
and no link is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name, materialize

FANOUT = 8
NODE_ROWS = 8192
PAIR_CHUNK = 1 << 18


# ---------------------------------------------------------------- fingerprints


def simhash64(text: str | None, k: int = 4, seed: int = 42) -> int:
    """SimHash of one text; 0 if it has no words.  Long texts are counted piece by piece."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII space
    if not words:
        return 0
    if len(words) < k:
        words, k = [b" ".join(words)], 1
    n, digest = len(words) - k + 1, xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = words[at : min(at + (1 << 15), n) + k - 1]
        hashes = [digest(s, seed) for s in map(b" ".join, zip(*(part[i:] for i in range(k))))]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, seed: int = 42
) -> DataFrame:
    """``(id, fp)`` per row; ``fp`` holds the 64 bits in a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            fps = [simhash64(t.as_py(), k, seed) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["id", "fp"]
            )

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ------------------------------------------------- index below one masked pattern


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _find(parent: np.ndarray, i: np.ndarray) -> np.ndarray:
    root = parent[i]
    while True:
        up = parent[root]
        if np.array_equal(up, root):
            return root
        root = up


def _union(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    while i.size:
        a, b = _find(parent, i), _find(parent, j)
        parent[i], parent[j] = a, b
        apart = a != b
        i, j = np.maximum(a, b)[apart], np.minimum(a, b)[apart]
        np.minimum.at(parent, i, j)


def link_groups(fps: np.ndarray, starts: np.ndarray, d: int) -> np.ndarray:
    """Root position of every fingerprint after linking within groups.

    ``fps`` (uint64) is sorted by (group, Gray rank); ``starts`` are the group
    starts.  Levels of shared-bit nodes are built bottom-up, then pairs of
    nodes are compared top-down for all groups at once.
    """
    parent = np.arange(len(fps))
    levels = []  # per level: pattern, shared mask, first child of each node (with end)
    pat, mask, first = fps, np.full(len(fps), ~np.uint64(0)), starts
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(fps))))
    while True:
        n = np.diff(np.append(first, len(pat)))
        if n.max(initial=0) <= 1:
            break
        pos = np.arange(len(pat)) - np.repeat(first, n)
        cut = np.flatnonzero(pos % FANOUT == 0)
        both = np.bitwise_and.reduceat(pat, cut)
        # a bit is shared if every member shares it and all agree on it
        shared = np.bitwise_and.reduceat(mask, cut) & ~(np.bitwise_or.reduceat(pat, cut) ^ both)
        levels.append((pat, mask, np.append(cut, len(pat))))
        group = group[cut]
        first = np.searchsorted(group, np.arange(len(starts)))
        pat, mask = both & shared, shared
    # one node per group now; open each against itself
    stack = [(len(levels) - 1, np.arange(len(pat)), np.arange(len(pat)))] if levels else []
    while stack:
        level, a, b = stack.pop()
        pat, mask, child = levels[level]
        na, nb = child[a + 1] - child[a], child[b + 1] - child[b]
        if len(a) > 1 and (na * nb).sum() > PAIR_CHUNK:
            half = len(a) // 2
            stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
            continue
        total = na * nb
        at = np.repeat(np.arange(len(a)), total)
        inner = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        x, y = child[a][at] + inner // nb[at], child[b][at] + inner % nb[at]
        keep = (x < y) if level == 0 else (x <= y)
        x, y = x[keep], y[keep]
        near = _popcount((pat[x] ^ pat[y]) & mask[x] & mask[y]) <= d
        x, y = x[near], y[near]
        if level == 0:
            _union(parent, x, y)
        elif len(x):
            stack.append((level - 1, x, y))
    return _find(parent, np.arange(len(fps)))


def _link_sorted(batches, d: int):
    """Links ``(fp, root)`` of rows that come sorted by (node columns, Gray rank)."""

    def flush(cols, final: bool):
        keys, fps = cols[:-1], cols[-1].view(np.uint64)
        new = np.zeros(len(fps), bool)
        new[:1] = True
        for c in keys:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        end = len(fps) if final else starts[-1]  # the last node may go on in the next batch
        starts = starts[starts < end]
        sizes = np.diff(np.append(starts, end))
        many = np.repeat(sizes > 1, sizes)
        out = None
        if many.any():
            some = fps[:end][many]
            sizes = sizes[sizes > 1]
            root = link_groups(some, np.cumsum(sizes) - sizes, d)
            linked = np.flatnonzero(root != np.arange(len(some)))
            if len(linked):
                u, v = some[linked].view(np.int64), some[root[linked]].view(np.int64)
                out = pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
        return out, [c[end:] for c in cols]

    held, rest = [], None
    for b in batches:
        held.append([np.asarray(c) for c in b.columns])
        if sum(len(h[0]) for h in held) >= 1 << 17:
            cols = [np.concatenate(c) for c in zip(*([rest] if rest else []), *held)]
            out, rest = flush(cols, False)
            held = []
            if out:
                yield out
    cols = [np.concatenate(c) for c in zip(*([rest] if rest else []), *held)]
    if cols and len(cols[0]):
        out, _ = flush(cols, True)
        if out:
            yield out


# --------------------------------------------------------------- links on Spark


def _masks(d: int, blocks: int) -> list[int]:
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    masks = [sum(c) for c in combinations(part, blocks - d)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _gray_rank(fp: Column) -> Column:
    for s in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, s))
    return fp


def link(nodes: DataFrame, d: int = 4, blocks: int = 6, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links ``(u, v)`` that connect distinct fingerprints ``fp`` within ``d`` bits.

    Not all pairs: per top node a spanning set, so that everything within
    ``d`` bits is connected.
    """
    if blocks <= d:
        raise ValueError("more parts than differing bits are needed")
    masks = F.array(
        *[F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(x)).alias("bits")) for i, x in enumerate(_masks(d, blocks))]
    )
    rows = nodes.select("fp", F.inline(masks))
    hot = rows.groupBy("m", "bits").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > node_rows)
    chunks = F.ceil(F.col("n") / F.lit(node_rows)).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks.cast("long")).cast("int")
    pairs = F.when(F.col("n").isNull(), F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), chunks - 1),
            lambda j: F.struct(F.least(own, j).alias("a"), F.greatest(own, j).alias("b")),
        )
    )
    dealt = rows.join(hot, ["m", "bits"], "left").select("m", "bits", "fp", F.inline(pairs))
    node = ["m", "bits", "a", "b"]
    ordered = (
        dealt.repartition(*node)
        .sortWithinPartitions(*node, _gray_rank(F.col("fp")))
        .select(*node, "fp")
    )
    return ordered.mapInArrow(lambda it: _link_sorted(it, d), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with a link; root is the smallest node reachable.

    Alternating large-star / small-star.  Each step is checkpointed: lineage
    stays short, and join sides are plain exchanges that Spark can split
    where one node has very many links.
    """
    edges = materialize(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    )

    def state(e):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    seen = state(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = materialize(
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(
            small.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        )
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 4,
    seed: int = 42,
    d: int = 4,
    blocks: int = 6,
    node_rows: int = NODE_ROWS,
) -> DataFrame:
    """One row per input row: ``id, fp, component_id`` (smallest id reachable over links).

    Null and empty texts and texts without words have fingerprint zero and
    link like any other.  Fewer than ``k`` words: the whole sequence is the
    one shingle.  A null id never is a component's id unless all its ids are
    null.  Rows may repeat; extra columns of ``docs`` are ignored; an empty
    table gives no rows.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, k, seed))
    nodes = materialize(prints.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(link(nodes, d, blocks, node_rows))
    rooted = materialize(
        nodes.join(roots, nodes.fp == roots.node, "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        )
    )
    # cut off, so that both join sides are plain exchanges and a component of many fingerprints can be split
    ids = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    labels = materialize(rooted.join(ids, "root").select("fp", "component_id"))
    return prints.join(labels, "fp").select("id", "fp", "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, d: int = 4) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id.

    Rows with a null id stay (nothing names them); rows that repeat an id stay with it.
    Rows go by id and text: another text under the same id stays.
    """
    text = F.xxhash64(F.col(text_col).cast("string"))
    # the text's hash travels inside the id; nulls last, as a null id is never a component's id
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), text.alias("text"))
    keyed = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    gone, mark = free_name(docs, "__gone"), free_name(docs, "__text")
    dropped = (
        near_groups(keyed, "key", "text", k=k, d=d)
        .filter(F.col("id.id") != F.col("component_id.id"))
        .select(F.struct(F.col("id.id").alias("id"), F.col("id.text").alias("text")).alias(gone))
    )
    marked = docs.withColumn(mark, text)
    same = (marked[id_col] == F.col(f"{gone}.id")) & (F.col(mark) == F.col(f"{gone}.text"))
    return marked.join(dropped, same, "left_anti").drop(mark)

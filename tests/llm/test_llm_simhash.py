import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.queries import QUERIES


def brute_fp(text, k=4):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, d=4):
    fps = [brute_fp(t) for _, t in rows]
    return brute_link([i for i, _ in rows], fps, d)


def brute_link(ids, fps, d):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= d:
                parent[find(i)] = find(j)
    comp = {}
    for i, x in enumerate(ids):
        if x is not None:
            comp[find(i)] = min(comp.get(find(i), x), x)
    return sorted(((x, format(f, "016x"), comp.get(find(i))) for i, (x, f) in enumerate(zip(ids, fps))), key=str)


def got(df, **kw):
    g = simhash.near_groups(df, **kw)
    return sorted(map(tuple, g.select("id", simhash.fingerprint_hex(F.col("fp")), "component_id").collect()), key=str)


@pytest.mark.parametrize("text", [None, "", "  \t ", "one", "Two words", "a b c d", "a b c d a b c d e", "É x Y z\x0bq", "w " * 70_000])
def test_fingerprint_is_the_majority_of_each_bit(text):
    assert simhash.simhash64(text) == brute_fp(text)


def test_hash_is_sparks_xxhash64(spark):
    h = spark.range(1).select(F.xxhash64(F.lit("ab cd ef gé"))).first()[0]
    assert h % 2**64 == xxhash.xxh64_intdigest("ab cd ef gé".encode(), 42)


def test_groups_equal_brute_force(docs):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(60)) for _ in range(25)]
    rows = []
    for i in range(160):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = "zz"
        rows.append((i, " ".join(words)))
    rows += [(200, None), (201, ""), (202, " "), (None, rows[0][1]), (3, rows[3][1]), (203, "a"), (204, "A")]
    expected = brute_components(rows)
    assert got(docs(rows, extra=True)) == expected
    assert got(docs(rows), node_rows=4) == expected  # hot nodes in chunks
    assert got(docs(rows), blocks=5) == expected


@pytest.mark.parametrize("d", [0, 2, 4, 7])
def test_index_finds_every_link_of_random_balls(d):
    rng = np.random.default_rng(d)
    fps = set()
    for c in rng.integers(0, 2**63, 12):
        for _ in range(60):
            f = int(c)
            for b in rng.integers(0, 64, rng.integers(0, 12)):
                f ^= 1 << int(b)
            fps.add(f)

    def rank(x):
        for s in (1, 2, 4, 8, 16, 32):
            x ^= x >> s
        return x

    fps = sorted(fps, key=rank)
    cut = len(fps) // 3
    groups = [sorted(fps[:cut], key=rank), sorted(fps[cut:], key=rank)]
    root = simhash.link_groups(np.array(groups[0] + groups[1], np.uint64), np.array([0, cut]), d)
    for at, g in ((0, groups[0]), (cut, groups[1])):
        expected = brute_link(list(range(len(g))), g, d)
        r = root[at : at + len(g)]
        smallest = {x: min(i for i in range(len(g)) if r[i] == x) for x in set(r)}
        assert expected == sorted(((i, format(f, "016x"), smallest[r[i]]) for i, f in enumerate(g)), key=str)


def test_components_of_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(500, i) for i in range(501, 600)] + [(499, 555), (7, 7)]
    df = spark.createDataFrame(chain + [(b, a) for a, b in hub], "u long, v long")
    out = dict(map(tuple, simhash.components(df).collect()))
    assert out == {i: 100 for i in range(101, 161)} | {i: 499 for i in range(500, 600)}


def test_empty_table_and_dedup(docs):
    assert got(docs([])) == []
    df = docs([(5, "a b c d e"), (2, "A b c d e"), (9, "other words entirely here now"), (None, "a b c d e")], extra=True)
    out = simhash.dedup(df)
    assert out.columns == df.columns and sorted(str(r.doc_id) for r in out.collect()) == ["2", "9", "None"]


def test_dedup_removes_rows_not_ids(docs):
    same = "one text that stands in this table more than once under several ids"
    rows = [(1, same), (5, same), (5, "quite another story with words of its own about rivers and boats"), (None, same)]
    out = simhash.dedup(docs(rows, extra=True)).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted([rows[0], rows[2], rows[3]], key=str)



def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    src = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op2_simhash"](spark, sf).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, rows), key=str) == brute_components(src)

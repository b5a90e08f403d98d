import hashlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import sharding
from tessera.llm.queries import QUERIES, SHARDS


def brute_table(shards, slots):
    """By whole preference lists: in turn, every shard takes the first free slot of its list."""
    names = sorted(shards)
    prefs = []
    for n in names:
        offset = sharding._number(n, "offset") % slots
        skip = 1 + sharding._number(n, "skip") % (slots - 1)
        prefs.append([(offset + j * skip) % slots for j in range(slots)])
    table = {}
    while True:
        for i, p in enumerate(prefs):
            table[next(s for s in p if s not in table)] = i
            if len(table) == slots:
                return [table[s] for s in range(slots)]


@pytest.mark.parametrize("shards,slots", [(["a"], 7), (["a", "b", "c"], 13), ([f"s{i}" for i in range(11)], 211)])
def test_table_equals_brute_force(shards, slots):
    assert sharding.lookup_table(shards, slots).tolist() == brute_table(shards, slots)


def test_shares_are_even_and_changes_move_little():
    names = [f"s{i}" for i in range(50)]
    a = sharding.lookup_table(names)
    sizes = np.bincount(a)
    assert sizes.max() - sizes.min() <= 1
    b = sharding.lookup_table([n for n in names if n != "s7"])
    before, after = np.array(sorted(names))[a], np.array(sorted(n for n in names if n != "s7"))[b]
    moved = (before != after) & (before != "s7")
    assert moved.mean() < 0.05


def test_bad_lists():
    for shards, slots in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards, slots)


def test_every_row_is_placed(docs):
    rows = [(1, "a"), (1, "b"), (None, "c"), (2, None), (3, "x" * 100_000)]
    df = docs(rows, extra=True)
    out = sharding.place(df, ["a", "b", "c"], slots=13).collect()
    table = brute_table(["a", "b", "c"], 13)
    assert len(out) == len(rows)
    for r in out:
        key = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 13
        assert (r.slot, r.shard) == (slot, "abc"[table[slot]])
    assert sharding.place(docs([]), ["a"]).count() == 0


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    ids = [r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    table = sharding.lookup_table(SHARDS)
    expected = Counter()
    for i in ids:
        slot = int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        expected[i, slot, sorted(SHARDS)[table[slot]]] += 1
    assert Counter(map(tuple, QUERIES["op7_sharding"](spark, sf).collect())) == expected

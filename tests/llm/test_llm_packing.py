import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import packing
from tessera.llm.queries import QUERIES


def padding(cells, ends):
    return sum(n * (min(e for e in ends if e >= x) - x) for x, n in cells)


@pytest.mark.parametrize("seed", range(8))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    cells = sorted({rng.randrange(0, 60): rng.randrange(1, 9) for _ in range(11)}.items())
    xs = [x for x, _ in cells]
    for k in (1, 2, 3, 20):
        best = min(
            padding(cells, (*c, xs[-1])) for m in range(min(k, len(xs))) for c in itertools.combinations(xs[:-1], m)
        )
        ends = packing.best_boundaries(cells, k)
        assert len(ends) <= k and ends[-1] == xs[-1] and padding(cells, ends) == best


def exact(cells, buckets):
    """The quadratic programme over all pairs of cells; least padding with at most ``buckets``."""
    x, n = np.array([c for c, _ in cells]), np.array([m for _, m in cells])
    rows, tokens = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(x * n))
    cost = np.full(len(x) + 1, 1 << 60)
    cost[0], best = 0, 1 << 60
    for _ in range(min(buckets, len(x))):
        new = np.full(len(x) + 1, 1 << 60)
        for j in range(1, len(x) + 1):
            new[j] = (cost[:j] + x[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])).min()
        cost = new
        best = min(best, int(cost[-1]))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_boundaries_equal_the_exact_programme_on_long_texts(seed):
    rng = random.Random(seed)
    cells = sorted({int(rng.lognormvariate(6, 1.5)) % 20_000: rng.randrange(1, 500) for _ in range(700)}.items())
    for k in (1, 2, 8, 50):
        ends = packing.best_boundaries(cells, k)
        at = np.searchsorted(ends, [x for x, _ in cells])
        assert sum(n * (ends[i] - x) for i, (x, n) in zip(at, cells)) == exact(cells, k)


def test_histogram_cells_are_few_and_end_at_real_lengths(spark):
    exact_to = 1 << packing.EXACT_BITS
    df = spark.range(0, 3 * exact_to).select(F.col("id"), packing.cell(F.col("id")).alias("c"))
    assert df.filter((F.col("id") <= exact_to) & (F.col("c") != F.col("id"))).count() == 0
    assert df.filter((F.col("c") > F.col("id")) | (F.col("id") - F.col("c") > F.col("id") / 32_768)).count() == 0
    long = spark.createDataFrame([(10**6 + 3,), (10**6 + 5,), (7,), (None,)], "n_tokens long")
    assert sorted(tuple(r) for r in packing.histogram(long).collect()) == [(0, 1, 0), (7, 1, 7), (10**6 + 5, 2, 2 * 10**6 + 8)]


def test_equal_long_texts_need_no_padding(docs):
    out = packing.packed(docs([(i, "w " * 1001) for i in range(20)])).collect()
    assert {r.padded_to for r in out} == {1001} and sum(r.padding for r in out) == 0


def test_equal_rows_without_an_id_are_spread(docs, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 10)
    p = packing.PackParams(budget=100)
    check(packing.packed(docs([(None, "a b c")] * 200), p).collect(), p, 200)


def check(rows, p, n_in):
    assert len(rows) == n_in
    batches = defaultdict(list)
    for r in rows:
        assert r.n_tokens <= r.padded_to and r.padding == r.padded_to - r.n_tokens
        batches[r.bucket, r.batch].append(r)
    by_bucket = defaultdict(list)
    for (bucket, batch), members in batches.items():
        size = members[0].padded_to
        fit = max(1, p.budget // max(size, 1))
        assert len(members) <= fit and sorted(m.slot for m in members) == list(range(len(members)))
        by_bucket[bucket].append((batch, len(members), fit))
    for found in by_bucket.values():  # only the last batch of a bucket may have room
        found.sort()
        assert [b for b, _, _ in found] == list(range(len(found)))
        assert all(n == fit for _, n, fit in found[:-1])


def test_batches_are_full_and_complete(docs, monkeypatch):
    rng = random.Random(3)
    rows = [(i, "w " * rng.choice([0, 1, 5, 5, 5, 40, 41, 300])) for i in range(300)]
    rows += [(None, "a b"), (7, rows[7][1]), (900, None), (901, "x " * 5000)]
    p = packing.PackParams(buckets=4, budget=100)
    check(packing.packed(docs(rows, extra=True), p).collect(), p, len(rows))
    monkeypatch.setattr(packing, "SLICE_ROWS", 7)  # many slices per bucket
    check(packing.packed(docs(rows), p).collect(), p, len(rows))


def test_empty_table_and_only_empty_texts(docs):
    assert packing.packed(docs([])).count() == 0
    p = packing.PackParams()
    check(packing.packed(docs([(1, None), (2, "")])).collect(), p, 2)


def test_padding_is_the_least_for_the_buckets(docs):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(0, 30)) for i in range(120)]
    out = packing.packed(docs(rows), packing.PackParams(buckets=3)).collect()
    cells = defaultdict(int)
    for r in out:
        cells[r.n_tokens] += 1
    xs = sorted(cells)
    best = min(padding(cells.items(), (*c, xs[-1])) for m in range(3) for c in itertools.combinations(xs[:-1], m))
    assert sum(r.padding for r in out) == best


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    check(QUERIES["op5_packing"](spark, sf).collect(), packing.PackParams(), n)

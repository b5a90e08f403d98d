import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import divergence as D

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def brute(rows, p):
    """The audit from its definition: every kept term of every group."""
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = [lower(t) for t in TERM.findall(text)]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {r[1] for r in rows}:
        kept = sorted(t for t, n in docs[lang].items() if n >= p.min_docs)
        sources = sorted({r[2] for r in rows if r[1] == lang})

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + p.smooth) // (total + p.smooth * len(kept)) for t in kept}

        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])
        q, of = shares(whole), {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(of[s][t] - of[o][t]) for t in kept), o) for o in sources if o != s]
            above = [(of[s][t] - q[t], t) for t in kept if counts[lang, s][t] and of[s][t] > q[t]]
            for part, found, top in (("pair", pairs, None), ("term", above, p.top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(found[:top], 1)]
    return sorted(out)


def run(spark, rows, params, **extra):
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    out = D.audit(df, params)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in out.collect())


def sample(n, seed):
    r = random.Random(seed)
    words = ["".join(r.choices("abcé", k=r.randint(1, 3))) for _ in range(40)]
    texts = [" ".join(r.choices(words, k=r.randint(0, 12))) for _ in range(n // 2)]
    # copies, and a hot source with a third of the rows
    return [
        (r.choice(texts), r.choice(["en", "de", None]), r.choice(["hot", r.choice(["s1", "s2", "s3", None, "é"])]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("p", [D.AuditParams(min_docs=4, top=6), D.AuditParams(min_docs=2, tile=2, block_terms=3)])
def test_audit_equals_brute_force(spark, p):
    rows = sample(150, 3)
    assert run(spark, rows, p) == brute(rows, p)


def test_edge_cases(spark):
    rows = [
        (None, None, None), ("", "en", "empty"), ("Ünï ünï A1b2 can't\x7fend", "en", "a"), ("a " * 50_000, "en", "a"),
        ("a b", "en", "b"), ("a b", "en", "b"), ("a b", "en", "a"), ("123 ...", "xx", "only"), ("K k ſ", "en", "b"),
    ]
    for p in (D.AuditParams(min_docs=1), D.AuditParams(min_docs=2), D.AuditParams(min_docs=99)):
        assert run(spark, rows, p, term="x", n=1, idx=7, digest="d", p=0.5, value="v", rank="r") == brute(rows, p)


def test_empty_table(spark):
    assert run(spark, [("a", "b", "c")][:0], D.AuditParams()) == []


def test_equal_texts_are_tokenised_once(spark):
    rows = [("same text", "en", "a")] * 5 + [("same text", "en", "b"), ("same text", "de", "a"), ("Same text", "en", "a")]
    df = D.collapsed(spark.createDataFrame(rows, "text string, lang string, source string"))
    found = {(r.lang, r.text): sorted((s.source, s.n) for s in r.sources) for r in df.collect()}
    assert found == {
        ("en", "same text"): [("a", 5), ("b", 1)],
        ("de", "same text"): [("a", 1)],
        ("en", "Same text"): [("a", 1)],
    }


@given(st.text("aB1 é\n-[]`{~\x7f\x00K", max_size=40))
def test_terms_equal_the_pattern(text):
    assert [t.decode() for t in D.terms_of(text.encode())] == [lower(t) for t in TERM.findall(text)]


@settings(deadline=None)
@given(st.integers(2, 6), st.integers(0, 12), st.integers(0, 10**6), st.booleans())
def test_pair_sums_equal_a_dense_table(sources, terms, seed, two_tiles):
    r = np.random.default_rng(seed)
    base = r.integers(1, 50, sources)
    dense = np.where(r.random((sources, terms)) < 0.5, base[:, None] + r.integers(0, 60, (sources, terms)), base[:, None])
    has = dense != base[:, None]
    s, t = np.nonzero(has)
    order = r.permutation(sources + len(s))
    zero = np.zeros(len(s), int)
    side = (np.arange(sources) >= sources // 2).astype(int) if two_tiles else np.zeros(sources, int)
    rows = {
        "base": np.array([True] * sources + [False] * len(s))[order],
        "side": np.concatenate([side, side[s]])[order],
        "idx": np.concatenate([np.arange(sources), s])[order],
        "term": np.concatenate([np.zeros(sources, int), t * 977])[order],
        "p": np.concatenate([base, dense[s, t]])[order],
        "terms": np.concatenate([np.full(sources, terms), zero])[order],
    }
    found = {(int(a), int(j)): int(v) for a, b, vs in D._pair_sums(rows, not two_tiles) for a, j, v in zip(a, b, vs)}
    wanted = {
        (a, b): int(np.abs(dense[a] - dense[b]).sum())
        for a in range(sources) for b in range(a + 1, sources) if not two_tiles or side[a] != side[b]
    }
    assert found == wanted


def test_shares_are_exact(spark):
    rows = [(0, 1, 1), (7, 7, 1), (10**13 + 1, 3 * 10**13 + 1, 10**7), (123456789012, 99999999999999, 3_000_001)]
    df = spark.createDataFrame(rows, "c long, n long, v long")
    got = [r.p for r in df.select(D.share(F.col("c"), F.col("n"), F.col("v"), D.AuditParams()).alias("p")).collect()]
    assert got == [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in rows]

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import toxicity as X
from tessera.llm.queries import QUERIES

GOOD = "river table green walk window bread summer little house garden".split()
BAD = "vilefoul vilemuck vilerot".split()


def corpus(n, seed=0):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(GOOD) + rng.choice(["", "s", "ing"]) for _ in range(rng.randint(3, 40))]
        toxic = rng.random() < 0.25
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def labels_df(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("clash"))


def test_index_is_exact():
    rng = np.random.default_rng(0)
    vectors = []
    for _ in range(500):
        ids = np.sort(rng.choice(80, rng.integers(1, 12), replace=False)).astype(np.int32)
        w = rng.random(len(ids)) ** 3
        vectors.append((ids, w / np.sqrt(w @ w)))
    dense = np.zeros((500, 80))
    for i, (ids, w) in enumerate(vectors):
        dense[i, ids] = w
    index = X.BlockMaxIndex(vectors, 80)
    for ids, w in vectors[:100]:
        q = np.zeros(80)
        q[ids] = w
        cos = dense @ q
        best, got = index.nearest(ids, w, 9)
        assert np.allclose(got, np.sort(cos)[::-1][:9][: len(got)]) and np.allclose(cos[best], got)
    assert len(index.nearest(np.zeros(0, np.int32), np.zeros(0), 5)[0]) == 0


def test_block_bounds_skip_blocks(monkeypatch):
    vectors = [(np.array([i // X.BLOCK], np.int32), np.ones(1)) for i in range(X.BLOCK * 20)]
    index = X.BlockMaxIndex(vectors, 20)
    best, cos = index.nearest(np.array([3], np.int32), np.ones(1), 5)
    assert best.tolist() == [3 * X.BLOCK + i for i in range(5)] and cos.tolist() == [1.0] * 5


def test_term_counts_equal_brute_force(spark, docs):
    rows, labels = corpus(60)
    marked = dict(labels)
    df = spark.createDataFrame([(t, marked[i]) for i, t in rows] + [(None, 1), ("", 0)], "text string, toxic int")
    got = {r.term: (r.docs, r.toxic) for r in X.term_counts(df, X.ToxicParams()).collect()}
    expected = {}
    for i, t in rows:
        for g in set().union(*(X.grams(w, 5) for w in X.words_of(t))):
            a, b = expected.get(g, (0, 0))
            expected[g] = (a + 1, b + marked[i])
    assert got == expected


def test_held_out_accuracy_and_edges(spark, docs):
    rows, labels = corpus(900)
    train = [x for x in labels if x[0] % 3]
    more = [(2000, None), (2001, ""), (2002, "!!! 123"), (2003, "unknown"), (2004, "vilefouls " + "river " * 60_000), (2005, "vilefoul"), (2005, "vilefoul"), (None, "VILEMUCK!")]
    df = docs(rows + more, extra=True).drop("score", "label").withColumn("toxicity", F.lit("clash"))
    model = X.fit(df, labels_df(spark, train + [(None, 1), (5, None)]))
    out = X.score(df, model)
    assert set(out.columns) == set(df.columns) | {"toxic_flag", "toxic_evidence", "toxic_cosine"}
    got = {}
    for r in out.collect():
        assert 0 <= r.toxicity <= 1 and r.toxic_flag == (r.toxicity >= 0.3)
        got.setdefault(r.doc_id, []).append(r.toxic_flag)
    marks = dict(labels)
    held = [i for i in marks if i % 3 == 0]
    assert sum(got[i][0] == bool(marks[i]) for i in held) / len(held) > 0.97
    assert [got[i] for i in (2000, 2001, 2002, 2003, 2004, 2005, None)] == [[False]] * 4 + [[True], [True, True], [True]]


def test_evidence_are_near_labelled_examples(spark, docs):
    rows, labels = corpus(400)
    out = X.score(docs(rows), X.fit(docs(rows), labels_df(spark, labels))).filter("toxic_flag").collect()
    marks = dict(labels)
    assert out and all(r.toxic_evidence and all(i in marks for i in r.toxic_evidence) for r in out)


def test_nothing_to_learn_from(spark, docs):
    df = docs([(1, "a"), (2, None)])
    assert X.fit(df, labels_df(spark, [])) is None
    assert [r.toxicity for r in X.score(df, None).collect()] == [0.0, 0.0]
    one = X.fit(df, labels_df(spark, [(1, 0)]))
    assert not any(r.toxic_flag for r in X.score(df, one).collect())
    assert X.score(docs([]), one).count() == 0


def test_query_ignores_labels_of_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op8_toxicity"](spark, sf).collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(r.doc_id for r in out) == sorted(ids)
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3)
        assert not set(r.evidence) & {i for i in marks if zlib.crc32(str(i).encode()) % 4 == 2}
    held = [r for r in out if r.held_out and r.doc_id in marks]
    assert sum(r.predicted == marks[r.doc_id] for r in held) / len(held) > 0.9

"""Toxicity from the nearest labelled examples, by TF-IDF cosine over toxic terms.

The classifier is fitted on a bounded sample of the labelled texts that may be
learned from (``ToxicParams.fit_rows``, picked by a hash of the id).  Terms
are the 5-character pieces of words (with word ends), so inflected and
compound forms share terms; those that speak most for toxicity (chi-square)
form the vocabulary, and no others count: the cosine is over a toxic lexicon,
not over whole texts.  Part of the sample becomes a block-max inverted index:
postings by term, cut into blocks of examples, with the largest weight of each
term per block.  A text visits blocks by falling upper bound and stops once no
block can beat its k-th best example, so the neighbours are exact.  Their
votes, weighted by distance, are calibrated on the rest of the sample.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, saved

BLOCK = 64
CACHE_WORDS = 300_000


@dataclass(frozen=True)
class ToxicParams:
    """``fit_rows`` labelled texts, ``examples`` per label and ``terms`` bound the model at any number of rows."""

    fit_rows: int = 25_000
    gram: int = 5
    terms: int = 2000
    min_docs: int = 3
    min_chi2: float = 30.0
    min_share: float = 0.5  # of the texts with the term, at least this many are toxic
    examples: int = 2000
    neighbours: int = 15
    threshold: float = 0.3


def grams(word: str, n: int) -> set[str]:
    """The ``n``-character pieces of ``^word$``; a shorter word is one piece."""
    w = f"^{word}$"
    return {w[i : i + n] for i in range(max(1, len(w) - n + 1))}


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\W\d_]+", (text or "").lower())


class _Words:
    """Word -> something, kept for a bounded number of words."""

    def __init__(self, make):
        self.make, self.known = make, {}

    def __call__(self, word: str):
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            found = self.known[word] = self.make(word)
        return found


# -------------------------------------------------------------------- learning


def term_counts(labelled: DataFrame, p: ToxicParams) -> DataFrame:
    """``(term, docs, toxic)`` over all rows of ``labelled(text, toxic)``; counted per task, then summed."""

    def run(batches):
        pieces = _Words(lambda w: tuple(grams(w, p.gram)))
        count: tuple[Counter, Counter] = (Counter(), Counter())

        def flush():
            terms = list(count[0] | count[1])
            toxic = [count[1][t] for t in terms]
            every = [count[0][t] + x for t, x in zip(terms, toxic)]
            return pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array(every, pa.int64()), pa.array(toxic, pa.int64())],
                ["term", "docs", "toxic"],
            )

        for b in batches:
            for t, label in zip(b.column(0), b.column(1)):
                terms: set[str] = set()
                for w in set(words_of(t.as_py())):
                    terms.update(pieces(w))
                count[1 if label.as_py() else 0].update(terms)
                if len(count[0]) + len(count[1]) > 400_000:
                    yield flush()
                    count = (Counter(), Counter())
        yield flush()

    parts = labelled.select("text", "toxic").mapInArrow(run, "term string, docs long, toxic long")
    return parts.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"))


def choose_terms(counts: DataFrame, n: int, n_toxic: int, p: ToxicParams) -> list[tuple[str, float]]:
    """At most ``p.terms`` terms ``(term, idf)`` by chi-square, of those that mostly stand in toxic texts."""
    a, docs = F.col("toxic").cast("double"), F.col("docs").cast("double")
    pos, neg = F.lit(float(n_toxic)), F.lit(float(n - n_toxic))
    expected = docs * pos / F.lit(float(n))
    spread = expected * neg / F.lit(float(n)) * (F.lit(float(n)) - docs) / F.lit(float(n))
    chi2 = F.when(spread > 0, (a - expected) * (a - expected) / spread).otherwise(F.lit(0.0))
    rows = (
        counts.filter(F.col("docs") >= p.min_docs)
        .withColumn("chi2", chi2)
        .filter((F.col("chi2") >= p.min_chi2) & (a > expected) & (a >= p.min_share * docs))
        .orderBy(F.desc("chi2"), "term")
        .limit(p.terms)
        .collect()
    )
    return [(r.term, float(np.log((1 + n) / (1 + r.docs)) + 1)) for r in rows]


@dataclass
class Vectors:
    """TF-IDF over the chosen terms: sorted term numbers and unit-length weights."""

    terms: dict[str, int]
    idf: np.ndarray
    gram: int
    words: _Words = field(init=False)

    def __post_init__(self):
        self.words = _Words(
            lambda w: tuple(t for g in grams(w, self.gram) if (t := self.terms.get(g)) is not None)
        )

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        count: Counter = Counter()
        for w in words_of(text):
            if found := self.words(w):
                count.update(found)
        ids = np.array(sorted(count), np.int32)
        if not ids.size:
            return ids, np.zeros(0)
        v = np.log1p([count[i] for i in ids]) * self.idf[ids]
        return ids, v / np.sqrt(v @ v)


class BlockMaxIndex:
    """Inverted index over unit vectors with the largest weight of each term per block of examples."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.n = len(vectors)
        self.blocks = -(-self.n // BLOCK)
        doc = np.repeat(np.arange(self.n), [len(i) for i, _ in vectors])
        term = np.concatenate([i for i, _ in vectors] or [np.zeros(0, np.int32)])
        weight = np.concatenate([w for _, w in vectors] or [np.zeros(0)])
        order = np.lexsort((doc, term))
        self.doc, self.weight = doc[order], weight[order]
        cell = term[order].astype(np.int64) * self.blocks + self.doc // BLOCK
        self.start = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1)).reshape(-1)
        self.most = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(n_terms, self.blocks)

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of the largest cosine above 0 (ties: lower number first), and the cosines."""
        if not ids.size or not self.n:
            return np.zeros(0, int), np.zeros(0)
        bound = weights @ self.most[ids]
        best, cos = np.zeros(0, int), np.zeros(0)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(best) == k and bound[b] < cos[-1] - 1e-12):
                break
            score = np.zeros(BLOCK)
            for i, w in zip(ids, weights):
                lo, hi = self.start[i * self.blocks + b], self.start[i * self.blocks + b + 1]
                score[self.doc[lo:hi] - b * BLOCK] += w * self.weight[lo:hi]
            hit = np.flatnonzero(score)
            best, cos = np.append(best, hit + b * BLOCK), np.append(cos, score[hit])
            top = np.lexsort((best, -cos))[:k]
            best, cos = best[top], cos[top]
        return best, cos


@dataclass
class ToxicModel:
    """Bounded: vocabulary, example vectors with labels and ids, calibration steps."""

    terms: list[tuple[str, float]]
    examples: list[tuple[int, int, np.ndarray, np.ndarray]]  # id, label, terms, weights
    class_weight: tuple[float, float]
    steps: tuple[list[float], list[float]]  # votes and the probabilities they stand for
    params: ToxicParams


class Scorer:
    def __init__(self, model: ToxicModel):
        self.p, self.model = model.params, model
        self.vectors = Vectors(
            {t: i for i, (t, _) in enumerate(model.terms)}, np.array([x for _, x in model.terms]), self.p.gram
        )
        # neighbouring numbers share their heaviest term, which makes block maxima tight
        heaviest = [int(i[np.argmax(w)]) for _, _, i, w in model.examples]
        self.examples = [model.examples[j] for j in np.argsort(heaviest, kind="stable")]
        self.index = BlockMaxIndex([(i, w) for _, _, i, w in self.examples], len(model.terms))
        self.known: dict = {}

    def vote(self, text: str | None) -> tuple[float, list[int], float]:
        """Share of the toxic votes in -1 (no neighbour) or 0 to 1; evidence ids; largest cosine."""
        return self.vote_of(*self.vectors(text))

    def vote_of(self, ids: np.ndarray, weights: np.ndarray) -> tuple[float, list[int], float]:
        if not ids.size:
            return -1.0, [], 0.0
        key = (ids.tobytes(), weights.tobytes())
        if key not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            best, cos = self.index.nearest(ids, weights, self.p.neighbours)
            votes = [0.0, 0.0]
            for j, c in zip(best, cos):
                label = self.examples[j][1]
                votes[label] += self.model.class_weight[label] / (1.05 - min(1.0, c))
            total = sum(votes)
            found = [self.examples[j][0] for j in best[:5]]
            self.known[key] = (votes[1] / total if total else -1.0, found, float(cos[0]) if len(cos) else 0.0)
        return self.known[key]

    def probability(self, vote: float) -> float:
        x, y = self.model.steps
        return float(np.interp(vote, x, y)) if x else 0.0


def _isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[list[float], list[float]]:
    """Rising calibration steps by pooling adjacent violators; each pool is pulled to the base rate a little."""
    if not len(votes):
        return [], []
    base = labels.mean()
    xs, group = np.unique(votes, return_inverse=True)
    n = np.bincount(group).astype(float)
    s = np.bincount(group, labels).astype(float)
    pools: list[list[float]] = []  # first x, last x, rows, toxic
    for x, a, b in zip(xs, n, s):
        pools.append([x, x, a, b])
        while len(pools) > 1 and pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
    x, y = [], []
    for lo, hi, a, b in pools:
        prob = (b + base) / (a + 1)
        for at in dict.fromkeys((lo, hi)):
            x.append(float(at))
            y.append(float(max(prob, y[-1] if y else 0.0)))
    return x, y


def fit(
    docs: DataFrame,
    labels: DataFrame,
    p: ToxicParams = ToxicParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicModel | None:
    """Learn from the rows of ``docs`` that ``labels`` marks; null labels and ids are left out.

    An id with labels of both kinds counts as toxic.  None if there are no
    labelled texts.
    """
    pick = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30))
    marks = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
        .withColumn("pick", pick)
        .orderBy("pick", "id")
        .limit(p.fit_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # at most fit_rows narrow rows: broadcast, so that no text is shuffled for the join
    marked = texts.join(F.broadcast(saved(marks, "marks")), "id")
    rows = saved(marked.groupBy("id", "toxic", "pick").agg(F.max("text").alias("text")), "labelled")
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n, n_toxic = sum(sizes.values()), sizes.get(1, 0)
    if not n:
        return None
    terms = choose_terms(term_counts(rows, p), n, n_toxic, p)
    vectors = Vectors({t: i for i, (t, _) in enumerate(terms)}, np.array([x for _, x in terms]), p.gram)

    def run(batches):
        for b in batches:
            found = [vectors(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(2),
                    b.column(3),
                    pa.array([i for i, _ in found], pa.list_(pa.int32())),
                    pa.array([w for _, w in found], pa.list_(pa.float64())),
                ],
                ["id", "toxic", "pick", "terms", "weights"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    vec = materialize(
        rows.select("id", "text", "toxic", "pick").mapInArrow(
            run, f"id {kind}, toxic int, pick long, terms array<int>, weights array<double>"
        )
    )
    # every fourth row by hash calibrates, the others are examples; texts without terms have no neighbours
    calibrates = F.pmod("pick", F.lit(4)) == 0
    useful = vec.filter(~calibrates & (F.size("terms") > 0))
    examples, weight = [], [0.0, 0.0]
    for label in (0, 1):
        some = useful.filter(F.col("toxic") == label)
        rows_ = some.orderBy("pick", "id").limit(p.examples).collect()
        examples += [(r.id, label, np.array(r.terms, np.int32), np.array(r.weights)) for r in rows_]
        weight[label] = some.count() / max(1, len(rows_))
    model = ToxicModel(terms, examples, (weight[0], weight[1]), ([], []), p)
    scorer = Scorer(model)
    votes, marks_ = [], []
    for r in vec.filter(calibrates).orderBy("pick", "id").collect():
        votes.append(scorer.vote_of(np.array(r.terms, np.int32), np.array(r.weights))[0])
        marks_.append(r.toxic)
    model.steps = _isotonic(np.array(votes), np.array(marks_, float))
    return model


# --------------------------------------------------------------------- scoring


def score(
    docs: DataFrame, model: ToxicModel | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1), ``toxic_flag``, ``toxic_evidence`` (ids) and ``toxic_cosine``.

    Only the text enters a score.  Texts without any known term (null and
    empty ones too) get the calibrated share of toxic ones among such texts;
    without a model every score is 0.  Columns of those names are replaced.
    """
    out = ["toxicity", "toxic_flag", "toxic_evidence", "toxic_cosine"]
    kept = docs.drop(*out)
    p = model.params if model else ToxicParams()
    # plain values: a broadcast must load where this package is not installed
    plain = (model.terms, model.examples, model.class_weight, model.steps) if model else None
    shared = docs.sparkSession.sparkContext.broadcast(plain)
    schema = T.StructType(
        [
            *kept.schema.fields,
            T.StructField(out[0], T.DoubleType()),
            T.StructField(out[1], T.BooleanType()),
            T.StructField(out[2], T.ArrayType(T.LongType())),
            T.StructField(out[3], T.DoubleType()),
        ]
    )
    at = kept.columns.index(text_col)

    def run(batches):
        scorer = Scorer(ToxicModel(*shared.value, p)) if shared.value else None
        for b in batches:
            votes = [scorer.vote(t.as_py()) if scorer else (-1.0, [], 0.0) for t in b.column(at)]
            prob = [scorer.probability(v[0]) if scorer else 0.0 for v in votes]
            yield pa.RecordBatch.from_arrays(
                [
                    *b.columns,
                    pa.array(prob, pa.float64()),
                    pa.array([scorer is not None and x >= p.threshold for x in prob], pa.bool_()),
                    pa.array([v[1] for v in votes], pa.list_(pa.int64())),
                    pa.array([v[2] for v in votes], pa.float64()),
                ],
                [*b.schema.names, *out],
            )

    return kept.mapInArrow(run, schema)


def fold(id_col: str = "doc_id", of: int = 4) -> Column:
    """crc32 of the id as text, modulo ``of`` (null id: null)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(of))

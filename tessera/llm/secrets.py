"""Secret scans: three patterns, and zstandard novelty of strings in a sensitive context.

1. Patterns (assignments, access keys, hex runs) give the base findings.
2. Identifier dictionary: the words of all texts are counted (per task, then
   summed), and those in most documents, commonest last, become a raw-content
   zstandard dictionary of ``dict_bytes``.  Only runs of letters count as
   words, so no key gets into it whole, however often it is copied.
3. Novelty: a candidate is a long run of key characters with letters and
   digits.  Its marginal size is what the surrounding code grows by, in bytes
   under that dictionary, when the candidate stands in it, against the same
   code without it.  Words, identifiers and parts of what stands around cost
   little; a random key costs nearly its length.  Copies of the candidate itself are no surroundings.  Candidates near a sensitive
   word whose bytes a character reach ``min_novelty`` are reported as ``novel``
   beside the base findings.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import saved

#: Kinds in the order in which equal starts are listed; pattern, group that is measured, least length.
PATTERNS = (
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        12,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),
)
NOVEL = "novel"
KINDS = [name for name, *_ in PATTERNS] + [NOVEL]
#: Words that make their surroundings sensitive.
SENSITIVE = (
    *("passw", "passphrase", "pwd", "secret", "token", "credential", "authoriz", "bearer", "signature"),
    *(f"{w}{gap}key" for w in ("api", "access", "private") for gap in ("", "_", "-", " ")),
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: A key has letters and digits; a date or a number with a unit has few letters.
MIXED = re.compile(r"(?=(?:[^A-Za-z]*[A-Za-z]){4})(?=(?:[^0-9]*[0-9]){2})")
#: Letters of ASCII stay, all other bytes become spaces; hex digits become one letter.
LETTERS = bytes(b if chr(b).isalpha() and b < 128 else 32 for b in range(256))
HEX = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
WORD_BYTES = range(4, 25)
#: Ends what is compressed.  zstd stores a block raw when compression gains too little, which would hide
#: what the candidate adds; this run always gains, at the same cost with and without it.
RUN = b"\0" * 64
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Words that a task counts before it hands them to Spark, which sums them; rows of a batch handed over.
FLUSH_WORDS = 50_000
BATCH_WORDS = 10_000


@dataclass(frozen=True)
class SecretParams:
    dict_bytes: int = 32_768  # bounds the identifier dictionary
    context_chars: int = 64  # a sensitive word must stand this near before a candidate
    around_chars: int = 256  # code on either side that a candidate is measured against
    min_novelty: float = 0.75  # marginal bytes per character
    level: int = 9


# ------------------------------------------------------- identifier dictionary


def _counted_words(batches, flush_words: int = FLUSH_WORDS):
    """``(word, docs)`` batches of the texts in ``batches``; words of one task may come several times.

    A task holds about ``flush_words`` words at a time, however many its texts
    have; what it hands over becomes small batches, so that neither side holds
    a task's words twice.
    """
    count: Counter = Counter()

    def flush():
        words = [w for w in count if len(w) in WORD_BYTES]
        for at in range(0, len(words), BATCH_WORDS):
            some = words[at : at + BATCH_WORDS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.string()), pa.array([count[w] for w in some], pa.int64())], ["word", "docs"]
            )
        count.clear()

    for b in batches:
        for t in b.column(0):
            count.update(set((t.as_py() or b"").translate(LETTERS).split()))
            if len(count) >= flush_words:
                yield from flush()
    yield from flush()


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, docs)``: documents with each word, over all rows; counted per task, then summed."""
    texts = docs.select(F.col(text_col).cast("string").cast("binary").alias("text"))
    parts = texts.mapInArrow(_counted_words, "word string, docs long")
    return parts.groupBy("word").agg(F.sum("docs").alias("docs"))


def identifier_dictionary(docs: DataFrame, p: SecretParams = SecretParams(), text_col: str = "text") -> bytes:
    """The words of most documents, commonest last (nearest to the code), cut to ``dict_bytes``.

    Words of equal counts are taken by their hash.  A histogram of the counts
    (cells a 64th apart, so some thousands at most) says from which count on
    words are wanted, and which share of those just there; only about as many
    words as the dictionary holds come to the driver, at any number of tasks.
    """
    most = p.dict_bytes // 5  # a word has four letters at least, and a space
    counts = saved(word_counts(docs, text_col), "words")
    power = F.floor(F.log2(F.col("docs").cast("double")))
    step = F.pow(F.lit(2.0), F.greatest(power - 6, F.lit(0))).cast("long")
    cell = F.col("docs") - F.col("docs") % step
    need, floor, share = most, 0, 1.0
    for r in sorted(counts.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        floor = r.cell
        if r.n >= need:
            share = 4.0 * need / r.n
            break
        need -= r.n
    order = F.pmod(F.xxhash64("word"), F.lit(1 << 30))
    wanted = counts.filter((cell > floor) | ((cell == floor) & (order < F.lit(share * (1 << 30)))))
    rows = wanted.orderBy(F.desc("docs"), order, "word").limit(most).collect()
    size, words = 0, []
    for r in rows:
        size += len(r.word) + 1
        if size > p.dict_bytes:
            break
        words.append(r.word)
    return " ".join(reversed(words)).encode()


# -------------------------------------------------------------------- findings


def base_findings(text: str) -> list[tuple[str, int, int, int, int]]:
    """``(kind, start, end, value start, value end)`` of the patterns, in code points.

    Matches are leftmost and do not overlap within a kind; those whose value
    is too short are dropped after they have taken their text.
    """
    low = text.lower()
    # cheap looks at the text first: most texts have no match of a pattern
    may = {
        "assign": any(w in low for w in ASSIGN_WORDS),
        "access": "AKIA" in text,
        "hex": b"h" * 16 in text.encode("utf-8").translate(HEX),
    }
    found = []
    for kind, pattern, group, least in PATTERNS:
        if not may[kind]:
            continue
        for m in pattern.finditer(text):
            a, b = m.span(group)
            if b - a >= least:
                found.append((kind, m.start(), m.end(), a, b))
    return found


class Novelty:
    """Marginal compressed bytes of a string in its surroundings."""

    def __init__(self, words: bytes, p: SecretParams):
        import zstandard

        options = dict(level=p.level, write_checksum=False, write_content_size=False, write_dict_id=False)
        if len(words) >= 8:  # the least size of a dictionary
            d = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=p.level)
            options["dict_data"] = d
        self.compressor = zstandard.ZstdCompressor(**options)
        self.around = p.around_chars

    def size(self, data: bytes) -> int:
        return len(self.compressor.compress(data + RUN))

    def __call__(self, text: str, start: int, end: int) -> float:
        """Marginal bytes per character of ``text[start:end]``."""
        value = text[start:end]
        # a key that stands there twice must not hide itself
        before = text[max(0, start - self.around) : start].replace(value, "").encode("utf-8")
        after = text[end : end + self.around].replace(value, "").encode("utf-8")
        value = value.encode("utf-8")
        grown = self.size(before + value + after) - self.size(before + after)
        return max(0.0, grown / (end - start))


def _places(text: str, word: str):
    at = text.find(word)
    while at >= 0:
        yield at
        at = text.find(word, at + 1)


def candidates(text: str, p: SecretParams):
    """Spans of long key-like runs that have a sensitive word (in any case) shortly before them.

    A run with fewer than
    four letters or two digits is no candidate.
    """
    low = text.lower()
    if len(low) != len(text):  # a few capitals become two characters
        low = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
    marks = sorted(at + len(w) for w in SENSITIVE if w in low for at in _places(low, w))
    if not marks:
        return
    at = 0
    for m in CANDIDATE.finditer(text):
        start = m.start()
        while at < len(marks) and marks[at] <= start:
            at += 1
        near = at > 0 and marks[at - 1] >= start - p.context_chars
        if near and MIXED.match(m[0]):
            yield m.span()


def findings(text: str, novelty: Novelty, p: SecretParams) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, novelty)`` by start, then kind; base findings all stay, novel ones overlap none."""
    base = base_findings(text)
    found = [(kind, s, e, novelty(text, a, b)) for kind, s, e, a, b in base]
    taken = sorted((s, e) for _, s, e, *_ in base)
    at = 0
    for s, e in candidates(text, p):
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        # spans of different kinds may nest, so the rest of `taken` is looked at up to the candidate's end
        if any(a < e and s < b for a, b in _until(taken, at, e)):
            continue
        grown = novelty(text, s, e)
        if grown >= p.min_novelty:
            found.append((NOVEL, s, e, grown))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def _until(spans: list[tuple[int, int]], at: int, end: int):
    while at < len(spans) and spans[at][0] < end:
        yield spans[at]
        at += 1


def listed(spans) -> str:
    """``kind:start:end``, comma-joined."""
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in spans)


def scan(
    docs: DataFrame,
    p: SecretParams = SecretParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
    dictionary: bytes | None = None,
) -> DataFrame:
    """One row per input row: ``id, n_assign, n_access, n_hex, n_novel, base_sha256, spans, secrets``.

    ``secrets`` holds ``kind, start, end`` (code points, end exclusive),
    ``novelty`` and the found ``value``.  Null and empty texts have none (the
    digest is that of an empty string).  Without a given ``dictionary`` it is
    made from the texts of ``docs``.  Ids may repeat or be null; other columns
    are ignored; an empty table gives no rows.
    """
    words = identifier_dictionary(docs, p, text_col) if dictionary is None else dictionary
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(words)  # at most dict_bytes
    secret = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64()), ("value", pa.string())]
    )

    def run(batches):
        novelty = Novelty(shared.value, p)
        for b in batches:
            counts, shas, spans, secrets = [[] for _ in KINDS], [], [], []
            for t in b.column(1):
                text = t.as_py() or ""
                found = findings(text, novelty, p)
                for kind, n in zip(KINDS, counts):
                    n.append(sum(f[0] == kind for f in found))
                base = listed(f for f in found if f[0] != NOVEL)
                shas.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append(listed(found))
                secrets.append(
                    [{"kind": k, "start": s, "end": e, "novelty": x, "value": text[s:e]} for k, s, e, x in found]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    *[pa.array(n, pa.int64()) for n in counts],
                    pa.array(shas, pa.string()),
                    pa.array(spans, pa.string()),
                    pa.array(secrets, pa.list_(secret)),
                ],
                ["id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "secrets"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    fields = ", ".join(f"n_{k} long" for k in KINDS)
    item = "kind: string, start: bigint, end: bigint, novelty: double, value: string"
    return rows.mapInArrow(
        run, f"id {kind}, {fields}, base_sha256 string, spans string, secrets array<struct<{item}>>"
    )

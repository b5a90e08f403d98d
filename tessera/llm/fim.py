"""Fill-in-the-middle: texts cut at two line ends and put in prefix-suffix-middle or suffix-prefix-middle order.

A text is looked at in fixed blocks of code points.  Two Fenwick trees hold
the line ends and the code points per block; a binary-lifting descent finds
the block in which a wanted line ends and the code points before it, and the
boundary itself is then located inside that one block.  The cuts come from a
hash of the document's id, so a rerun gives the same ones.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class FimParams:
    seed: int = 7
    fim_percent: int = 100  # of the texts; the others stay plain
    spm_percent: int = 50  # of the transformed texts
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
    block_chars: int = 1024


class Fenwick:
    """Prefix sums over a fixed list of counts."""

    def __init__(self, counts: list[int]):
        self.tree = [0, *counts]
        for i in range(1, len(self.tree)):
            up = i + (i & -i)
            if up < len(self.tree):
                self.tree[up] += self.tree[i]

    def before(self, at: int) -> int:
        """Sum of the first ``at`` counts."""
        total = 0
        while at:
            total += self.tree[at]
            at &= at - 1
        return total

    def descend(self, wanted: int) -> tuple[int, int]:
        """The longest prefix whose sum is under ``wanted`` (its length) and that sum."""
        at = total = 0
        step = 1 << (len(self.tree) - 1).bit_length()
        while step:
            to = at + step
            if to < len(self.tree) and total + self.tree[to] < wanted:
                at, total = to, total + self.tree[to]
            step >>= 1
        return at, total


class Lines:
    """The lines of a text (each with its line feed; the last may lack one)."""

    def __init__(self, text: str, block_chars: int):
        self.text, self.size = text, block_chars
        starts = range(0, len(text), block_chars)
        ends = [text.count("\n", i, i + block_chars) for i in starts]
        self.feeds = Fenwick(ends)
        self.chars = Fenwick([min(block_chars, len(text) - i) for i in starts])
        self.closed = sum(ends)
        self.n = self.closed + (bool(text) and not text.endswith("\n"))

    def end_of(self, line: int) -> int:
        """Code points in the first ``line`` lines."""
        if line == 0:
            return 0
        if line > self.closed:
            return len(self.text)
        block, seen = self.feeds.descend(line)
        at = self.chars.before(block) - 1
        for _ in range(line - seen):
            at = self.text.index("\n", at + 1)
        return at + 1


@dataclass(frozen=True)
class Cut:
    """``n`` lines, the form, and where prefix and middle end (None if plain)."""

    n: int
    form: str
    first: int | None = None
    second: int | None = None


def cut(text: str, key: str, p: FimParams) -> Cut:
    """Where to cut ``text``; ``key`` names the document."""
    h = hashlib.sha256(f"{p.seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    lines = Lines(text, p.block_chars)
    if not text or any(m in text for m in p.marks) or h3 % 100 >= p.fim_percent:
        return Cut(lines.n, PLAIN)
    a, b = sorted((h1 % (lines.n + 1), h2 % (lines.n + 1)))
    return Cut(lines.n, SPM if h4 % 100 < p.spm_percent else PSM, lines.end_of(a), lines.end_of(b))


def transformed(text: str, c: Cut, p: FimParams) -> str:
    if c.form == PLAIN:
        return text
    pre, suf, mid = p.marks
    parts = pre + text[: c.first], mid + text[c.first : c.second], suf + text[c.second :]
    return parts[0] + parts[2] + parts[1] if c.form == PSM else parts[2] + parts[0] + parts[1]


def restored(output: str, form: str, p: FimParams = FimParams()) -> str:
    """The text that :func:`transformed` was given; transformed texts hold each mark once."""
    if form == PLAIN:
        return output
    pre, suf, mid = p.marks
    order = (pre, suf, mid) if form == PSM else (suf, pre, mid)
    at = [output.index(m) for m in order]
    parts = {m: output[i + len(m) : j] for m, i, j in zip(order, at, [*at[1:], len(output)])}
    return parts[pre] + parts[mid] + parts[suf]


def fill_in_middle(
    docs: DataFrame, p: FimParams = FimParams(), id_col: str = "doc_id", text_col: str = "text", digests: bool = False
) -> DataFrame:
    """One row per input row: ``id, n, form, prefix_chars, middle_chars, output, restored``.

    With ``digests`` the last two are SHA-256 in hex, and no text leaves the
    task.  ``restored`` is rebuilt from the output and the form alone.  Null
    and empty texts, and texts that hold a mark, stay plain, with null counts
    of characters.  A null id is hashed as an empty one.  Rows may repeat
    (equal rows are cut alike); other columns are ignored; an empty table
    gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    keyed = rows.select("id", "text", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("key"))

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8")).hexdigest()

    def run(batches):
        for b in batches:
            cuts, outs, backs = [], [], []
            for t, key in zip(b.column(1), b.column(2)):
                text = t.as_py() or ""
                c = cut(text, key.as_py(), p)
                out = transformed(text, c, p)
                back = restored(out, c.form, p)
                cuts.append(c)
                outs.append(sha(out) if digests else out)
                backs.append(sha(back) if digests else back)
            middles = [None if c.first is None else c.second - c.first for c in cuts]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([c.n for c in cuts], pa.int64()),
                    pa.array([c.form for c in cuts], pa.string()),
                    pa.array([c.first for c in cuts], pa.int64()),
                    pa.array(middles, pa.int64()),
                    pa.array(outs, pa.string()),
                    pa.array(backs, pa.string()),
                ],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return keyed.mapInArrow(
        run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string, restored string"
    )

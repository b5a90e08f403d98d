"""BPE encoding and decoding of whole texts.

The tokenizer file (vocabulary, ranked merges, special tokens) is read once on
the driver and broadcast; its size does not depend on the data.  In a task a
text is cut at special tokens and white space, and each piece is normalised,
cut into words and merged: a priority queue of merge ranks works on a doubly
linked list of symbols and skips entries whose symbols have merged meanwhile.
Pieces and words repeat, so their ids are kept in bounded caches.  Decoding joins the
vocabulary strings the way the file's decoder does (none: with spaces).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_PIECES = 300_000
CACHE_CHARS = 48
#: The white space of the tokenizer's ``\s``.
SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Bpe:
    """One tokenizer file: NFC, white space and case folding, word split, byte-level merges."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec.get("decoder"):
            raise ValueError("not a tokenizer file of the expected kind")
        import regex

        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        self.strings = {i: s for s, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s for s, i in self.special.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # a pair of ids as one number -> rank; rank -> merged id
        self.ranks = {self.vocab[a] << 32 | self.vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [self.vocab[a + b] for a, b in pairs]
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.space = re.compile(SPACE)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.chars = byte_chars()
        self.cache: dict[str, tuple[bytes, str]] = {}
        self.word_cache: dict[str, tuple[bytes, str]] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge ranked pairs, lowest rank first, leftmost first among equals."""
        n, ranks = len(symbols), self.ranks
        symbols = list(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        # queue entries are rank and position in one number
        found = ((ranks.get(symbols[i] << 32 | symbols[i + 1]), i) for i in range(n - 1))
        queue = [rank << 32 | i for rank, i in found if rank is not None]
        heapq.heapify(queue)
        while queue:
            top = heapq.heappop(queue)
            rank, i = top >> 32, top & 0xFFFFFFFF
            left, j = symbols[i], after[i]
            if left < 0 or j == n or ranks.get(left << 32 | symbols[j]) != rank:
                continue  # stale: one of the symbols has merged with another
            symbols[i], symbols[j] = self.merged[rank], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(symbols[i] << 32 | symbols[k])) is not None:
                    heapq.heappush(queue, r << 32 | i)
            h = before[i]
            if h >= 0 and (r := ranks.get(symbols[h] << 32 | symbols[i])) is not None:
                heapq.heappush(queue, r << 32 | h)
        return [s for s in symbols if s >= 0]

    def word_ids(self, word: str) -> list[int]:
        symbols = [self.chars[b] for b in word.encode("utf-8", "replace")]
        symbols[-1] += self.suffix
        return self.merge([self.vocab[s] for s in symbols if s in self.vocab])

    def _word(self, word: str) -> tuple[bytes, str]:
        """Ids (little-endian unsigned 32 bits) and joined strings of one word."""
        found = self.word_cache.get(word)
        if found is None:
            ids = self.word_ids(word)
            found = struct.pack(f"<{len(ids)}I", *ids), " ".join([self.strings[i] for i in ids])
            if len(word) <= CACHE_CHARS:
                if len(self.word_cache) >= CACHE_PIECES:
                    self.word_cache.clear()
                self.word_cache[word] = found
        return found

    def _piece(self, piece: str) -> tuple[bytes, str]:
        """The same of text without white space, which may hold several words."""
        # lower-casing is by character: a capital sigma at a word's end gets no final form
        text = piece if piece.isascii() else unicodedata.normalize("NFC", piece).replace("Σ", "σ")
        words = [found for w in self.words.findall(text.lower()) if (found := self._word(w))[0]]
        return b"".join([w[0] for w in words]), " ".join([w[1] for w in words])

    def _cached(self, piece: str) -> tuple[bytes, str]:
        found = self._piece(piece)
        if len(piece) <= CACHE_CHARS:
            if len(self.cache) >= CACHE_PIECES:
                self.cache.clear()
            self.cache[piece] = found
        return found

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as bytes, and the decoded text."""
        get, found = self.cache.get, []
        for part in self.cut.split(text) if "<" in text else [text]:
            if part in self.special:
                found.append((self.special[part].to_bytes(4, "little"), part))
            else:
                found += [get(piece) or self._cached(piece) for piece in self.space.split(part)]
        found = [x for x in found if x[0]]
        return b"".join([x[0] for x in found]), " ".join([x[1] for x in found])

    def decode(self, ids) -> str:
        return " ".join(self.strings[i] for i in ids if i in self.strings)


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def tokenized(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False
) -> DataFrame:
    """One row per input row: ``id, n_tokens`` and ``ids, decoded`` (or their SHA-256 with ``digests``).

    Null texts count as empty (no ids, empty string).  Special tokens inside
    a text are ids of their own.  Ids may repeat or be null; other columns of
    ``docs`` are ignored.  Characters that Python's Unicode tables do not know
    yet are split as the file's pattern says of unassigned ones.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))

    def run(batches):
        bpe = Bpe(spec.value)
        for b in batches:
            n, ids, out = [], [], []
            for t in b.column(1):
                raw, decoded = bpe.encode(t.as_py() or "")
                n.append(len(raw) // 4)
                if digests:
                    ids.append(hashlib.sha256(raw).hexdigest())
                    out.append(hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest())
                else:
                    ids.append(np.frombuffer(raw, "<u4").astype("i4"))
                    out.append(decoded)
            kind = pa.string() if digests else pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, kind), pa.array(out, pa.string())],
                ["id", "n_tokens", "ids", "decoded"],
            )

    kind = "string" if digests else "array<int>"
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids {kind}, decoded string")


def decoded(tokens: DataFrame, tokenizer_path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)`` of id lists; ids that the file does not know are skipped, null gives null."""
    rows = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    spec = tokens.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))

    def run(batches):
        bpe = Bpe(spec.value)
        for b in batches:
            texts = [None if (ids := x.as_py()) is None else bpe.decode(ids) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text string")

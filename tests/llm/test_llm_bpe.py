import hashlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import bpe
from tessera.llm.queries import QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def mine():
    return bpe.Bpe(bpe.read_spec(tokenizer_path()))


def same(library, mine, text):
    ids = library.encode(text, add_special_tokens=False).ids
    raw, decoded = mine.encode(text)
    assert np.frombuffer(raw, "<u4").tolist() == ids
    assert decoded == library.decode(ids, skip_special_tokens=False) == mine.decode(ids)


TEXTS = [
    "", " \n\t", "Hello World", "don't I'LL 're'", "ÀÉ ñ ß İI ΑΣ ΣΑΣ", "é Å ẛ̣", "12345 x1y2", "!!! ... ###",
    "<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|>", "<|end", "日本語 テスト 😀😀👩‍👩‍👧", "a b c\x85d\x1ce",
    "ab" * 5000, "mississippi " * 50, "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "\x00\x01 ﻿z", "Ünïcödé-ẅörds",
]


@pytest.mark.parametrize("text", TEXTS)
def test_equals_the_library(library, mine, text):
    same(library, mine, text)


ALPHABET = st.characters(codec="utf-8", exclude_categories=["Cn", "Cs", "Co"])


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.one_of(st.text(ALPHABET), st.text("abcdeéßñΣ' <|>endofx\n\t1!")))
def test_equals_the_library_on_any_text(library, mine, text):
    same(library, mine, text)


def test_merges_skip_stale_entries(mine):
    """Against merging the best pair by a scan of the whole word, over and over."""
    rng = np.random.default_rng(0)
    for _ in range(200):
        symbols = [mine.vocab[c] for c in rng.choice(list("aehinorst"), rng.integers(1, 30))]
        slow = list(symbols)
        while True:
            pairs = [a << 32 | b for a, b in zip(slow, slow[1:])]
            ranked = [(mine.ranks[p], i) for i, p in enumerate(pairs) if p in mine.ranks]
            if not ranked:
                break
            rank, i = min(ranked)
            slow[i : i + 2] = [mine.merged[rank]]
        assert mine.merge(symbols) == slow


def test_cache_stays_bounded(mine, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10)
    mine.cache.clear()
    mine.word_cache.clear()
    mine.encode(" ".join(f"w{chr(97 + i)}" for i in range(26)))
    assert len(mine.cache) <= 10 and len(mine.word_cache) <= 10


def test_operator_and_round_trip(docs, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x y"), (3, None), (3, None)]
    out = bpe.tokenized(docs(rows, extra=True), tokenizer_path())
    got = sorted(((r.id, r.n_tokens, r.ids, r.decoded) for r in out.collect()), key=str)
    expected = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(expected, key=str)
    texts = {str((r.id, r.text)) for r in bpe.decoded(out, tokenizer_path()).collect()}
    assert texts == {str((i, d)) for i, _, _, d in expected}
    assert bpe.tokenized(docs([]), tokenizer_path()).count() == 0


def test_query_on_the_whole_table(spark, library):
    sf = "/root/testdata/sf0.001"
    expected = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected.append(
            (r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        )
    rows = QUERIES["op3_bpe"](spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, rows)) == sorted(expected)

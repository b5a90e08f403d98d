import hashlib
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tessera.llm import fim
from tessera.llm.queries import QUERIES

P = fim.FimParams()
SMALL = fim.FimParams(block_chars=5)


def brute(text, key):
    """The contract by plain list slicing."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    h = hashlib.sha256(f"7:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < 50:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@given(st.text("ab\n\r é𝄞", max_size=60), st.integers(0, 10**6), st.integers(1, 9))
def test_cut_equals_brute_force(text, key, block):
    p = fim.FimParams(block_chars=block)
    c = fim.cut(text, str(key), p)
    out = fim.transformed(text, c, p)
    middle = None if c.first is None else c.second - c.first
    assert (c.n, c.form, c.first, middle, out) == brute(text, key)
    assert fim.restored(out, c.form, p) == text


@given(st.lists(st.integers(0, 4), max_size=40), st.integers(1, 200))
def test_descent_finds_the_block(counts, wanted):
    tree = fim.Fenwick(counts)
    at, total = tree.descend(wanted)
    assert total == sum(counts[:at]) == tree.before(at) < wanted
    assert at == len(counts) or total + counts[at] >= wanted


def test_rates_keep_texts_plain_and_choose_the_form():
    text = "a\nb\nc\n"
    assert fim.cut(text, "1", fim.FimParams(fim_percent=0)).form == "plain"
    assert {fim.cut(text, str(i), fim.FimParams(spm_percent=100)).form for i in range(20)} == {"spm"}
    assert {fim.cut(text, str(i), fim.FimParams(spm_percent=0)).form for i in range(20)} == {"psm"}


def test_edge_cases(spark, docs):
    long = "line of words\n" * 100_000 + "end"
    rows = [
        (1, None), (2, ""), (3, "one"), (4, "\n\n\n"), (5, "has <P> in it\nx"), (6, "<M>"), (7, "a\r\nb c\n"),
        (8, long), (None, "x\ny\n"), (9, "same\nrow\n"), (9, "same\nrow\n"), (10, "< P >\n<p>\n𝄞é\n"),
    ]
    found = fim.fill_in_middle(docs(rows, extra=True)).collect()
    assert len(found) == len(rows)
    wanted = sorted(((i, brute(t, "" if i is None else i), t or "") for i, t in rows), key=str)
    assert sorted(
        ((r.id, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output), r.restored) for r in found), key=str
    ) == wanted


def test_empty_table(spark, docs):
    df = fim.fill_in_middle(docs([(1, "a")]).filter("false"))
    assert df.collect() == []


@pytest.mark.parametrize("digests", [False, True])
def test_digests_are_of_the_texts(spark, docs, digests):
    r = fim.fill_in_middle(docs([(1, "é\nb\nc")]), digests=digests).first()
    n, form, pre, mid, out = brute("é\nb\nc", 1)
    assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, pre, mid)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert (r.output, r.restored) == ((sha(out), sha("é\nb\nc")) if digests else (out, "é\nb\nc"))


def test_query_equals_brute_force_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op13_fim"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, form, pre, mid, out = brute(texts[r.doc_id], r.doc_id)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, pre, mid)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()

import base64
import glob
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import warc
from tessera.llm.common import shared_path
from tessera.llm.queries import QUERIES

ROWS = [
    (1, "http://www.a.example/x", "<p>one</p>"), (2, "http://a.example:80/x", "<p>one</p>"), (3, "https://b.example/?b=2&a=1", "é" * 3),
    (4, None, None), (5, "", ""), (6, "no url at all", "<p>two</p>"), (7, "http://[bad", "<p>one</p>"), (None, "http://n.example/", "<p>one</p>"),
    (8, "http://a.example/x", "z" * 300_000), (9, "http://c.example/ space", "r1\r\n\r\nr2"), (10, "http://a.example/x", "<p>two</p>"),
]


def brute(rows, least=0):
    groups = {}
    for i, _, h in rows:
        groups.setdefault((h or "").encode(), []).append(i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        ids = [x for x in groups[p] if x is not None]
        keep = max(ids) if ids and len(p) >= least and len(groups[p]) > 1 else i
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "response" if keep == i else "revisit", None if keep == i else keep))
    return sorted(out, key=str)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit("x")).repartition(3)


def rows_of(df):
    names = "page_id payload_bytes payload_digest record_type refers_to".split()
    return sorted(map(tuple, df.select(*names).collect()), key=str)


@pytest.mark.parametrize("least", [0, 5, 11])
def test_round_trip(spark, least):
    root = shared_path(spark, "warc-test")
    assert rows_of(warc.round_trip(spark, pages(spark, ROWS), root, least)) == brute(ROWS, least)


def test_files_and_lookup(spark, monkeypatch):
    root = shared_path(spark, "warc-test")
    many = ROWS + [(100 + i, f"http://m.example/{i % 40}", f"text {i}") for i in range(200)]
    captures = warc.write(warc.with_revisits(pages(spark, many)), root)
    files = warc.write_index(captures, root, block_lines=7)
    wanted = spark.createDataFrame([("http://m.example/3",), ("http://WWW.m.example/3",), ("http://none.example/",), (None,)], "url string")
    out = warc.read(warc.lookup(wanted, root, files), root).collect()
    urls = sorted(str(r.url) for r in out)
    assert urls == ["", ""] + ["http://m.example/3"] * 5
    local = "/" + root.split(":", 1)[-1].lstrip("/")
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{local}/warc/*.warc.gz"))
    assert data.count(b"WARC-Type: response") + data.count(b"WARC-Type: revisit") == len(many)
    lines = []
    for _, _, name in files:
        part = gzip.open(f"{local}/index/{name}.gz", "rt").read().splitlines()
        assert part == sorted(part, key=lambda x: x.split(" ")[0])
        assert len(open(f"{local}/index/{name}.idx").read().splitlines()) == -(-len(part) // 7)
        lines += part
    assert len(lines) == len(many)


def test_a_key_spread_over_index_files_hides_nothing(spark):
    """Every capture of a hot key, and those behind it in its last file, whatever the files are called."""
    root = shared_path(spark, "warc-test")
    rows = [(i, f"http://h.example/{'hot' if i % 4 else i}{' !#%$é'[i % 6]}z", f"t{i}") for i in range(400)]
    captures = warc.write(warc.with_revisits(pages(spark, rows)), root)
    files = warc.write_index(captures, root, block_lines=5)
    assert len({f[0] for f in files}) < len(files) or len(files) == 1
    out = warc.read(warc.lookup(pages(spark, rows), root, files), root)
    assert sorted(r.page_id for r in out.collect()) == list(range(400))


def test_a_hot_keys_captures_are_found_by_several_tasks(spark):
    root = shared_path(spark, "warc-test")
    rows = [(i, "http://h.example/hot", f"t{i}") for i in range(400)]
    files = warc.write_index(warc.write(warc.with_revisits(pages(spark, rows)), root), root, block_lines=5)
    out = warc.lookup(pages(spark, rows), root, files).withColumn("p", F.spark_partition_id()).collect()
    assert len(out) == 400 and len(files) > 1 and len({r.p for r in out}) == len(files)


def test_damage_is_noticed():
    record = warc.make_record(1, "http://a/", b"payload", base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), None, False)
    assert warc.parse_record(record)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload\r\n", b"PAYLOAD\r\n"))


def test_url_keys():
    assert warc.url_key("HTTP://www.Ex.com:80/P?b=2&a=1") == "com,ex)/p?a=1&b=2"
    assert warc.url_key("https://ex.com:8080") == "com,ex:8080)/"
    assert warc.url_key(None) == ")" and warc.url_key("x y") == ")x%20y" and warc.url_key("http://h:notaport/").startswith(")")


def test_empty_table(spark):
    root = shared_path(spark, "warc-test")
    assert rows_of(warc.round_trip(spark, pages(spark, []), root)) == []


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    src = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert rows_of(QUERIES["op6_warc"](spark, sf)) == brute(src)

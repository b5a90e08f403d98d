"""WARC archives of pages and a two-level capture index.

``write`` puts one gzip member per record into WARC files (one run of files
per task) in a folder that all executors share; equal payloads are stored
once and revisited.  ``write_index`` sorts the captures by reversed-host URL
key, writes them in compressed blocks and keeps a sparse directory of the
blocks.  ``lookup`` finds captures of given URLs: binary search for the index
file, then for the block, one range read, binary search in the block.
``read`` fetches records by range reads, neighbours together.  Paths are URIs
of any file system that pyarrow opens.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialize, saved

DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 256 << 20
BLOCK_LINES = 300
READ_BYTES = 4 << 20
BATCH_ROWS = 4096
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ----------------------------------------------------------------------- files


def _open_fs(uri: str):
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


class _Files:
    """Open input files, at most a few at a time."""

    def __init__(self, root: str, most: int = 16):
        (self.fs, self.root), self.most, self.open = _open_fs(root), most, OrderedDict()

    def read(self, name: str, offset: int, length: int) -> bytes:
        f = self.open.pop(name, None) or self.fs.open_input_file(f"{self.root}/{name}")
        self.open[name] = f
        if len(self.open) > self.most:
            self.open.popitem(last=False)[1].close()
        f.seek(offset)
        return f.read(length)


def _member(data: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, wbits=31)
    return c.compress(data) + c.flush()


# --------------------------------------------------------------------- records


def _headers(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode("utf-8", "replace")


def make_record(page_id, url: str | None, payload: bytes, digest: str, keep_id, is_revisit: bool) -> bytes:
    """A response record with the payload, or a revisit record with the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if is_revisit else http + payload

    def urn(i) -> str:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{i}:{digest}')}>"

    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", urn(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join((url or "").splitlines())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
    ]
    if is_revisit:
        fields += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", urn(keep_id)), ("X-Refers-To-Page-Id", str(keep_id))]
    return _headers([*fields, ("Content-Length", str(len(block)))]) + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of a record; raises if the payload of a response does not have its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response":
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = {k: int(fields[k]) if fields.get(k) else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")}
    return {
        "page_id": number["X-Page-Id"],
        "url": fields["WARC-Target-URI"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number["X-Refers-To-Page-Id"],
        "payload": payload if kind == "response" else None,
    }


def url_key(url: str | None) -> str:
    """Reversed-host key: ``com,example,m)/path?a=1&b=2``; text that is no URL stands after the bracket.

    Blanks become ``%20``, so a key is one word of an index line.
    """
    text = "%20".join((url or "").split()).lower()
    try:
        parts = urlsplit(text)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        host, port, parts = "", None, None
    if not host:
        return f"){text}"
    host = host.removeprefix("www.")
    shown = f":{port}" if port and port not in (80, 443) else ""
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return ",".join(reversed(host.split("."))) + shown + ")" + (parts.path or "/") + ("?" + query if query else "")


# --------------------------------------------------------------------- writing


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, sha1, keep_id``; ``keep_id`` is that of the equal payloads' response.

    Payloads are equal if their SHA-256 is; the largest page_id is the
    response.  Only narrow digest rows are grouped; the groups of two or more
    then join the pages: broadcast if their table is small, and otherwise a
    join whose skewed partitions Spark can split.
    """
    rows = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).select("page_id", "url", F.col("html").cast("binary").alias("payload"))
    sha = F.unhex(F.sha2("payload", 256))
    narrow = rows.filter(F.octet_length("payload") >= min_bytes).select("page_id", sha.alias("sha"))
    groups = saved(
        narrow.groupBy("sha")
        .agg(F.max("page_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("sha", "keep_id"),
        "payload-groups",
    )
    big = F.octet_length("payload") >= min_bytes
    return rows.withColumn("sha", F.when(big, sha)).join(groups, "sha", "left").select(
        "page_id", "url", "payload", F.sha1("payload").alias("sha1"), "keep_id"
    )


def write(rows: DataFrame, root: str, level: int = 3) -> DataFrame:
    """Write the records of :func:`with_revisits` rows under ``root/warc``; one capture row each.

    The captures are checkpointed, so nothing is written twice; a task that
    failed leaves a file that no capture names.
    """

    def run(batches):
        fs, base = _open_fs(root)
        out, name, at = None, "", 0
        for b in batches:
            found = []
            for page_id, url, payload, sha1, keep in zip(*(c.to_pylist() for c in b.columns)):
                if out is None or at >= FILE_BYTES:
                    if out:
                        out.close()
                    name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/warc/{name}", compression=None)
                    info = b"software: tessera\r\nformat: WARC File Format 1.1\r\n"
                    first = [
                        ("WARC-Type", "warcinfo"),
                        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                        ("WARC-Date", DATE),
                        ("Content-Type", "application/warc-fields"),
                        ("Content-Length", str(len(info))),
                    ]
                    data = _member(_headers(first) + info + b"\r\n\r\n", level)
                    out.write(data)
                    at = len(data)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                revisit = keep is not None and keep != page_id
                data = _member(make_record(page_id, url, payload, digest, keep, revisit), level)
                out.write(data)
                found.append((url_key(url), url, digest, name, at, len(data)))
                at += len(data)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([f[i] for f in found], pa.string()) for i in range(4)),
                        *(pa.array([f[i] for f in found], pa.int64()) for i in (4, 5)),
                    ],
                    ["key", "url", "digest", "file", "start", "length"],
                )
        if out:
            out.close()

    fs, base = _open_fs(root)
    fs.create_dir(f"{base}/warc")
    fs.create_dir(f"{base}/index")
    return materialize(
        rows.mapInArrow(run, "key string, url string, digest string, file string, start long, length long")
    )


def write_index(captures: DataFrame, root: str, block_lines: int = BLOCK_LINES) -> list[tuple[str, str, str]]:
    """Write the two-level index; returns ``(first key, last key, index file)`` per file, in key order.

    One index file per range partition (so the list does not grow with a
    partition's rows): blocks of ``block_lines`` sorted lines, and next to it
    a directory of one line per block.  Of files that start with the same key,
    the one that goes on to other keys comes last.
    """
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "file", "start"]
    ordered = captures.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches):
        fs, base = _open_fs(root)
        name, out, at, lines, directory, first, key = f"cdx-{uuid.uuid4().hex}", None, 0, [], [], None, None

        def block():
            nonlocal at
            data = _member("".join(x + "\n" for x in lines).encode("utf-8", "replace"), 6)
            out.write(data)
            directory.append(f"{lines[0].split(' ', 1)[0]} {at} {len(data)}")
            at += len(data)
            lines.clear()

        for b in batches:
            for key, url, digest, file, start, length in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    out, first = fs.open_output_stream(f"{base}/index/{name}.gz", compression=None), key
                body = {"url": url, "digest": digest, "filename": file, "offset": start, "length": length}
                lines.append(f"{key} {DATE} {json.dumps(body)}")
                if len(lines) == block_lines:
                    block()
        if out:
            if lines:
                block()
            out.close()
            with fs.open_output_stream(f"{base}/index/{name}.idx", compression=None) as f:
                f.write("".join(x + "\n" for x in directory).encode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (first, key, name)], ["first", "last", "name"])

    return sorted(map(tuple, ordered.mapInArrow(run, "first string, last string, name string").collect()))


# --------------------------------------------------------------------- reading


class _Index:
    """Captures by key from the index files; keeps the last directory and block."""

    def __init__(self, root: str, files: list[tuple[str, str, str]]):
        self.files, self.firsts, self.at = files, [f[0] for f in files], _Files(root)
        self.directory, self.block = (None, [], []), (None, [], [])

    def _directory(self, name: str):
        if self.directory[0] != name:
            fs, base = self.at.fs, self.at.root
            with fs.open_input_stream(f"{base}/index/{name}.idx", compression=None) as f:
                rows = [x.rsplit(" ", 2) for x in f.read().decode("utf-8").splitlines()]
            self.directory = (name, [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows])
        return self.directory[1], self.directory[2]

    def _block(self, name: str, offset: int, length: int):
        if self.block[0] != (name, offset):
            text = zlib.decompress(self.at.read(f"index/{name}.gz", offset, length), wbits=31).decode("utf-8")
            lines = text.splitlines()
            self.block = ((name, offset), [x.split(" ", 1)[0] for x in lines], lines)
        return self.block[1], self.block[2]

    def holders(self, key: str):
        """Numbers of the index files that may hold ``key``: it may begin at a file's end and go on."""
        f = max(0, bisect_left(self.firsts, key) - 1)
        while f < len(self.files) and self.firsts[f] <= key:
            if key <= self.files[f][1]:
                yield f
            f += 1

    def find(self, key: str, f: int):
        """Lines of ``key`` in file ``f``: they may start in the block before the first that begins with it, and go on."""
        name = self.files[f][2]
        firsts, places = self._directory(name)
        b = max(0, bisect_left(firsts, key) - 1)
        while b < len(firsts) and firsts[b] <= key:
            keys, lines = self._block(name, *places[b])
            yield from lines[bisect_left(keys, key) : bisect_right(keys, key)]
            b += 1


def lookup(urls: DataFrame, root: str, files: list[tuple[str, str, str]], url_col: str = "url") -> DataFrame:
    """``(key, file, start, length)`` of all captures of the distinct ``urls``."""
    parts = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def keys(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in b.column(0).to_pylist()], pa.string())], ["key"])

    wanted = urls.select(F.col(url_col).cast("string").alias("url")).mapInArrow(keys, "key string").distinct()

    def holders(batches):
        index = _Index(root, files)
        for b in batches:
            found = [(key, f) for key in b.column(0).to_pylist() for f in index.holders(key)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int32())], ["key", "n"]
            )

    def rows(found: list[tuple[str, str, int, int]]):
        return pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in found], pa.string() if i < 2 else pa.int64()) for i in range(4)],
            ["key", "file", "start", "length"],
        )

    def run(batches):
        index, found = _Index(root, files), []
        for b in batches:
            for key, n in zip(*(c.to_pylist() for c in b.columns)):
                for line in index.find(key, n):
                    body = json.loads(line.split(" ", 2)[2])
                    found.append((key, body["filename"], body["offset"], body["length"]))
                    if len(found) == BATCH_ROWS:
                        yield rows(found)
                        found = []
        yield rows(found)

    # a key of many captures fills several index files; each task reads files of its own
    near = wanted.mapInArrow(holders, "key string, n int").repartitionById(parts, F.pmod("n", F.lit(parts)).cast("int"))
    near = near.sortWithinPartitions("n", "key")
    return near.mapInArrow(run, "key string, file string, start long, length long")


def read(captures: DataFrame, root: str, with_payload: bool = True) -> DataFrame:
    """The records of ``captures(file, start, length)``, by range reads in file order."""
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.select("file", "start", "length").repartitionByRange(parts, "file", "start")
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if with_payload:
        names, kinds, schema = [*names, "payload"], [*kinds, pa.binary()], schema + ", payload binary"

    def fetch(files: _Files, run: list[tuple[str, int, int]]):
        name, begin, end = run[0][0], run[0][1], run[-1][1] + run[-1][2]
        data = files.read(f"warc/{name}", begin, end - begin)
        found = [parse_record(zlib.decompress(data[s - begin : s - begin + n], wbits=31)) for _, s, n in run]
        return pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], k) for c, k in zip(names, kinds)], names)

    def run(batches):
        files, held = _Files(root), []
        for b in batches:
            for name, start, length in zip(*(c.to_pylist() for c in b.columns)):
                if held and (
                    held[-1][0] != name
                    or start != held[-1][1] + held[-1][2]
                    or start + length - held[0][1] > READ_BYTES
                ):
                    yield fetch(files, held)
                    held = []
                held.append((name, start, length))
        if held:
            yield fetch(files, held)

    return ordered.sortWithinPartitions("file", "start").mapInArrow(run, schema)


def archive(pages: DataFrame, root: str, min_bytes: int = 0) -> list[tuple[str, str, str]]:
    """Write pages (``page_id, url, html``) and their index under ``root``; returns the index files.

    Null html is an empty payload, a null url an empty target; a null page_id
    is written as an empty number and loses to any other within a group.  Rows
    that repeat page_id and payload are each a record of their own type.
    Extra columns are ignored; an empty table gives no files.
    """
    return write_index(write(with_revisits(pages, min_bytes), root), root)


def round_trip(spark: SparkSession, pages: DataFrame, root: str, min_bytes: int = 0) -> DataFrame:
    """Archive the pages, find every capture through the index, and read the records back."""
    files = archive(pages, root, min_bytes)
    return read(lookup(pages, root, files), root, with_payload=False)

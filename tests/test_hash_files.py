"""Hashes of files of any size: as binary values and in chunks."""

import hashlib
import os

import pytest

from tessera.sources import files


def test_streamed_hashes_equal_whole_ones(spark, tmp_dir):
    bodies = {"a.csv": b"x" * 10, "b c%20é.csv": b"y" * 5000, "d.csv": b"", "skip.txt": b"z" * 9000}
    for name, body in bodies.items():
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(body)
    want = {n: (hashlib.sha256(b).hexdigest(), len(b)) for n, b in bodies.items() if b and n.endswith(".csv")}  # Spark scans leave out empty files
    for bound in (0, 10, 100, 10**6):
        rows = files.hash_files(spark, tmp_dir, "*.csv", stream_above=bound).collect()
        by_path = {os.path.basename(r.path): (r.file_hash, r.length) for r in rows}
        assert by_path == want and len(rows) == len(want)


def test_a_file_over_two_gib(spark, tmp_dir):
    """Sparse, so that it takes no room; a binary value of this size would fail."""
    size = 2**31 + 5
    with open(os.path.join(tmp_dir, "large.csv"), "wb") as f:
        f.truncate(size)
    digest = hashlib.sha256()
    for _ in range(size // 2**20):
        digest.update(bytes(2**20))
    digest.update(bytes(size % 2**20))
    row = files.hash_files(spark, tmp_dir).first()
    assert (row.file_hash, row.length) == (digest.hexdigest(), size)


def test_a_file_that_changed_is_an_error(tmp_dir):
    path = os.path.join(tmp_dir, "f")
    with open(path, "wb") as f:
        f.write(b"abc")
    with pytest.raises(files.SourceError):
        files._stream_hash(f"file:{path}", 4)

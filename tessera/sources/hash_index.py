"""Known hashes as an indexed table.

The table is bucketed by hash, sorted inside its files, and its files carry
Parquet Bloom filters.  An anti-join against it shuffles only the arriving
hashes, into the buckets: what is known already is neither shuffled nor
gathered, however long the history.  A point probe reads one bucket, and there
only row groups whose range and Bloom filter allow the hash.

Each append adds at most one file per bucket.  When a bucket has too many
files or rows, :meth:`HashIndex.compact` writes the next generation, with more
buckets if needed; a generation counts once its marker file stands, so a
stopped compaction changes nothing.  One writer at a time.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKER = "_READY"


class HashIndex:
    """Hashes under ``path``, in folders ``gen=<number>-<buckets>``; the newest complete one counts."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        hash_col: str = "file_hash",
        buckets: int = 16,
        rows_per_bucket: int = 4_000_000,
        files_per_bucket: int = 16,
    ):
        self.spark, self.path, self.hash_col = spark, path.rstrip("/"), hash_col
        self.buckets, self.rows_per_bucket, self.files_per_bucket = buckets, rows_per_bucket, files_per_bucket

    # ------------------------------------------------------------ generations

    def _fs(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm.org.apache.hadoop.fs, root.getFileSystem(self.spark._jsc.hadoopConfiguration()), root

    def _generations(self) -> list[tuple[int, int]]:
        """``(number, buckets)`` of the complete generations, oldest first."""
        hadoop, fs, root = self._fs()
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("gen=") and fs.exists(hadoop.Path(status.getPath(), MARKER)):
                number, buckets = name[4:].split("-")
                found.append((int(number), int(buckets)))
        return sorted(found)

    def _folder(self, generation: tuple[int, int]) -> str:
        return f"{self.path}/gen={generation[0]:06d}-{generation[1]}"

    def _registered(self, generation: tuple[int, int]) -> str:
        """The catalog name of a generation, registered in this session's catalog if it is not there."""
        folder = self._folder(generation)
        name = f"tessera_hashes_{hashlib.md5(folder.encode()).hexdigest()}"
        c = self.hash_col
        self.spark.sql(
            f"""CREATE TABLE IF NOT EXISTS {name} (`{c}` STRING) USING parquet
                OPTIONS ('parquet.bloom.filter.enabled#{c}' 'true', 'parquet.block.size' '{8 << 20}')
                CLUSTERED BY (`{c}`) SORTED BY (`{c}`) INTO {generation[1]} BUCKETS
                LOCATION '{folder}'"""
        )
        self.spark.catalog.refreshTable(name)  # another session may have appended
        return name

    def _write(self, hashes: DataFrame, generation: tuple[int, int]) -> None:
        c = F.col(self.hash_col).cast("string").alias(self.hash_col)
        rows = hashes.select(c).where(c.isNotNull()).distinct()
        # dealt as the buckets are, so that a bucket is written by one task, as one file
        rows.repartition(generation[1], self.hash_col).write.insertInto(self._registered(generation))

    def _begin(self, generation: tuple[int, int]) -> None:
        hadoop, fs, _ = self._fs()
        folder = hadoop.Path(self._folder(generation))
        fs.delete(folder, True)  # what a stopped compaction left; without a marker it never counted
        fs.mkdirs(folder)

    def _finish(self, generation: tuple[int, int]) -> None:
        hadoop, fs, _ = self._fs()
        fs.create(hadoop.Path(self._folder(generation), MARKER)).close()

    def _drop(self, generation: tuple[int, int]) -> None:
        hadoop, fs, _ = self._fs()
        self.spark.sql(f"DROP TABLE IF EXISTS {self._registered(generation)}")
        fs.delete(hadoop.Path(self._folder(generation)), True)

    # -------------------------------------------------------------- operators

    def known(self) -> DataFrame | None:
        """The indexed hashes; None if there is no index yet."""
        generations = self._generations()
        return self.spark.table(self._registered(generations[-1])) if generations else None

    def new_only(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """Rows of ``df`` whose ``key`` is not indexed (null keys are not).

        No exchange on the side of the index.  ``df`` is dealt into the
        buckets, so collapse its copies of a hash first.
        """
        known = self.known()
        if known is None:
            return df
        known = known.withColumnRenamed(self.hash_col, "_known")
        return df.join(known, F.col(key or self.hash_col) == F.col("_known"), "left_anti")

    def contains(self, value: str) -> bool:
        """Point probe: one bucket, row groups by range and Bloom filter, one row at most."""
        known = self.known()
        return known is not None and not known.filter(F.col(self.hash_col) == F.lit(value)).limit(1).isEmpty()

    def add(self, hashes: DataFrame) -> None:
        """Index the hashes of ``hashes``; those known already may be among them (they stay single after compaction)."""
        generations = self._generations()
        if not generations:
            first = (1, self.buckets)
            self._begin(first)
            self._finish(first)
            generations = [first]
        self._write(hashes, generations[-1])
        if self._files(generations[-1]) > self.files_per_bucket * generations[-1][1]:
            self.compact()

    def _files(self, generation: tuple[int, int]) -> int:
        hadoop, fs, _ = self._fs()
        names = [s.getPath().getName() for s in fs.listStatus(hadoop.Path(self._folder(generation)))]
        return sum(n.startswith("part-") for n in names)

    def compact(self) -> None:
        """Write the next generation: one sorted file per bucket, as many buckets as the rows need."""
        generations = self._generations()
        if not generations:
            return
        old = generations[-1]
        known = self.spark.table(self._registered(old))
        buckets = max(old[1], -(-known.count() // self.rows_per_bucket))
        new = (old[0] + 1, buckets)
        self._begin(new)
        self._write(known, new)
        self._finish(new)
        for generation in generations:
            self._drop(generation)

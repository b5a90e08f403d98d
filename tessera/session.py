"""Session helpers: UTC, ANSI on, AQE, dynamic partition overwrite.

On a cluster the session is created by the platform; ``configure`` only sets
the SQL options our operators rely on, and ``ensure_checkpoint_dir`` reads the
shared ``spark.checkpoint.dir`` instead of inventing a local one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# SQL options every tessera job assumes.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Coalesce shuffle partitions to the advisory size instead of keeping
    # one per core: fewer, fuller tasks (the setting Spark advises for busy
    # clusters; on tiny inputs it also removes per-task overhead).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


MiB = 1024 * 1024


def scale_conf(
    input_bytes: int, total_cores: int, partition_bytes: int | None = None
) -> dict[str, str]:
    """Partition sizing for a given input volume and cluster size.

    A task should handle about ``partition_bytes``: by default the input
    spread over two waves of the cluster's cores, between 1 MiB (to amortise
    task start-up) and 256 MiB (to fit executor memory without spilling).
    Scan splits and shuffle partitions follow, at any volume; AQE then
    coalesces small shuffles to the advisory size and splits skewed ones.
    E.g. 100 TB on 1000 executors x 8 cores -> 256 MiB tasks, 400k shuffle
    partitions, advisory 128 MiB; 40 MB on 8 cores -> ~2.5 MiB tasks, so a
    mid-sized shuffle still uses every core.
    """
    if partition_bytes is None:
        partition_bytes = min(256 * MiB, max(MiB, input_bytes // (2 * total_cores)))
    parts = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(max(MiB // 2, partition_bytes // 2)),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
    }


def configure(spark: SparkSession, sizing: dict[str, str] | None = None) -> SparkSession:
    """Apply :data:`SQL_CONF` (and optional :func:`scale_conf` sizing) to a session."""
    for key, value in {**SQL_CONF, **(sizing or {})}.items():
        spark.conf.set(key, value)
    return spark


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes under ``paths`` in whatever file system they name (a missing path counts 0)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def size_for(spark: SparkSession, *paths: str) -> SparkSession:
    """Size the session for reading ``paths``; what the submitter has set stays.

    The one sizing path of the command line and the bench.
    """
    given = spark.sparkContext.getConf()
    sizing = scale_conf(stored_bytes(spark, *paths), spark.sparkContext.defaultParallelism)
    return configure(spark, {k: v for k, v in sizing.items() if not given.contains(k)})


def get_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with tessera's options.

    ``master`` is only given for local runs and tests; on a cluster leave it
    ``None`` so the submitting platform decides.  A number of shuffle
    partitions is set only where the caller names one (tests); otherwise the
    submitter's setting, :func:`size_for` or Spark's default holds.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **SQL_CONF,
        **(extra or {}),
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    # the checkpoint folder is resolved when first needed (materialize), so
    # jobs that never checkpoint also run on a cluster that names none
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting a scratch one only in local mode.

    A cluster must name a shared folder in ``spark.checkpoint.dir``; we never
    fall back to a machine-local temporary folder there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for the cluster"
        )
    path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def materialize(df):
    """Compute ``df`` once and cut its lineage (reliable checkpoint).

    Used for small derived tables (calendar-grained series) that several
    branches of a plan consume: without it every branch would re-scan and
    re-aggregate the fact tables.  Files go to ``spark.checkpoint.dir`` (a
    shared folder on a cluster), so a lost executor does not lose them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shared_copy(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read again.

    Cuts lineage as :func:`materialize` does; later steps read only the
    columns they need, and Spark knows the table's size.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

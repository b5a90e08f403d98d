"""Sinks (S9-S12): partitioned append, overwrite, landing CSV, ledger append."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tessera.operators.quality import reason_mask


def append_partitioned(
    df: DataFrame, path: str, fmt: str = "parquet", by: Sequence[str] = ("ano", "mes")
) -> int:
    """Append, partitioned by ``by`` (S9); returns the number of rows written.

    Rows are clustered on the partition columns with a REBALANCE hint: few
    files per partition directory, while AQE splits a hot partition (say one
    month holding a third of the rows) over several tasks instead of one.
    The row count is an observed metric of the write itself (A7) — no
    second pass.
    """
    by = list(by)
    obs = Observation("append_partitioned")
    observed = df.observe(obs, F.count(F.lit(1)).alias("n"))
    observed.hint("rebalance", *by).write.format(fmt).mode("append").partitionBy(*by).save(path)
    return int(obs.get["n"])


@dataclass(frozen=True)
class SplitRows:
    """What :func:`split_write` wrote: good rows as they came, bad ones with ``_reasons`` (names of the rules they broke)."""

    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: int
    broken: dict[str, int]  # rows per rule; a row may break several


def split_write(df: DataFrame, path: str, rules: Mapping[str, Column]) -> SplitRows:
    """Good and bad rows in one write of a new Parquet folder, split by a status partition (Q4, Q5, Q8).

    ``rules`` names the conditions that a bad row meets (at most 62); each row
    gets the bit mask of those it meets.  The counts are observed during the
    write, so ``df`` is computed once and what was written is not scanned for
    them; readers of one side do not open the other's files.
    """
    if len(rules) > 62:
        raise ValueError("at most 62 rules fit the bit mask")
    rows = df.withColumn("_mask", reason_mask(rules))
    mask = F.col("_mask")
    counts = [F.count_if(mask == 0).alias("n_good"), F.count_if(mask != 0).alias("n_bad")]
    counts += [F.count_if(mask.bitwiseAND(F.lit(1 << i)) != 0).alias(f"n{i}") for i in range(len(rules))]
    obs = Observation("split_write")
    marked = rows.observe(obs, *counts).withColumn("_status", F.when(mask == 0, "good").otherwise("bad"))
    marked.write.partitionBy("_status").parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    names = F.array(*[F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(r)) for i, r in enumerate(rules)])
    bad = stored.filter("_status = 'bad'").withColumn("_reasons", F.array_compact(names))
    n = obs.get
    return SplitRows(
        stored.filter("_status = 'good'").select(*df.columns),
        bad.select(*df.columns, "_reasons"),
        int(n["n_good"]),
        int(n["n_bad"]),
        {r: int(n[f"n{i}"]) for i, r in enumerate(rules)},
    )


def partitions_path(path: str) -> str:
    """Where the partitions that appends to the table under ``path`` wrote are noted."""
    return f"{path.rstrip('/')}_partitions"


def _overwrite(df: DataFrame, path: str, fmt: str, sort_by: Sequence[str], by: Sequence[str], mode: str) -> None:
    out = df.hint("rebalance", *by) if by else df
    out = out.sortWithinPartitions(*dict.fromkeys([*by, *sort_by])) if sort_by else out
    writer = out.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", mode)
    (writer.partitionBy(*by) if by else writer).save(path)


def overwrite_table(
    df: DataFrame, path: str, fmt: str = "parquet", sort_by: Sequence[str] = (), by: Sequence[str] = ()
) -> None:
    """Full refresh of a table (S10), partitioned by ``by``; optional sort inside each output file."""
    _overwrite(df, path, fmt, sort_by, by, "static")


def replace_partitions(
    df: DataFrame, path: str, fmt: str = "parquet", by: Sequence[str] = ("ano",), sort_by: Sequence[str] = ()
) -> None:
    """Replace the partitions that ``df`` has rows of (S10); files of all others stay as they are."""
    _overwrite(df, path, fmt, sort_by, by, "dynamic")


def write_landing(df: DataFrame, directory: str) -> None:
    """Canonical landing CSV: UTF-8, header, no index."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(directory)


def append_manifest(df_new: DataFrame, path: str) -> int:
    """Append only the new ledger rows (S12); nothing is written when empty.

    Returns the number of appended rows (observed during the write).
    """
    if df_new.isEmpty():
        return 0
    obs = Observation("append_manifest")
    df_new.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("append").option("header", True).csv(path)
    return int(obs.get["n"])

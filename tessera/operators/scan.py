"""Lag and running sums over raw-grained series of any length, by a distributed prefix scan.

The rows are sorted once, into range partitions of (series, order): the one
exchange of all rows.  Each partition is scanned as a stream, as if it were the
whole table.  What a partition's first rows lack is the state of their series
before it: the last row and the sums so far.  That comes from one small row
per partition (its last row), combined by a window over those rows, and is
broadcast back, since there is one row per partition however many rows there
are.  No series, not even one with most of the rows, has to fit a task, and no
calendar bucket is needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import shared_copy

SER, PART = "_ser", "_part"
FIRST_RUN, HEAD, TAIL = "_first_run", "_head", "_tail"


def _scanner(lags: Sequence[tuple[str, str]], sums: Sequence[str]):
    """A function over the sorted batches of one partition.

    Adds per row: the lagged values and running sums inside the partition,
    whether the row belongs to the partition's first series, and whether it is
    the partition's first or last row.
    """

    def run(batches):
        before = None  # last row seen: (series, lag sources)
        totals = [(np.longdouble(0), False)] * len(sums)
        first_run, held = True, None

        def with_tail(batch, last):
            mark = np.zeros(batch.num_rows, bool)
            mark[-1] = last
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(mark)], [*batch.schema.names, TAIL])

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            ser = b.column(b.schema.get_field_index(SER))
            new = np.zeros(n, bool)
            new[1:] = pc.not_equal(ser[1:], ser[:-1]).to_numpy(zero_copy_only=False)
            new[0] = before is None or ser[0].as_py() != before[0]
            head = np.zeros(n, bool)
            head[0] = before is None
            starts = np.flatnonzero(new)
            in_first = np.zeros(n, bool)
            if first_run:
                later = starts[starts > 0] if before is None else starts
                end = int(later[0]) if len(later) else n
                in_first[:end] = True
                first_run = end == n
            columns, names = list(b.columns), list(b.schema.names)
            lasts = []
            for i, (out, src) in enumerate(lags):
                values = b.column(b.schema.get_field_index(src))
                one = pa.nulls(1, values.type) if before is None else before[1][i]
                moved = pa.concat_arrays([one, values[: n - 1]])
                columns.append(pc.if_else(pa.array(new), pa.nulls(n, values.type), moved))
                names.append(out)
                lasts.append(values[n - 1 :])
            run_of = np.cumsum(new) - 1  # -1: the series goes on from the batch before
            for i, out in enumerate(sums):
                values = b.column(b.schema.get_field_index(out)).to_numpy(zero_copy_only=False).astype(np.longdouble)
                known = ~np.isnan(values)
                cum = np.cumsum(np.where(known, values, 0))
                seen = np.cumsum(known)
                at = np.append(starts, 0)[run_of]  # start of the row's run (for -1: unused)
                base = np.where(run_of >= 0, np.where(at > 0, cum[at - 1], 0), -totals[i][0])
                some = np.where(run_of >= 0, seen - np.where(at > 0, seen[at - 1], 0) > 0, (seen > 0) | totals[i][1])
                total = cum - base
                totals[i] = (total[-1], bool(some[-1]))
                j = names.index(out)
                columns[j] = pa.array(total.astype(float), mask=~some)
            before = (ser[n - 1].as_py(), lasts)
            done = pa.RecordBatch.from_arrays(
                [*columns, pa.array(in_first), pa.array(head)], [*names, FIRST_RUN, HEAD]
            )
            if held is not None:
                yield with_tail(held, False)
            # the last row is held back until it is known whether more follow
            if n > 1:
                yield with_tail(done.slice(0, n - 1), False)
            held = done.slice(n - 1, 1)
        if held is not None:
            yield with_tail(held, True)

    return run


def range_scan(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    lags: Mapping[str, str] | None = None,
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ``{out: previous row's src}`` and ``{out: sum up to the row}`` columns.

    ``order`` must be unique within a series.  NULL series and NULL order
    values are kept, grouped and sorted first; a sum is NULL until the first
    non-NULL value, as in SQL.  An empty table gives no rows.
    """
    lags, sums = list((lags or {}).items()), dict(sums or {})
    # exact equality of series of any type, NULL parts included
    series = F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("")
    keys = [F.col(c).asc_nulls_first() for c in (*by, *order)]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select("*", *[v.cast("double").alias(out) for out, v in sums.items()], series.alias(SER))
    rows = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn(PART, F.spark_partition_id())
    schema = T.StructType(
        [
            *rows.schema.fields,
            *[T.StructField(out, rows.schema[src].dataType) for out, src in lags],
            *[T.StructField(c, T.BooleanType()) for c in (FIRST_RUN, HEAD, TAIL)],
        ]
    )
    # written once: the partitions must stay as they are while their states are combined
    local = shared_copy(rows.mapInArrow(_scanner(lags, list(sums)), schema), "scan")

    # one row per partition for what it leaves behind, and one for what it needs
    state = F.struct(*[F.col(src).alias(f"l{i}") for i, (_, src) in enumerate(lags)], F.lit(True).alias("there"))
    left = local.filter(TAIL).select(
        SER, PART, F.lit(1).alias("kind"), state.alias("state"), *[F.col(out).alias(f"s{i}") for i, out in enumerate(sums)]
    )
    needed = local.filter(HEAD).select(
        SER, PART, F.lit(0).alias("kind"), F.lit(None).cast(left.schema["state"].dataType).alias("state"),
        *[F.lit(None).cast("double").alias(f"s{i}") for i in range(len(sums))],
    )
    earlier = Window.partitionBy(SER).orderBy(PART, "kind").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        needed.unionByName(left)
        .select(
            PART,
            "kind",
            F.last("state", ignorenulls=True).over(earlier).alias("_state"),
            *[F.sum(f"s{i}").over(earlier).alias(f"_s{i}") for i in range(len(sums))],
        )
        .filter("kind = 0")
        .drop("kind")
    )
    whole = local.join(F.broadcast(carried), PART, "left")
    filled = {out: F.when(F.col(HEAD), F.col(f"_state.l{i}")).otherwise(F.col(out)) for i, (out, _) in enumerate(lags)}
    for i, out in enumerate(sums):
        here, before = F.col(out), F.when(F.col(FIRST_RUN), F.col(f"_s{i}"))
        both = F.coalesce(before, F.lit(0.0)) + F.coalesce(here, F.lit(0.0))
        filled[out] = F.when(here.isNotNull() | before.isNotNull(), both)
    return whole.withColumns(filled).select(*df.columns, *[out for out, _ in lags], *sums)

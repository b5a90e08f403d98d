"""Row-ordered frames over series: lag, rolling frames, running sums.

Two exact ways, chosen by the caller for what a row is:

``method="window"`` (default) is Spark's own window per series.  It is meant
for calendar-grained series (one row per series and period, what the monthly
and daily aggregates give): a series then has as many rows as the calendar has
periods, however large the facts are, so one task can hold it, keyed or not.
One exchange, and the steps of one operator share it.

``method="blocks"`` / ``"bucketed"`` are for raw-grained series, which may be
of any length.  A row gets its gap-free position within its series (row number
per calendar bucket, plus the sizes of earlier buckets), the series is cut
into fixed-size blocks, and each block also gets a *halo*: copies of the rows
before it that its frames reach.  Lag by one row and running sums have a
cheaper form: inside the bucket, plus a one-row-per-bucket table for what lies
before.  Pass a finer ``bucket`` when a calendar year of one series is too
much for a task.

``method="scan"`` (lag by one row, running sums) is for raw-grained series too
and needs no bucket: one sort into range partitions and a prefix scan over
them, see :mod:`tessera.operators.scan`.

Frames of many rows: Spark's sliding frames work through ``k`` rows for each
row.  :func:`frame_sums` takes a frame as the end of one block of ``k`` rows
and the beginning of the next, whose sums are running sums, so a row costs the
same for any ``k``, and nothing large is subtracted.

Keys are compared as structs, so NULL series and NULL order values are kept
and grouped like any other value (NULL sorts first, as in Spark's windows).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.scan import range_scan

G = "_g"
BLK = "_blk"
HALO = "_halo"
_BK = "_bk"
_SER = "_ser"
_KEY = "_key"
_RN = "_rn"
_OFF = "_off"

Frame = Callable[[Window], Column]


def default_bucket(order: str) -> Column:
    """Coarse, monotone bucket of a date/timestamp order column (its year)."""
    return F.year(F.col(order))


def _keyed(df: DataFrame, order: str, by: Sequence[str], bucket: Column | None) -> DataFrame:
    """Add the bucket, and the series and (series, bucket) as non-NULL structs."""
    series = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
    return (
        df.withColumn(_BK, bucket if bucket is not None else default_bucket(order))
        .withColumn(_SER, series)
        .withColumn(_KEY, F.struct(_SER, _BK))
    )


def _earlier_buckets(summary: DataFrame, columns: Mapping[str, Frame]) -> DataFrame:
    """Columns over the buckets before each one; ``summary`` has one row per (series, bucket)."""
    w = Window.partitionBy(f"{_KEY}.{_SER}").orderBy(f"{_KEY}.{_BK}")
    return summary.select(_KEY, *[fn(w).alias(name) for name, fn in columns.items()])


def sequence_frame(
    df: DataFrame,
    order: str,
    by: Sequence[str] = (),
    k: int = 2,
    block_rows: int = 4096,
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``_ser``, ``_g`` (0-based position in series), ``_blk`` and ``_halo`` columns.

    ``order`` must be unique within each series (as for ``lag``).  ``bucket``
    must be monotone in ``order`` (default: year of ``order``); it only sizes
    the first, position-numbering window.
    """
    width = max(int(block_rows), k)
    numbered = _keyed(df, order, by, bucket).withColumn(
        _RN, F.row_number().over(Window.partitionBy(_KEY).orderBy(F.col(order).asc()))
    )
    # counting from `numbered` reuses its (series, bucket) partitioning
    sizes = numbered.groupBy(_KEY).agg(F.max(_RN).alias("_n"))
    offsets = _earlier_buckets(
        sizes,
        {_OFF: lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))},
    )
    positioned = (
        numbered.join(offsets, on=_KEY, how="inner")
        .withColumn(G, F.col(_OFF) + F.col(_RN) - F.lit(1))
        .drop(_OFF, _RN, _BK, _KEY)
    )
    blk = F.floor(F.col(G) / F.lit(width)).cast("bigint")
    own = F.struct(blk.alias("b"), F.lit(False).alias("h"))
    if k <= 1:
        return positioned.withColumns({BLK: blk, HALO: F.lit(False)})
    # the last k-1 rows of each block are copied into the next block as halo
    in_tail = (F.col(G) % F.lit(width)) >= F.lit(width - (k - 1))
    copies = F.when(in_tail, F.array(own, F.struct((blk + 1).alias("b"), F.lit(True).alias("h")))).otherwise(F.array(own))
    return (
        positioned.withColumn("_cp", F.explode(copies))
        .withColumns({BLK: F.col("_cp.b"), HALO: F.col("_cp.h")})
        .drop("_cp")
    )


def with_rolling(
    df: DataFrame,
    order: str,
    by: Sequence[str],
    k: int,
    columns: Mapping[str, Frame],
    before: Mapping[str, Frame] | None = None,
    method: str = "window",
    block_rows: int = 4096,
    bucket: Column | None = None,
) -> DataFrame:
    """Add columns computed over the trailing ``k``-row frame of each row.

    ``columns`` maps output name -> function ``(trailing frame) -> Column``.
    ``before`` adds columns first that look one row back at most, name ->
    function ``(ordered window) -> Column`` (e.g. a change from the previous
    row); the frames of ``columns`` see them, in the same pass.  Column order
    of ``df`` is kept; new columns are appended in the given order.
    """
    before = dict(before or {})
    if method == "window":
        ordered = Window.partitionBy(*by).orderBy(F.col(order).asc())
        framed = df
    else:
        framed = sequence_frame(df, order, by, k=k + bool(before), block_rows=block_rows, bucket=bucket)
        ordered = Window.partitionBy(_SER, BLK).orderBy(G)
    for name, fn in before.items():
        framed = framed.withColumn(name, fn(ordered))
    out = framed.withColumns({name: fn(ordered.rowsBetween(-(k - 1), 0)) for name, fn in columns.items()})
    if method != "window":
        out = out.filter(~F.col(HALO))
    return out.select(*df.columns, *before, *columns)


def with_lag(
    df: DataFrame,
    order: str,
    values: Mapping[str, str],
    by: Sequence[str] = (),
    offset: int = 1,
    method: str = "window",
    block_rows: int = 4096,
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``{out: lag(src, offset)}`` columns ordered by ``order`` within ``by``.

    The previous *row*, so calendar gaps are bridged.  ``method``: "window",
    "bucketed" or "scan" (offset 1 only, one large shuffle), or "blocks" (any
    offset).
    """
    if method == "scan":
        if offset != 1:
            raise ValueError("scan supports offset 1 only")
        return range_scan(df, [order], by, lags=values)
    if method == "window":
        w = Window.partitionBy(*by).orderBy(F.col(order).asc())
        return df.withColumns({out: F.lag(src, offset).over(w) for out, src in values.items()})
    if method == "bucketed":
        if offset != 1:
            raise ValueError("bucketed lag supports offset 1 only")
        return _lag_bucketed(df, order, values, by, bucket)
    framed = sequence_frame(df, order, by, k=offset + 1, block_rows=block_rows, bucket=bucket)
    w = Window.partitionBy(_SER, BLK).orderBy(G)
    out = framed.withColumns({out: F.lag(src, offset).over(w) for out, src in values.items()})
    return out.filter(~F.col(HALO)).select(*df.columns, *values)


def _lag_bucketed(
    df: DataFrame, order: str, values: Mapping[str, str], by: Sequence[str], bucket: Column | None
) -> DataFrame:
    """Lag by one row: lag inside (series, bucket), then the first row of each
    bucket takes the last row of the previous non-empty bucket (a table of one
    row per series and bucket, a partial, map-side ``max_by`` aggregate).
    """
    srcs = list(dict.fromkeys(values.values()))
    w = Window.partitionBy(_KEY).orderBy(F.col(order).asc())
    lagged = _keyed(df, order, by, bucket).withColumns(
        {
            **{f"_l_{i}": F.lag(src).over(w) for i, src in enumerate(srcs)},
            "_first": F.row_number().over(w) == F.lit(1),
        }
    )
    # a struct orders NULL first; max_by itself would skip a NULL order value
    last = lagged.groupBy(_KEY).agg(
        F.max_by(F.struct(*[F.col(s).alias(f"v{i}") for i, s in enumerate(srcs)]), F.struct(F.col(order))).alias("_last")
    )
    prev = _earlier_buckets(last, {"_prev": lambda w: F.lag("_last").over(w)})
    joined = lagged.join(prev, on=_KEY, how="inner")
    filled = {
        out: F.when(F.col("_first"), F.col(f"_prev.v{srcs.index(src)}")).otherwise(F.col(f"_l_{srcs.index(src)}"))
        for out, src in values.items()
    }
    return joined.withColumns(filled).select(*df.columns, *values)


def running_sums(
    df: DataFrame,
    order: str,
    values: Mapping[str, Column],
    by: Sequence[str] = (),
    method: str = "window",
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``{out: sum of value over all rows up to the current one}``.

    Like SQL's running sum: NULL until the first non-NULL value.  "bucketed":
    the sum inside (series, bucket) plus the totals of all earlier buckets.
    "scan": by range partitions, no bucket needed.
    """
    if method == "scan":
        return range_scan(df, [order], by, sums=values)
    if method == "window":
        w = Window.partitionBy(*by).orderBy(F.col(order).asc()).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({out: F.sum(v.cast("double")).over(w) for out, v in values.items()})
    w = Window.partitionBy(_KEY).orderBy(F.col(order).asc()).rowsBetween(Window.unboundedPreceding, 0)
    keyed = _keyed(df, order, by, bucket).withColumns({f"_v_{out}": v.cast("double") for out, v in values.items()})
    inside = keyed.withColumns({f"_in_{out}": F.sum(f"_v_{out}").over(w) for out in values})
    totals = inside.groupBy(_KEY).agg(*[F.sum(f"_v_{out}").alias(f"_t_{out}") for out in values])
    earlier = _earlier_buckets(
        totals,
        {
            f"_b_{out}": (lambda w, out=out: F.sum(f"_t_{out}").over(w.rowsBetween(Window.unboundedPreceding, -1)))
            for out in values
        },
    )
    zero = F.lit(0.0)
    both = {
        out: F.when(
            F.col(f"_in_{out}").isNotNull() | F.col(f"_b_{out}").isNotNull(),
            F.coalesce(f"_b_{out}", zero) + F.coalesce(f"_in_{out}", zero),
        )
        for out in values
    }
    return inside.join(earlier, on=_KEY, how="inner").withColumns(both).select(*df.columns, *values)


def frame_sums(df: DataFrame, order: str, by: Sequence[str], k: int, values: Mapping[str, Column]) -> DataFrame:
    """Add ``{out: sum of value over the trailing k rows}`` (NULL if none is known), at a cost that does not grow with ``k``.

    Rows are numbered within their series and cut into blocks of ``k``.  The
    frame of a row is the rest of the block before, from the row ``k - 1``
    back on, and its own block up to the row: one running sum from either end.
    """
    ordered = Window.partitionBy(*by).orderBy(F.col(order).asc())
    numbered = df.withColumns({f"_v_{out}": v.cast("double") for out, v in values.items()})
    numbered = numbered.withColumn(G, F.row_number().over(ordered) - 1)
    numbered = numbered.withColumn(BLK, F.floor(F.col(G) / F.lit(k)))
    block = Window.partitionBy(*by, BLK)
    begin = block.orderBy(F.col(G).asc()).rowsBetween(Window.unboundedPreceding, 0)
    rest = block.orderBy(F.col(G).desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = numbered.withColumns({f"_e_{out}": F.sum(f"_v_{out}").over(rest) for out in values})
    summed = summed.withColumns({f"_b_{out}": F.sum(f"_v_{out}").over(begin) for out in values})
    by_row = Window.partitionBy(*by).orderBy(F.col(G).asc())
    before = summed.withColumns({f"_e_{out}": F.lag(f"_e_{out}", k - 1).over(by_row) for out in values})
    # the last row of a block: its frame is the block itself; before row k: only what there is
    own = F.col(G) % F.lit(k) == F.lit(k - 1)
    first = F.col(BLK) == F.lit(0)
    sums = {}
    for out in values:
        earlier = F.when(own | first, F.lit(None).cast("double")).otherwise(F.col(f"_e_{out}"))
        here = F.col(f"_b_{out}")
        sums[out] = F.when(
            earlier.isNotNull() | here.isNotNull(), F.coalesce(earlier, F.lit(0.0)) + F.coalesce(here, F.lit(0.0))
        )
    return before.withColumns(sums).select(*df.columns, *values)


def frame_moments(
    df: DataFrame, order: str, by: Sequence[str], k: int, a: str, b: str | None = None
) -> tuple[DataFrame, dict[str, Column]]:
    """Count, means, variances and covariance of the trailing ``k`` rows, from :func:`frame_sums`.

    Returns the rows with the sums and the moments as columns over them:
    ``n, mean_a, var_a`` and with ``b`` also ``mean_b, var_b, cov``
    (population moments of the rows where all are known).  Values are centred
    on their series' mean first; a variance under 1e-12 of the mean square is
    rounding and counts as zero.
    """
    known = F.col(a).isNotNull() if b is None else F.col(a).isNotNull() & F.col(b).isNotNull()
    series = Window.partitionBy(*by)
    cols = [a] if b is None else [a, b]
    centred = df.withColumns({f"_m_{c}": F.avg(F.when(known, F.col(c))).over(series) for c in cols})
    x = {c: F.when(known, F.col(c) - F.col(f"_m_{c}")) for c in cols}
    values = {"_n": F.when(known, F.lit(1.0))}
    for c in cols:
        values |= {f"_s_{c}": x[c], f"_q_{c}": x[c] * x[c]}
    if b is not None:
        values["_p"] = x[a] * x[b]
    out = frame_sums(centred, order, by, k, values)
    n = F.col("_n")
    moments = {"n": F.coalesce(n, F.lit(0.0)).cast("long")}
    for name, c in zip("ab", cols):
        square = F.col(f"_q_{c}") / n
        var = square - (F.col(f"_s_{c}") / n) * (F.col(f"_s_{c}") / n)
        moments[f"var_{name}"] = F.when(var > square * 1e-12, var).otherwise(F.when(n > 0, F.lit(0.0)))
        moments[f"mean_{name}"] = F.col(f"_m_{c}") + F.col(f"_s_{c}") / n
    if b is not None:
        moments["cov"] = F.col("_p") / n - (F.col(f"_s_{a}") / n) * (F.col(f"_s_{b}") / n)
    return out, moments

"""Correlated pairs of a panel's series, by Fourier sketches and a grid.

Each series' changes become a unit vector over the panel's calendar, so that a
correlation is a dot product and ``|a - b|^2 = 2 (1 - r)``.  A few Fourier
coefficients of the vector never lie further apart than the vectors do: a pair
with ``r >= threshold`` lies in the same or neighbouring cells of a grid whose
cells are as wide as the largest such distance.  Blocks of series that meet
there are multiplied as matrices (the exact check), and only pairs over the
threshold leave the task.

Blocks travel by group: the blocks of a cell are dealt into a few groups, a
pair of groups is one key of a join, and pairs of blocks are made inside the
join.  So a series is sent a bounded number of times, however many blocks it
meets, until groups would get too large for a task.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.panel import panel_pct_change
from tessera.session import materialize

# Series of a cell that meet as many others in one block: about this many.
CELL_SERIES = 1024
# A cell's blocks are dealt into so many groups, if these keep GROUP_SERIES series each, and into more
# when a group would hold over GROUP_BLOCKS blocks: a task holds one group while others pass it.
CELL_GROUPS = 6
GROUP_SERIES = 32
GROUP_BLOCKS = 64
# Float slack on the bounds, so that rounding never loses a pair; the exact check decides.
_SLACK = 1e-9


def unit_series(df: DataFrame, value: str, series: str = "series", date: str = "data") -> DataFrame:
    """``series, n_obs, pos, n_dates, z``: centred values of length one per series, at calendar positions.

    NULL values, series and dates are left out; so are series of fewer than
    two values or without variance.  ``df`` has one row per series and date
    (calendar grain), ``pos`` counts the dates that occur in any series.
    """
    present = F.col(series).isNotNull() & F.col(date).isNotNull() & F.col(value).isNotNull()
    # calendar-grained, and read three times below: not derived from the facts each time
    rows = materialize(df.filter(present).select(series, date, F.col(value).cast("double").alias("_v")))
    days = rows.select(date).distinct()
    calendar = days.select(date, (F.row_number().over(Window.orderBy(date)) - 1).alias("pos"))
    own = Window.partitionBy(series)
    centred = rows.withColumn("n_obs", F.count("_v").over(own)).withColumn("_c", F.col("_v") - F.avg("_v").over(own))
    length = F.sqrt(F.sum(F.col("_c") * F.col("_c")).over(own))
    # a constant series keeps only rounding errors after centring
    spread = F.max(F.abs("_v")).over(own) * F.lit(1e-12)
    unit = centred.withColumn("_len", length).withColumn("_eps", spread).filter((F.col("n_obs") > 1) & (F.col("_len") > F.col("_eps")))
    return unit.join(calendar, date).select(
        series, "n_obs", "pos", days.agg(F.count(F.lit(1))).scalar().alias("n_dates"), (F.col("_c") / F.col("_len")).alias("z")
    )


def fourier_sketch(units: DataFrame, frequencies: Sequence[int], series: str = "series") -> DataFrame:
    """One row per series: its dense vector ``z`` and ``sketch``, two Fourier coefficients per frequency.

    The coefficients belong to an orthonormal basis; a frequency that the
    calendar is too short for gives 0, which bounds nothing away.
    """
    t = F.col("n_dates").cast("double")

    def coefficient(k: int, wave) -> Column:
        angle = F.lit(2 * math.pi * k) * F.col("pos") / t
        return F.sum(F.when(F.lit(2 * k) < t, F.col("z") * wave(angle) * F.sqrt(F.lit(2.0) / t)).otherwise(F.lit(0.0)))

    coefficients = [coefficient(k, wave) for k in frequencies for wave in (F.cos, F.sin)]
    held = units.groupBy(series).agg(
        F.max("n_obs").alias("n_obs"),
        F.max("n_dates").alias("n_dates"),
        F.map_from_entries(F.collect_list(F.struct("pos", "z"))).alias("_at"),
        F.array(*coefficients).alias("sketch"),
    )
    positions = F.sequence(F.lit(0), F.col("n_dates").cast("int") - 1)
    dense = F.transform(positions, lambda p: F.coalesce(F.try_element_at("_at", p), F.lit(0.0)))
    return held.select(series, "n_obs", dense.alias("z"), "sketch")


def _cell_sizes(rows: DataFrame, cell_series: int) -> DataFrame:
    """``cell, chunks, groups``: into how many chunks a cell's series are dealt, and into how many groups its chunks."""
    n = F.count(F.lit(1))
    least = F.ceil(n / F.lit(cell_series))
    few = F.least(F.lit(CELL_GROUPS), F.greatest(least, F.ceil(n / F.lit(GROUP_SERIES))))
    groups = F.greatest(few, F.ceil(least / F.lit(GROUP_BLOCKS)))
    return rows.groupBy("cell").agg(F.greatest(least, groups).cast("int").alias("chunks"), groups.cast("int").alias("groups"))


def _side(cells: DataFrame, blocks: DataFrame, offsets: Sequence[tuple], own: str, other: str) -> DataFrame:
    """Each block once for every group it meets, at ``offsets`` from its cell; a cell's own pairs of groups come once."""
    steps = F.explode(F.array(*[F.array(*[F.lit(x) for x in o]) for o in offsets]))
    near = cells.withColumn("_o", steps).withColumn("_n", F.zip_with("cell", "_o", lambda c, o: c + o))
    near = near.join(cells.select(F.col("cell").alias("_n"), F.col("groups").alias("_m")), "_n")
    near = near.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = near.select(
        "cell",
        "chunk",
        (F.col("chunk") % F.col("groups")).alias(f"group_{own}"),
        F.col("_n").alias(f"cell_{other}"),
        F.explode(F.sequence(F.lit(0), F.col("_m") - 1)).alias(f"group_{other}"),
    ).filter((F.col("cell") != F.col(f"cell_{other}")) | (F.col("group_a") <= F.col("group_b")))
    return met.join(blocks, ["cell", "chunk"]).select(
        F.col("cell").alias(f"cell_{own}"),
        f"cell_{other}",
        "group_a",
        "group_b",
        F.col("chunk").alias(f"chunk_{own}"),
        F.col("block").alias(own),
    )


def _pairs_of_blocks(threshold: float):
    """Function of rows ``a, b, same``: the pairs of series of two blocks (or of one, ``same``) at ``threshold`` or more."""

    def matrix(rows) -> np.ndarray:
        return rows.field("z").flatten().to_numpy().reshape(len(rows), -1)

    def pairs(batches):
        for batch in batches:
            for a, b, same in zip(*(batch.column(c) for c in ("a", "b", "same"))):
                a, b = a.values, b.values
                r = matrix(a) @ matrix(b).T
                over = r >= threshold
                i, j = np.nonzero(np.triu(over, 1) if same.as_py() else over)
                columns = [a.field("_s").take(pa.array(i)), b.field("_s").take(pa.array(j)), pa.array(np.minimum(r[i, j], 1.0))]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "r"])

    return pairs


def correlated_pairs(
    panel: DataFrame,
    value: str,
    threshold: float,
    series: str = "series",
    date: str = "data",
    frequencies: Sequence[int] = (1,),
    cell_series: int = CELL_SERIES,
    out: str = "correlacao",
) -> DataFrame:
    """Pairs of series whose changes correlate at ``threshold`` or more.

    Output: ``{series}_a, {series}_b, correlacao`` with a < b, each pair once.
    A date on which one of the two has no change counts for neither (its
    change is taken as the mean of its series); for complete series this is
    Pearson's correlation.  ``frequencies`` (waves per calendar) should be
    those in which the panel's energy lies; the grid has two dimensions for
    each.  A poor choice prunes less and loses nothing.  ``0 < threshold <= 1``.
    """
    changes = panel_pct_change(panel, value, series, date, out="_chg")
    return correlated_values(changes, "_chg", threshold, series, date, frequencies, cell_series, out)


def correlated_values(
    df: DataFrame,
    value: str,
    threshold: float,
    series: str = "series",
    date: str = "data",
    frequencies: Sequence[int] = (1,),
    cell_series: int = CELL_SERIES,
    out: str = "correlacao",
) -> DataFrame:
    """:func:`correlated_pairs` of the values themselves, without taking changes first."""
    if not 0 < threshold <= 1:
        raise ValueError(f"threshold must lie in (0, 1], not {threshold}")
    dims = 2 * len(frequencies)
    width = max(math.sqrt(2 * (1 - threshold)), 1e-3) + _SLACK  # narrower cells only add cells
    sketched = fourier_sketch(unit_series(df, value, series, date), frequencies, series)
    cell = F.transform("sketch", lambda x: F.floor(x / width).cast("int"))
    # one row per series: computed once, read by both sides and by the cell counts
    rows = materialize(sketched.select(F.col(series).alias("_s"), "z", cell.alias("cell")))
    # at most one row per series, mostly a few: computed once, read by the chunks and by both sides
    cells = materialize(_cell_sizes(rows, cell_series))
    dealt = rows.join(cells, "cell").withColumn("chunk", F.pmod(F.xxhash64("_s"), F.col("chunks")).cast("int"))
    blocks = materialize(dealt.groupBy("cell", "chunk").agg(F.collect_list(F.struct("_s", "z")).alias("block")))
    # of each two neighbouring cells only one looks for the other
    ahead = [o for o in itertools.product((-1, 0, 1), repeat=dims) if o >= (0,) * dims]

    a = _side(cells, blocks, ahead, "a", "b")
    b = _side(cells, blocks, [tuple(-x for x in o) for o in ahead], "b", "a")
    one_cell = F.col("cell_a") == F.col("cell_b")
    met = a.join(b, ["cell_a", "cell_b", "group_a", "group_b"])
    # inside one group every two blocks are met from both ends
    met = met.filter(~one_cell | (F.col("group_a") != F.col("group_b")) | (F.col("chunk_a") <= F.col("chunk_b")))
    met = met.select("a", "b", (one_cell & (F.col("chunk_a") == F.col("chunk_b"))).alias("same"))
    kind = df.schema[series].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("r", T.DoubleType())])
    found = met.mapInArrow(_pairs_of_blocks(threshold), schema)
    return found.select(F.least("a", "b").alias(f"{series}_a"), F.greatest("a", "b").alias(f"{series}_b"), F.col("r").alias(out))

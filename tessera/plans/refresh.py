"""Silver and gold by what changed (S10, Q10, Q11): years with new bronze rows, and the years their lag reaches.

Full jobs rewrite every year.  Here the bronze hashes that no earlier refresh
has seen name the years to conform again; silver, the joined table and the
insights get just those year partitions replaced, and the global metrics come
from stored states of the insights' years.  The result is that of
``run_silver`` and ``run_gold``, which write the same layout.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import gold
from tessera.operators.joins import attach_globals, temporal_join
from tessera.operators.silver import dominant_series, monthly_index, monthly_price, silver_index, silver_price
from tessera.operators.states import StoredStates, metrics_from_states, pair_states
from tessera.plans import layers
from tessera.session import shared_copy
from tessera.sources import catalog
from tessera.sources.files import load_if_exists
from tessera.sources.hash_index import HashIndex
from tessera.sources.sinks import overwrite_table, replace_partitions


@dataclass(frozen=True)
class Refreshed:
    """Years rewritten in silver (both tables together) and in the gold insights; ``full`` if all were."""

    silver: tuple[int, ...]
    gold: tuple[int, ...]
    full: bool = False


def _years(df: DataFrame) -> list[int]:
    """Distinct years, ascending: as many as the calendar has."""
    return sorted(r[0] for r in df.select("ano").distinct().collect() if r[0] is not None)


def lag_reach(changed: Iterable[int], years: Iterable[int]) -> tuple[list[int], list[int]]:
    """``(write, read)`` for a lag by one row over the rows of ``years``, of which ``changed`` changed.

    The first row of the next year that has rows looks back into a changed
    year, so that year is written too; to compute a year, the last year with
    rows before it is read.
    """
    have = sorted(set(years))
    after = {y: nxt for y, nxt in zip(have, have[1:])}
    before = {nxt: y for y, nxt in after.items()}
    changed = set(changed)
    # a changed year without rows hands its change to the next one with rows all the same
    following = {min((y for y in have if y > c), default=None) for c in changed}
    write = {y for y in have if y in changed or y in following}
    read = write | {before[y] for y in write if y in before}
    return sorted(write), sorted(read)


class _Layer:
    """One bronze table, its silver table and the hashes that refreshes have carried over."""

    def __init__(self, spark: SparkSession, lake: layers.Lakehouse, table: str, hash_col: str, conform):
        self.table, self.conform = table, conform
        self.bronze = lake.read(spark, "bronze", table)
        self.seen = HashIndex(spark, f"{lake.path('silver', table)}_refreshed_hashes", hash_col)
        # hash and partition columns only
        self.fresh = shared_copy(self.seen.new_only(self.bronze.select(hash_col, "ano").distinct()), "fresh-hashes")
        self.years = _years(self.fresh)

    def write(self, lake: layers.Lakehouse, full: bool) -> None:
        path = lake.path("silver", self.table)
        if full:
            overwrite_table(self.conform(self.bronze), path, lake.fmt, by=["ano"])
        elif self.years:
            replace_partitions(self.conform(self.bronze.filter(F.col("ano").isin(self.years))), path, lake.fmt, by=["ano"])


def _chosen_series(index: DataFrame) -> int | None:
    row = dominant_series(index.select("series_id")).first()
    return None if row is None else row[0]


def run_refresh(spark: SparkSession, lake: layers.Lakehouse, register: bool = True) -> Refreshed:
    """Bring silver and gold up to bronze, at the cost of the years that changed.

    The first run, and one after which another index series has the most
    months, is a full refresh.  The analytic table carries the global metrics
    in every row, so it is written anew whenever anything changed; its rows
    come from the insights and the states, not from silver.  A run that stops
    repeats the same years next time: hashes are noted as seen last.
    """
    price = _Layer(spark, lake, lake.price_table, "file_hash", silver_price)
    index = _Layer(spark, lake, lake.index_table, "payload_hash", silver_index)
    first = price.seen.known() is None or index.seen.known() is None
    changed = sorted({*price.years, *index.years})
    if not first and price.fresh.isEmpty() and index.fresh.isEmpty():
        return Refreshed((), ())
    for layer in (price, index):
        layer.write(lake, first)

    p = monthly_price(lake.read(spark, "silver", lake.price_table))
    i = monthly_index(lake.read(spark, "silver", lake.index_table))
    chosen = _chosen_series(i)
    chosen_path = f"{lake.path('gold', layers.GOLD_JOINED)}_series"
    before = load_if_exists(spark, chosen_path)
    full = first or before is None or before.first()[0] != chosen

    joined_path = lake.path("gold", layers.GOLD_JOINED)
    wanted = F.lit(True) if full else F.col("ano").isin(changed)
    i = i.filter(wanted & F.col("series_id").eqNullSafe(F.lit(chosen))).drop("series_id")
    joined = temporal_join(p.filter(wanted), i, on=["data"], how="inner", coalesce_cols=["ano", "mes"])
    if full:
        overwrite_table(joined, joined_path, lake.fmt, sort_by=["data"], by=["ano"])
    else:
        replace_partitions(joined, joined_path, lake.fmt, by=["ano"], sort_by=["data"])
    j = lake.read(spark, "gold", layers.GOLD_JOINED)
    years = _years(j)

    states = StoredStates(spark, f"{lake.path('gold', layers.GOLD_INSIGHTS)}_states", ["ano"])
    full = full or states.current() is None
    write, read = (years, years) if full else lag_reach(changed, years)
    ins = gold.insights(j.filter(F.col("ano").isin(read))).filter(F.col("ano").isin(write))
    insights_path, spec = lake.path("gold", layers.GOLD_INSIGHTS), gold.DEFAULT_SPEC
    if full:
        overwrite_table(ins, insights_path, lake.fmt, sort_by=["data"], by=["ano"])
    else:
        replace_partitions(ins, insights_path, lake.fmt, by=["ano"], sort_by=["data"])
    written = lake.read(spark, "gold", layers.GOLD_INSIGHTS)
    part = pair_states(written.filter(F.col("ano").isin(write)), ["ano"], spec.index_change, spec.price_change)
    (states.replace if full else states.update)(part)

    metrics = metrics_from_states(states.current())
    analytic = attach_globals(gold.classify(written), metrics)
    overwrite_table(analytic, lake.path("gold", layers.GOLD_ANALYTIC), lake.fmt, sort_by=["data"], by=["ano"])
    spark.createDataFrame([(chosen,)], "series_id int").write.mode("overwrite").parquet(chosen_path)
    if register:
        _register(spark, lake, price, index, changed, write, first, full)
    for layer in (price, index):
        hashes = layer.fresh.select(layer.seen.hash_col).distinct()
        layer.seen.add(hashes.filter(F.col(layer.seen.hash_col).isNotNull()))
    return Refreshed(tuple(changed), tuple(write), full)


def _register(spark, lake, price, index, changed, write, first, full) -> None:
    """Tables and the dashboard view; only the years that were written are added to known tables."""
    for layer in (price, index):
        layers.publish(spark, lake, "silver", layer.table, None if first else [{"ano": y} for y in layer.years])
    for table, years in ((layers.GOLD_JOINED, changed), (layers.GOLD_INSIGHTS, write), (layers.GOLD_ANALYTIC, write)):
        layers.publish(spark, lake, "gold", table, None if full else [{"ano": y} for y in years])
    catalog.create_dashboard_view(spark, f"gold.{layers.GOLD_VIEW}", f"gold.{layers.GOLD_ANALYTIC}")

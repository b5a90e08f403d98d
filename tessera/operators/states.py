"""Global metrics from stored partial states.

A state holds the number of pairs, both means, both sums of squared
deviations and the sum of their products: merged, states give correlation and
means without the rows.  Deviations are taken from the group's own mean and,
when merged, from the total mean, so no large squares are subtracted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.basic import dedupe_latest
from tessera.operators.gold import DEFAULT_SPEC, GoldSpec
from tessera.sources.files import load_if_exists

STATE = ("n", "mean_a", "mean_b", "m2_a", "m2_b", "co")


def pair_states(df: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """``*keys`` and the state of the rows under them, pairs with a NULL left out; combined map-side.

    A group without a full pair keeps a state of no rows, so that an
    update can take away what it held before.
    """
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
    n = F.count(x)
    sums = {"n": n, "mean_a": F.avg(x), "mean_b": F.avg(y), "m2_a": F.var_pop(x) * n, "m2_b": F.var_pop(y) * n, "co": F.covar_pop(x, y) * n}
    return df.groupBy(*keys).agg(*[s.alias(name) for name, s in sums.items()])


def merge_states(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """States of the parents named by ``keys`` (one row for none), from any deeper level."""
    held = states.filter(F.col("n") > 0)
    own = Window.partitionBy(*(keys or [F.lit(0)]))
    n = F.col("n")
    for c in ("a", "b"):
        # the parent's mean, next to each child: a panel of states is far smaller than its rows
        held = held.withColumn(f"_d{c}", F.col(f"mean_{c}") - F.sum(n * F.col(f"mean_{c}")).over(own) / F.sum(n).over(own))
    between = {"m2_a": F.col("_da") * F.col("_da"), "m2_b": F.col("_db") * F.col("_db"), "co": F.col("_da") * F.col("_db")}
    means = [F.try_divide(F.sum(n * F.col(c)), F.sum(n)).alias(c) for c in ("mean_a", "mean_b")]
    spread = [F.sum(F.col(c) + n * d).alias(c) for c, d in between.items()]
    return held.groupBy(*keys).agg(F.coalesce(F.sum(n), F.lit(0)).alias("n"), *means, *spread)


def metrics_from_states(states: DataFrame, keys: Sequence[str] = (), spec: GoldSpec = DEFAULT_SPEC) -> DataFrame:
    """The columns of :func:`tessera.operators.gold.global_metrics`, from states of (index, price) changes."""
    total = merge_states(states, keys)
    corr = F.try_divide(F.col("co"), F.sqrt("m2_a") * F.sqrt("m2_b"))
    return total.select(
        *keys,
        corr.alias("correlacao_global"),
        F.col("mean_a").alias("media_ipca_global"),
        F.col("mean_b").alias("media_boi_global"),
        F.round((F.col("mean_a") + F.col("mean_b")) / F.lit(2.0), 4).alias("media_combinada_global"),
    )


class StoredStates:
    """States of a table's groups, kept under ``path``; an update appends the states of the groups that changed."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    def current(self) -> DataFrame | None:
        """The latest state of each group; None if none were stored."""
        stored = load_if_exists(self.spark, self.path)
        return None if stored is None else dedupe_latest(stored, self.keys, ["version"]).drop("version")

    def update(self, states: DataFrame) -> None:
        """Take ``states`` (whole groups) instead of what was stored for their keys."""
        stored = load_if_exists(self.spark, self.path)
        version = 1 if stored is None else (stored.agg(F.max("version")).first()[0] or 0) + 1
        states.withColumn("version", F.lit(version)).write.mode("append").parquet(self.path)

    def replace(self, states: DataFrame) -> None:
        """Start anew from ``states``."""
        states.withColumn("version", F.lit(1)).write.mode("overwrite").parquet(self.path)

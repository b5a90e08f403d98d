"""Gold layer: lag, % change, classification, global metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.rules import (
    DEFAULT_LABELS,
    RuleLabels,
    impact_class,
    leader_flag,
    mean_change,
    pct_change_expr,
    safe_corr,
)
from tessera.operators.frames import with_lag
from tessera.operators.joins import attach_globals


# Column names of the gold tables.
@dataclass(frozen=True)
class GoldSpec:
    """Column names of the gold tables (defaults: the layer schemas)."""

    date: str = "data"
    price: str = "preco_boi_gordo"
    index: str = "ipca_mensal"
    price_change: str = "variacao_boi"
    index_change: str = "variacao_ipca"
    by: tuple[str, ...] = ()
    labels: RuleLabels = field(default=DEFAULT_LABELS)


DEFAULT_SPEC = GoldSpec()


def lag_prev(
    df: DataFrame, values: dict[str, str], order: str = "data", by: Sequence[str] = ()
) -> DataFrame:
    """``{out: previous row's src}`` ordered by ``order`` within ``by``."""
    return with_lag(df, order, values, by=by)


def pct_change(
    df: DataFrame, values: dict[str, str], order: str = "data", by: Sequence[str] = ()
) -> DataFrame:
    """``{out: % change of src vs the previous row}`` (W2); first row NULL."""
    prev = {f"_prev_{out}": src for out, src in values.items()}
    lagged = with_lag(df, order, prev, by=by)
    return lagged.withColumns(
        {out: pct_change_expr(src, f"_prev_{out}") for out, src in values.items()}
    ).drop(*prev.keys())


def insights(joined: DataFrame, spec: GoldSpec = DEFAULT_SPEC) -> DataFrame:
    """Joined series + index and price % change."""
    return pct_change(
        joined,
        {spec.index_change: spec.index, spec.price_change: spec.price},
        order=spec.date,
        by=spec.by,
    )


def classify(df: DataFrame, spec: GoldSpec = DEFAULT_SPEC) -> DataFrame:
    """Mean of changes, leader flag and impact class."""
    p, i, lab = spec.price_change, spec.index_change, spec.labels
    return df.withColumns(
        {
            "media_variacoes": mean_change(i, p, 2),
            "destaque": leader_flag(p, i, lab),
            "classe_impacto": impact_class(p, i, lab),
        }
    )


def global_metrics(df: DataFrame, spec: GoldSpec = DEFAULT_SPEC) -> DataFrame:
    """Correlation, means and combined mean of the two changes.

    Rows where either change is NULL are excluded first.  One aggregate pass,
    partial-aggregated on the map side: one row overall, or one row per
    series when ``spec.by`` names a series key (panel).
    """
    i, p = F.col(spec.index_change), F.col(spec.price_change)
    base = df.filter(i.isNotNull() & p.isNotNull())
    aggs = [
        safe_corr(i, p).alias("correlacao_global"),
        F.avg(i).alias("media_ipca_global"),
        F.avg(p).alias("media_boi_global"),
    ]
    grouped = base.groupBy(*spec.by).agg(*aggs) if spec.by else base.agg(*aggs)
    return grouped.withColumn(
        "media_combinada_global",
        F.round((F.col("media_ipca_global") + F.col("media_boi_global")) / F.lit(2.0), 4),
    )


def analytic(joined: DataFrame, spec: GoldSpec = DEFAULT_SPEC) -> DataFrame:
    """Gold analytic table (G6): insights + rules + global metrics, one lazy plan.

    Single series: the metrics row is attached by a scalar subquery.  Panel
    (``spec.by``): per-series metrics are equi-joined on the series key (one
    row per series, so the join never fans out); a series whose changes are
    all NULL gets NULL metrics.  The key is a struct, in which NULL series
    are equal, and window, aggregate and join share its partitioning.
    """
    if not spec.by:
        ins = classify(insights(joined, spec), spec)
        return attach_globals(ins, global_metrics(ins, spec))
    # the key replaces its columns, so that the rows and the metrics read the same shuffled columns
    key = F.struct(*[F.col(c) for c in spec.by]).alias("_s")
    keyed, by_key = joined.select(key, *[c for c in joined.columns if c not in spec.by]), replace(spec, by=("_s",))
    ins = classify(insights(keyed, by_key), by_key)
    out = ins.join(global_metrics(ins, by_key), on="_s", how="left")
    return out.select(*[F.col(f"_s.{c}").alias(c) for c in spec.by], *out.drop("_s").columns)


DASHBOARD_COLS = ("data", "variacao_ipca", "variacao_boi", "destaque", "classe_impacto")


def dashboard(df: DataFrame, cols: Sequence[str] = DASHBOARD_COLS) -> DataFrame:
    """Five-column dashboard projection."""
    return df.select(*cols)

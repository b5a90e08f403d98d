"""Roadmap operators on keyed series.

The series are calendar-grained (one row per series and period); see
:mod:`tessera.operators.frames` for what that means and for ``method="blocks"``
and ``"scan"`` on raw-grained ones.  The frame operators take
``method="moments"`` for long frames (a row costs the same for any ``k``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.rules import pct_change_expr, safe_corr
from tessera.operators.frames import frame_moments, frame_sums, running_sums, with_lag, with_rolling
from tessera.operators.joins import temporal_join


def _log_factor(rate: str):
    """ln(1 + rate/100); NULL for rate <= -100 (factor not positive)."""
    r = F.col(rate)
    return F.when(r > F.lit(-100.0), F.log1p(r / F.lit(100.0)))


def _change(value: str):
    """% change from the previous row of an ordered window."""
    return lambda w: pct_change_expr(F.col(value), F.lag(value).over(w))


def deflate(
    df: DataFrame,
    price: str,
    rate: str,
    order: str = "data",
    by: Sequence[str] = (),
    index_out: str = "indice_acumulado",
    out: str = "preco_deflacionado",
    method: str = "window",
) -> DataFrame:
    """Price divided by the cumulative index ∏(1 + r/100) up to each period.

    Base = before the first period.  The running product is exp of a running
    sum of ln(1 + r/100).  From a gap on (a rate that is NULL or not above
    -100) the index is unknown: index and deflated price are NULL.
    """
    lf = _log_factor(rate)
    gap = F.when(lf.isNull(), F.lit(1.0)).otherwise(F.lit(0.0))
    summed = running_sums(df, order, {"_ls": F.coalesce(lf, F.lit(0.0)), "_gaps": gap}, by=by, method=method)
    return (
        summed.withColumn(index_out, F.when(F.col("_gaps") == 0, F.exp("_ls")))
        .withColumn(out, F.try_divide(F.col(price), F.col(index_out)))
        .drop("_ls", "_gaps")
    )


def accumulate(
    df: DataFrame,
    rate: str,
    k: int = 12,
    order: str = "data",
    by: Sequence[str] = (),
    out: str = "acumulado_12m",
    method: str = "window",
) -> DataFrame:
    """(∏ over the last k rows (1 + r/100) − 1) × 100; NULL before k rows."""
    lf = _log_factor(rate)
    if method == "moments":
        summed = frame_sums(df, order, by, k, {"_ls": lf, "_n": F.when(lf.isNotNull(), F.lit(1))})
        grown = (F.exp("_ls") - F.lit(1.0)) * F.lit(100.0)
        return summed.withColumn(out, F.when(F.col("_n") == k, grown)).drop("_ls", "_n")
    full = {
        out: lambda w: F.when(
            F.count(lf).over(w) == F.lit(k), (F.exp(F.sum(lf).over(w)) - F.lit(1.0)) * F.lit(100.0)
        )
    }
    return with_rolling(df, order, by, k, full, method=method)


def period_agg(
    df: DataFrame, period: str, value: str, date: str = "data", by: Sequence[str] = ()
) -> DataFrame:
    """Mean, min, max and last value per quarter or year.

    ``period`` is "quarter" or "year".  ``last`` is ``max_by(value, date)``,
    a regular aggregate (map-side combinable).
    """
    keys = [*by, F.year(date).alias("ano")]
    if period == "quarter":
        keys.append(F.quarter(date).alias("trimestre"))
    elif period != "year":
        raise ValueError("period must be 'quarter' or 'year'")
    v = F.col(value)
    return df.groupBy(*keys).agg(
        F.avg(v).alias("media"),
        F.min(v).alias("minimo"),
        F.max(v).alias("maximo"),
        F.max_by(v, F.col(date)).alias("ultimo"),
        F.count(F.lit(1)).alias("n_meses"),
    )


def period_rollup(df: DataFrame, value: str, date: str = "data", by: Sequence[str] = ()) -> DataFrame:
    """Quarterly rows plus yearly subtotals in one aggregate pass (X3, grouping sets).

    ``trimestre`` is NULL on the yearly rows (and for NULL dates, whose
    quarter and year are both NULL); there is no grand total.
    """
    v = F.col(value)
    dated = df.withColumns({"ano": F.year(date), "trimestre": F.quarter(date)})
    keys = [F.col(c) for c in (*by, "ano", "trimestre")]
    return dated.groupingSets([keys, keys[:-1]], *keys).agg(
        F.avg(v).alias("media"),
        F.min(v).alias("minimo"),
        F.max(v).alias("maximo"),
        F.max_by(v, F.col(date)).alias("ultimo"),
        F.count(F.lit(1)).alias("n_meses"),
    )


def moving_avg(
    df: DataFrame,
    value: str,
    k: int = 3,
    order: str = "data",
    by: Sequence[str] = (),
    out: str | None = None,
    method: str = "window",
) -> DataFrame:
    """Trailing k-row mean; NULL until k rows are available."""
    out = out or f"media_movel_{k}"
    if method == "moments":
        summed = frame_sums(df, order, by, k, {"_rows": F.lit(1), "_s": F.col(value), "_n": F.when(F.col(value).isNotNull(), F.lit(1))})
        return summed.withColumn(out, F.when(F.col("_rows") == k, F.col("_s") / F.col("_n"))).drop("_rows", "_s", "_n")
    full = {out: lambda w: F.when(F.count(F.lit(1)).over(w) == F.lit(k), F.avg(value).over(w))}
    return with_rolling(df, order, by, k, full, method=method)


def volatility(
    df: DataFrame,
    value: str,
    k: int = 12,
    order: str = "data",
    by: Sequence[str] = (),
    out: str | None = None,
    method: str = "window",
) -> DataFrame:
    """Trailing k-row sample std-dev of the % change of ``value``.

    The change of the first row is NULL, so a frame needs two non-NULL
    changes for a value.  Change and frame share one pass.
    """
    out = out or f"volatilidade_{k}"
    if method == "moments":
        lagged = with_lag(df, order, {"_chg": value}, by).withColumn("_chg", pct_change_expr(F.col(value), F.col("_chg")))
        summed, m = frame_moments(lagged, order, by, k, "_chg")
        return summed.withColumn(out, _sample_std(m["var_a"], m["n"])).select(*df.columns, out)
    std = {out: lambda w: F.stddev_samp("_chg").over(w)}
    return with_rolling(df, order, by, k, std, before={"_chg": _change(value)}, method=method).drop("_chg")


def _sample_std(variance, n):
    """Sample standard deviation from the population variance; NULL for fewer than two values."""
    return F.when(n > 1, F.sqrt(variance * n / (n - F.lit(1))))


def trend_slope(
    df: DataFrame, value: str, date: str = "data", by: Sequence[str] = (), out: str = "inclinacao"
) -> DataFrame:
    """Least-squares slope of value on the month index (year*12 + month), per series."""
    t = (F.year(date) * F.lit(12) + F.month(date)).cast("double")
    aggs = [F.regr_slope(F.col(value), t).alias(out), F.count(F.col(value)).alias("n_obs")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def rolling_corr(
    df: DataFrame,
    a: str,
    b: str,
    k: int = 12,
    order: str = "data",
    by: Sequence[str] = (),
    out: str | None = None,
    method: str = "window",
) -> DataFrame:
    """Correlation of a and b over the trailing k rows, NULL-safe."""
    out = out or f"correlacao_{k}"
    if method == "moments":
        summed, m = frame_moments(df, order, by, k, a, b)
        spread = m["var_a"] * m["var_b"]
        return summed.withColumn(out, F.when(spread > 0, m["cov"] / F.sqrt(spread))).select(*df.columns, out)
    return with_rolling(df, order, by, k, {out: lambda w: safe_corr(a, b, w)}, method=method)


def rolling_change_corr(
    df: DataFrame,
    changes: tuple[tuple[str, str], tuple[str, str]],
    k: int = 12,
    order: str = "data",
    by: Sequence[str] = (),
    out: str | None = None,
    method: str = "window",
) -> DataFrame:
    """% changes of two columns, ``((out, src), (out, src))``, and their rolling correlation, in one pass."""
    out = out or f"correlacao_{k}"
    (a, src_a), (b, src_b) = changes
    if method == "moments":
        lagged = with_lag(df, order, {a: src_a, b: src_b}, by)
        changed = lagged.withColumns({a: pct_change_expr(F.col(src_a), F.col(a)), b: pct_change_expr(F.col(src_b), F.col(b))})
        return rolling_corr(changed, a, b, k, order, by, out, method)
    before = {a: _change(src_a), b: _change(src_b)}
    return with_rolling(df, order, by, k, {out: lambda w: safe_corr(a, b, w)}, before=before, method=method)


def yoy_change(
    df: DataFrame, value: str, date: str = "data", by: Sequence[str] = (), out: str = "variacao_12m"
) -> DataFrame:
    """% change vs the same calendar day one year earlier.

    A self equi-join on (series, year - 1, month, day): each row matches at
    most one earlier row (29 February only one of the year before: none), so
    the join never fans out.  NULL series match each other; NULL dates nothing.
    """
    day = [F.month(date).alias("_m"), F.dayofmonth(date).alias("_d")]
    series = F.struct(*[F.col(c) for c in by]) if by else F.lit(0)
    now = df.select("*", series.alias("_s"), F.year(date).alias("_y"), *day)
    earlier = df.select(series.alias("_s"), (F.year(date) + 1).alias("_y"), *day, F.col(value).alias("_prev_year"))
    j = now.join(earlier, on=["_s", "_y", "_m", "_d"], how="left")
    return j.withColumn(out, pct_change_expr(value, "_prev_year")).select(*df.columns, out)


def panel_pct_change(
    df: DataFrame, value: str, series: str = "series", order: str = "data", out: str = "variacao"
) -> DataFrame:
    """Period-over-period % change of every series of a panel."""
    lagged = with_lag(df, order, {"_prev": value}, by=[series])
    return lagged.withColumn(out, pct_change_expr(value, "_prev")).drop("_prev")


def panel_corr(
    panel: DataFrame,
    reference: DataFrame,
    value: str,
    ref_value: str,
    series: str = "series",
    date: str = "data",
    out: str = "correlacao",
) -> DataFrame:
    """Correlation of each series' % change with a reference series' % change.

    Re-aimed from all-pairs: the panel is equi-joined to the one reference
    row per date (no pair explosion), then aggregated per series.
    """
    p = panel_pct_change(panel, value, series, date, out="_chg")
    ref = panel_pct_change(
        reference.select(F.lit("ref").alias("_s"), date, ref_value), ref_value, "_s", date, out="_ref_chg"
    ).select(date, "_ref_chg")
    joined = temporal_join(p, ref, on=[date], how="inner")
    return joined.groupBy(series).agg(
        safe_corr("_chg", "_ref_chg").alias(out),
        F.count_if(F.col("_chg").isNotNull() & F.col("_ref_chg").isNotNull()).alias("n_pares"),
    )

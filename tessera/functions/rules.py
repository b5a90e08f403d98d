"""Business-rule column expressions of the gold layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.util import as_col


# Labels and thresholds of the gold classification rules.
@dataclass(frozen=True)
class RuleLabels:
    price_leads: str = "Preço do boi cresce mais"
    index_leads: str = "Inflação cresce mais"
    tie: str = "Empate"
    high: str = "Alta divergência"
    medium: str = "Média divergência"
    low: str = "Baixa divergência"
    lo: float = 2.0
    hi: float = 5.0


DEFAULT_LABELS = RuleLabels()


def pct_change_expr(cur, prev) -> Column:
    """(cur - prev) / prev * 100 with signed denominator; NULL when prev is 0 or NULL."""
    cur, prev = as_col(cur), as_col(prev)
    return F.try_divide(cur - prev, prev) * F.lit(100.0)


def mean_change(a, b, digits: int = 2) -> Column:
    """round((a + b) / 2, digits), HALF_UP."""
    return F.round((as_col(a) + as_col(b)) / F.lit(2.0), digits)


def leader_flag(price_change, index_change, labels: RuleLabels = DEFAULT_LABELS) -> Column:
    """Which change is larger; equal or NULL falls through to the tie label."""
    p, i = as_col(price_change), as_col(index_change)
    return (
        F.when(p > i, F.lit(labels.price_leads))
        .when(i > p, F.lit(labels.index_leads))
        .otherwise(F.lit(labels.tie))
    )


def impact_class(price_change, index_change, labels: RuleLabels = DEFAULT_LABELS) -> Column:
    """Class of |price - index|: > hi high, [lo, hi] medium, else (incl. NULL) low."""
    d = F.abs(as_col(price_change) - as_col(index_change))
    return (
        F.when(d > F.lit(labels.hi), F.lit(labels.high))
        .when(d.between(labels.lo, labels.hi), F.lit(labels.medium))
        .otherwise(F.lit(labels.low))
    )


def safe_corr(a, b, window=None) -> Column:
    """Pearson correlation skipping NULL pairs; NULL for < 2 pairs or zero variance.

    An aggregate, or a window expression when ``window`` is given.  ``corr``
    itself raises DIVIDE_BY_ZERO on a constant series under ANSI.
    """
    a, b = as_col(a), as_col(b)
    both = a.isNotNull() & b.isNotNull()
    a2 = F.when(both, a)
    b2 = F.when(both, b)
    aggs = [F.covar_pop(a2, b2), F.stddev_pop(a2), F.stddev_pop(b2)]
    if window is not None:
        aggs = [x.over(window) for x in aggs]
    cov, sa, sb = aggs
    return F.try_divide(cov, sa * sb)

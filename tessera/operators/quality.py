"""One-pass data-quality checks.

Each report is a single aggregate over the data (partial-aggregated per
task), returned as a DataFrame; the ``check_*`` wrappers fetch that one small
result row and raise on failure.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.basic import duplicate_keys

# Fixed value: the month-text rule of the bronze check ("MM/YYYY", month 01-12).
MONTH_TEXT = r"^(0[1-9]|1[0-2])/[0-9]{4}$"


class DataQualityError(ValueError):
    """Raised by the ``check_*`` functions."""


def pattern_report(df: DataFrame, col: str, regex: str = MONTH_TEXT, by: Sequence[str] = ()) -> DataFrame:
    """Rows, invalid (non-NULL, not matching) and NULL counts of ``col``."""
    c = F.col(col)
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(c.isNotNull() & ~c.rlike(regex)).alias("n_invalid"),
        F.count_if(c.isNull()).alias("n_null"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def check_pattern(df: DataFrame, col: str, regex: str = MONTH_TEXT) -> dict:
    """Raise :class:`DataQualityError` if any non-NULL value fails ``regex``."""
    r = pattern_report(df, col, regex).first().asDict()
    if r["n_invalid"] > 0:
        raise DataQualityError(f"{r['n_invalid']} row(s) with invalid {col}")
    return r


def reason_mask(rules: Mapping[str, Column]) -> Column:
    """A long with bit ``i`` set where the ``i``-th rule (a condition that a *bad* row meets) holds; 0 for a good row."""
    bits = [F.when(F.coalesce(bad, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)) for i, bad in enumerate(rules.values())]
    mask = F.lit(0)
    for bit in bits:
        mask = mask.bitwiseOR(bit)
    return mask.cast("long")


def null_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_null, n_rows) for every column, from one aggregate pass (Q5)."""
    cols = list(cols or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)],
    )
    stack = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    return counts.selectExpr(f"stack({len(cols)}, {stack}) as (`column`, n_null)", "_rows as n_rows")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> dict:
    """Raise if any of ``cols`` holds a NULL; returns {column: n_null}."""
    res = {r["column"]: r["n_null"] for r in null_report(df, cols).collect()}
    bad = {c: n for c, n in res.items() if n > 0}
    if bad:
        raise DataQualityError(f"NULL values: {bad}")
    return res


# Supersets of the text Spark can cast to a number: anything outside them is
# certainly uncastable and skips `try_cast` (which pays an exception per
# non-numeric row).  Whitespace is what Spark trims (chars <= ' ').
_INTEGRAL_TEXT = r"^[\x00-\x20]*[+-]?[0-9]*\.?[0-9]*[\x00-\x20]*$"
_FRACTIONAL_TEXT = r"(?i)[0-9]|nan|inf"
_INTEGRAL = {"tinyint", "smallint", "int", "bigint"}


def uncastable(c, target: str, source: str = "string"):
    """Column: True where ``c`` is non-NULL and does not cast to ``target``."""
    col = F.col(c) if isinstance(c, str) else c
    failed = col.isNotNull() & col.try_cast(target).isNull()
    if source != "string":
        return failed
    if target in _INTEGRAL:
        screen = _INTEGRAL_TEXT
    elif target in {"float", "double"} or target.startswith("decimal"):
        screen = _FRACTIONAL_TEXT
    else:
        return failed
    return F.when(col.isNull(), F.lit(False)).when(~col.rlike(screen), F.lit(True)).otherwise(failed)


def rule_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, n_violations, n_rows): every rule counted in ONE aggregate pass.

    ``rules`` maps a name to a boolean Column that is True on a violating
    row (NULL counts as no violation).
    """
    names = list(rules)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.coalesce(rules[n], F.lit(False))).alias(f"_r{i}") for i, n in enumerate(names)],
    )
    stack = ", ".join(f"'{n}', _r{i}" for i, n in enumerate(names))
    return counts.selectExpr(f"stack({len(names)}, {stack}) as (rule, n_violations)", "_rows as n_rows")


def bronze_rules(month_col: str = "mes_ano", lineage: Sequence[str] = ("file_hash", "source_file")) -> dict:
    """The bronze price rules: month text format, plus NULL lineage columns."""
    m = F.col(month_col)
    rules = {f"{month_col}_format": m.isNotNull() & ~m.rlike(MONTH_TEXT), f"{month_col}_null": m.isNull()}
    rules.update({f"{c}_null": F.col(c).isNull() for c in lineage})
    return rules


def check_rules(df: DataFrame, rules: Mapping[str, Column]) -> dict:
    """Raise :class:`DataQualityError` listing every violated rule; one pass."""
    res = {r["rule"]: r["n_violations"] for r in rule_report(df, rules).collect()}
    bad = {k: v for k, v in res.items() if v}
    if bad:
        raise DataQualityError(f"rule violations: {bad}")
    return res


def _type_name(t) -> str:
    """Type text of an expected type: a name, a DataType, or a DataType class."""
    if isinstance(t, str):
        return t
    if isinstance(t, type) and issubclass(t, T.DataType):
        return t().simpleString()
    return t.simpleString()


def _matches(actual: T.DataType, expected) -> bool:
    """A DataType *class* matches any parameters (decimal(12,2) is a DecimalType);
    a name or instance must match exactly."""
    if isinstance(expected, type) and issubclass(expected, T.DataType):
        return isinstance(actual, expected)
    return actual.simpleString() == _type_name(expected)


def schema_contract(df: DataFrame, expected: Mapping[str, object]) -> DataFrame:
    """Compare ``df`` with an expected {column: type} contract (Q6).

    ``expected`` values are type names ("int"), DataType instances, or
    DataType classes (``T.DecimalType`` matches any precision and scale).
    Returns one row per column: ``column, status (ok|missing|extra|wrong_type),
    actual, expected, n_uncastable``.  For a wrong-typed column
    ``n_uncastable`` counts non-NULL values that do not cast to the expected
    type — all such counts come from one aggregate pass over the data.
    The metadata side has one row per column (bounded by the schema width).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    actual = {c: t.simpleString() for c, t in types.items()}
    exp = {c: _type_name(t) for c, t in expected.items()}
    rows = []
    for c, t in exp.items():
        if c not in actual:
            rows.append((c, "missing", None, t))
        elif not _matches(types[c], expected[c]):
            rows.append((c, "wrong_type", actual[c], t))
        else:
            rows.append((c, "ok", actual[c], t))
    rows += [(c, "extra", a, None) for c, a in actual.items() if c not in exp]
    # Built in the JVM from literals (no Python worker): one row per column.
    meta = df.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.lit(s).alias("status"),
                        F.lit(a).cast("string").alias("actual"),
                        F.lit(t).cast("string").alias("expected"),
                    )
                    for c, s, a, t in rows
                ]
            )
        )
    )
    wrong = [(c, t) for c, s, _, t in rows if s == "wrong_type"]
    if not wrong:
        return meta.withColumn("n_uncastable", F.lit(None).cast("bigint"))
    counts = df.agg(
        *[
            F.count_if(uncastable(c, t, actual[c])).alias(f"_u{i}")
            for i, (c, t) in enumerate(wrong)
        ]
    )
    stack = ", ".join(f"'{c}', _u{i}" for i, (c, _) in enumerate(wrong))
    per_column = counts.selectExpr(f"stack({len(wrong)}, {stack}) as (`column`, n_uncastable)")
    # per_column has one row per wrong-typed column: bounded by the schema width.
    return meta.join(F.broadcast(per_column), on="column", how="left").select(
        "column", "status", "actual", "expected", "n_uncastable"
    )


def contract_ok(report: DataFrame) -> bool:
    """OK when no column is missing or wrong-typed (extra columns are allowed)."""
    return report.filter(F.col("status").isin("missing", "wrong_type")).isEmpty()


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if any key occurs more than once (Q7)."""
    if not duplicate_keys(df, *keys).isEmpty():
        raise DataQualityError(f"duplicate keys on {list(keys)}")

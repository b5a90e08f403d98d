"""Tolerant parsing of locale-formatted numbers, dates and file names.

All functions return built-in Column expressions (codegen'd, no UDF).  Bad
input gives NULL through the ``try_*`` family, so the same code behaves the
same with ANSI mode on or off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.util import as_col

NBSP = " "
# A dot-only text is a thousands-grouped integer ("1.234", "12.345.678") only
# when every group after the first has exactly three digits.
THOUSANDS_ONLY = r"^-?[0-9]{1,3}(\.[0-9]{3})+$"
UTC_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_ptbr_number(c) -> Column:
    """pt-BR number text -> double: "1.234,56" -> 1234.56, " 310,5 " -> 310.5.

    NBSP becomes a space and the text is trimmed.  Dots are thousands
    separators only when a comma is present or the text is a grouped integer,
    so a cell that is already numeric ("310.5") keeps its value.
    """
    v = F.trim(F.translate(as_col(c), NBSP, " "))
    grouped = F.contains(v, F.lit(",")) | v.rlike(THOUSANDS_ONLY)
    no_thousands = F.when(grouped, F.translate(v, ".", "")).otherwise(v)
    return F.translate(no_thousands, ",", ".").try_cast("double")


def parse_comma_decimal(c) -> Column:
    """Comma-decimal text without thousands grouping: "0,42" -> 0.42."""
    return F.translate(as_col(c), ",", ".").try_cast("double")


def format_ptbr_number(c, digits: int = 2) -> Column:
    """double -> pt-BR text with '.' thousands and ',' decimals (inverse of F1)."""
    return F.translate(F.format_number(as_col(c), digits), ",.", ".,")


_MONTH_IN = r"^([0-9]{1,2})/([0-9]{4})$"


def parse_month(c) -> Column:
    """Tolerant "M/yyyy" or "MM/yyyy" (trimmed) re-rendered as "MM/yyyy"; invalid -> NULL.

    Plain string work (regex + range check), no date formatter per row.
    """
    v = F.trim(as_col(c))
    m = F.regexp_extract(v, _MONTH_IN, 1)
    y = F.regexp_extract(v, _MONTH_IN, 2)
    mi = m.try_cast("int")
    in_range = mi.between(1, 12) & (y.try_cast("int") >= 1)
    # the casts only run on rows whose text already has the digit layout
    return F.when(
        v.rlike(_MONTH_IN),
        F.when(in_range, F.concat(F.lpad(mi.cast("string"), 2, "0"), F.lit("/"), y)),
    )


def parse_br_date(c) -> Column:
    """"dd/MM/yyyy" -> date; invalid -> NULL."""
    return F.try_to_date(as_col(c), "dd/MM/yyyy")


# Positions of the year and month digits inside the two text layouts we read.
_LAYOUTS = {
    "MM/yyyy": {"year": (4, 4), "month": (1, 2)},
    "dd/MM/yyyy": {"year": (7, 4), "month": (4, 2)},
}


def _part(c, fmt: str, part: str) -> Column:
    pos, length = _LAYOUTS[fmt][part]
    return F.substring(as_col(c), pos, length).try_cast("int")


def year_of(c, fmt: str = "MM/yyyy") -> Column:
    """Year digits of a "MM/yyyy" or "dd/MM/yyyy" text as int."""
    return _part(c, fmt, "year")


def month_of(c, fmt: str = "MM/yyyy") -> Column:
    """Month digits of a "MM/yyyy" or "dd/MM/yyyy" text as int."""
    return _part(c, fmt, "month")


def month_key(year, month) -> Column:
    """First day of the month; NULL when either part is NULL or out of range.

    (A ``concat_ws`` based key silently skips a NULL month and yields January.)
    """
    y, m = as_col(year), as_col(month)
    ok = m.between(1, 12) & y.between(1, 9999)
    return F.when(ok, F.make_date(y, m, F.lit(1)))


_UTC_TEXT = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})T([0-9]{2}:[0-9]{2}:[0-9]{2})Z$"


def parse_utc(c) -> Column:
    """ISO-8601 "yyyy-MM-ddTHH:mm:ssZ" -> timestamp_ntz holding the UTC wall time.

    Parsed without the session time zone (no DST gap can shift it); other
    layouts and impossible dates give NULL.
    """
    c = as_col(c)
    text = F.regexp_replace(c, _UTC_TEXT, "$1 $2")
    return F.when(c.rlike(_UTC_TEXT), text.try_cast("timestamp_ntz"))


def _p2(c):
    return F.lpad(c.cast("string"), 2, "0")


def ntz_text(c, layout: str) -> Column:
    """Render a timestamp_ntz without the session time zone shifting it.

    Date-only layouts format the *date* of the value: a DST jump at
    midnight can move the time of day of the intermediate timestamp, never
    its calendar date.  The time layout is built from the value's own fields
    (``date_format`` would render a non-existent local midnight as 01:00).
    Layouts: "M/yyyy", "MM/yyyy", "dd/MM/yyyy", "yyyy-MM-ddTHH:mm:ssZ".
    """
    t = as_col(c)
    if layout in ("M/yyyy", "MM/yyyy", "dd/MM/yyyy"):
        return F.date_format(t.cast("date"), layout)
    if layout == "yyyy-MM-ddTHH:mm:ssZ":
        y = F.lpad(F.year(t).cast("string"), 4, "0")
        return F.concat(
            F.concat_ws("-", y, _p2(F.month(t)), _p2(F.dayofmonth(t))), F.lit("T"),
            F.concat_ws(":", _p2(F.hour(t)), _p2(F.minute(t)), _p2(F.second(t))), F.lit("Z"),
        )
    raise ValueError(layout)


def utc_now() -> Column:
    """Current time as a timestamp_ntz holding the UTC wall time (any session zone)."""
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")


def format_utc(c) -> Column:
    """timestamp_ntz (UTC wall time) -> ISO-8601 "yyyy-MM-ddTHH:mm:ssZ", zone-free."""
    return ntz_text(c, "yyyy-MM-ddTHH:mm:ssZ")


def decoded_path(path) -> Column:
    """Percent-decoded file URI (``_metadata.file_path`` is encoded, binaryFile's ``path`` is not)."""
    return F.try_url_decode(F.replace(as_col(path), F.lit("+"), F.lit("%2B")))


def file_basename(path) -> Column:
    """Last path segment, percent-decoded ("file:/x/a%20b.csv" -> "a b.csv").

    A literal '+' in a path stays '+' (form decoding would turn it into a space).
    """
    last = F.regexp_extract(as_col(path), r"([^/]+)$", 1)
    return F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B")))

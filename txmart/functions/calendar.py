"""Date parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _shape(fmt: str) -> str | None:
    """A regex every string parseable by ``fmt`` matches, when ``fmt`` is made only of
    numeric fields and separators (e.g. ``yyyy-M-d`` -> ``^[0-9]+-[0-9]+-[0-9]+$``)."""
    if not fmt or "MMM" in fmt or any(ch.isalpha() and ch not in "yMdHhms" for ch in fmt) or "'" in fmt:
        return None
    out, prev = [], None
    for ch in fmt:
        if ch.isalpha():
            if prev != "field":
                out.append("[0-9]+")
            prev = "field"
        else:
            out.append("\\" + ch if ch in ".+*?()[]{}|^$\\" else ch)
            prev = ch
    return "^" + "".join(out) + "$"


def parse_ts(c, fmt: str | None = None) -> Column:
    """Lenient parse to ``timestamp_ntz`` (null on failure; session time zone is UTC).

    With a numeric format the parse only runs on values of the format's shape: a failed
    formatted parse is costly, and a value of another shape cannot parse anyway."""
    col = _col(c)
    if fmt is None:
        return F.try_to_timestamp(col).cast("timestamp_ntz")
    parsed = F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")
    shape = _shape(fmt)
    return parsed if shape is None else F.when(col.rlike(shape), parsed)


def parse_with_formats(c, formats) -> Column:
    """Row mode: the first of ``formats`` that parses this value."""
    return F.coalesce(*[parse_ts(c, f) for f in formats])


def calendar_columns(d, dow_style: str = "iso") -> dict[str, Column]:
    """Calendar attributes of a date column.

    ``dow_style="iso"``: Monday=1..Sunday=7, weekend (6, 7).
    ``dow_style="sunday0"``: Sunday=0..Saturday=6, weekend (0, 6) — the same days.
    """
    d = _col(d)
    if dow_style == "iso":
        dow = F.weekday(d) + 1
        weekend = dow.isin(6, 7)
    elif dow_style == "sunday0":
        dow = F.dayofweek(d) - 1
        weekend = dow.isin(0, 6)
    else:
        raise ValueError(f"unknown dow_style {dow_style!r}")
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": dow.cast("int"),
        "day_name": F.date_format(d, "EEEE"),
        "month_name": F.date_format(d, "MMMM"),
        "week_of_year": F.weekofyear(d),
        "is_weekend": weekend,
    }

"""Load-month keys, request keys and labels, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(date: Column | str, days_back: int = 30) -> Column:
    """yyyyMM of the day `days_back` days earlier."""
    return F.date_format(F.date_sub(F.to_date(date), days_back), "yyyyMM")


def calendar_month_key(date: Column | str) -> Column:
    """yyyyMM of the calendar month before."""
    return F.date_format(F.add_months(F.to_date(date), -1), "yyyyMM")


def request_key(template: str, *values: Column | str) -> Column:
    """Fill a printf-style request template, e.g. ("%s?$skip=%d", feed, skip)."""
    return F.format_string(template, *values)


def ordinal_label(prefix: str, position: Column) -> Column:
    """prefix1, prefix2, … for a zero-based position."""
    return F.concat(F.lit(prefix), (position + 1).cast("string"))


def base_name(path: Column | str) -> Column:
    """The last part of a path or link, without a link's query and fragment."""
    return F.element_at(F.split(F.regexp_replace(path, "[?#].*", ""), "/"), -1)

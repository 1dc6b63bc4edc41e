"""Date rules: tolerant parsing, rendering, calendar windows.

Text is brought to ISO form by one regular expression and then try-cast, which
neither throws per row nor walks a list of formatters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date renderings used by the stored tables and the outbox.
STORED_FORMAT = "dd-MM-yyyy"
ISO_FORMAT = "yyyy-MM-dd"
MESSAGE_FORMAT = "dd/MM/yyyy"

_NUMERIC = r"^\s*(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})([ T].*)?$"
_YEAR_FIRST = r"^\s*(\d{4})[/.](\d{1,2})[/.](\d{1,2})([ T].*)?$"
_STRICT = r"^(\d{1,2})-(\d{1,2})-(\d{4})$"
_NAMED = ["d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy", "MMM d, yyyy", "MMMM d, yyyy"]


def _iso(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), _YEAR_FIRST, "$1-$2-$3").try_cast("date")


def _numeric(c: Column, replacement: str) -> Column:
    return F.regexp_replace(c, _NUMERIC, replacement).try_cast("date")


def _mixed(c: Column, first: str, second: str) -> Column:
    named = [F.try_to_date(F.trim(c), f) for f in _NAMED]
    return F.when(
        F.trim(c) != "",
        F.coalesce(_iso(c), _numeric(c, first), _numeric(c, second), *named),
    )


def parse_day_first(c: Column) -> Column:
    """ISO text first, then day-month-year, then month-day-year when the day cannot fit."""
    return _mixed(c, "$3-$2-$1", "$3-$1-$2")


def parse_month_first(c: Column) -> Column:
    return _mixed(c, "$3-$1-$2", "$3-$2-$1")


def parse_stored(c: Column) -> Column:
    """Exactly day-month-year with dashes; anything else is null."""
    return F.when(c.rlike(_STRICT), F.regexp_replace(c, _STRICT, "$3-$2-$1").try_cast("date"))


def parse_iso(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("date")


def render(c: Column, fmt: str = STORED_FORMAT) -> Column:
    return F.date_format(c, fmt)


def monday_week(c: Column) -> Column:
    """Week of the year, Monday first; days before the first Monday are week 0."""
    return F.floor((F.dayofyear(c) + F.lit(6) - F.weekday(c)) / F.lit(7)).cast("int")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def month_window(year: int, month: int, as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First to last day of a month, or to the day before ``as_of`` in its own month."""
    first = dt.date(year, month, 1)
    if (as_of.year, as_of.month) == (year, month):
        return first, as_of - dt.timedelta(days=1)
    following = dt.date(year + month // 12, month % 12 + 1, 1)
    return first, following - dt.timedelta(days=1)


def in_window(c: Column, start: dt.date, end: dt.date) -> Column:
    """Half-open on the raw column, so that the test reaches the file scan."""
    return (c >= F.lit(start)) & (c < F.lit(end + dt.timedelta(days=1)))


def last_30_days(c: Column, as_of: dt.date) -> Column:
    return in_window(c, as_of - dt.timedelta(days=30), as_of - dt.timedelta(days=1))


def batch_window(c: Column, as_of: dt.date) -> Column:
    """Two months and 28 days back, up to and including ``as_of``."""
    start = F.date_sub(F.add_months(F.lit(as_of), -2), 28)
    return (c >= start) & (c < F.lit(as_of + dt.timedelta(days=1)))

"""Text rules: blanks, stray characters, keys, phone numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """Cells holding only white space carry no value."""
    return F.nullif(F.trim(c), F.lit(""))


def is_blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def strip_backticks(c: Column) -> Column:
    return F.translate(c, "`", "")


def strip_commas(c: Column) -> Column:
    return F.translate(c, ",", "")


def contains_any_case(c: Column, text: str) -> Column:
    """Substring test ignoring case; null never contains anything."""
    return F.coalesce(F.lower(c).contains(text.lower()), F.lit(False))


def one_of(c: Column, values: list[str]) -> Column:
    """Membership test that is false (not null) for a null value."""
    return F.coalesce(c.isin(*values), F.lit(False))


def first_part(c: Column, sep: str = "_") -> Column:
    return F.split_part(c, F.lit(sep), F.lit(1))


def pair_key(left: Column, right: Column) -> Column:
    """``left_right``; null as soon as one half is null."""
    return F.concat(left, F.lit("_"), right)


def international_phone(c: Column, prefix: str = "+91") -> Column:
    return F.concat(F.lit(prefix), F.right(F.trim(c), F.lit(10)))


def numeric_key(c: Column) -> Column:
    """Whole-number keys without leading zeros or spaces; anything else is null."""
    return F.trim(c.cast("string")).try_cast("decimal(38,0)").cast("string")

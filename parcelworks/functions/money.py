"""Numeric rules: tolerant parsing, cent rounding, order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelworks.functions.text import strip_commas


def cents(c: Column) -> Column:
    """Round to two places, half to even on the scaled binary value.

    ``round(x, 2)`` works on the decimal text of a double and differs on ties.
    """
    return F.rint(c * F.lit(100.0)) / F.lit(100.0)


def to_number(c: Column) -> Column:
    """Text to double; thousands commas are dropped, anything else bad is null."""
    value = strip_commas(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(value), value)


def number_or_zero(c: Column) -> Column:
    return F.coalesce(to_number(c), F.lit(0.0))


def exact_sum(c: Column) -> Column:
    """Sum of money that does not depend on row order or partitioning."""
    return F.sum(c.cast("decimal(28,6)")).cast("double")


def share_or_zero(part: Column, whole: Column, amount: Column) -> Column:
    """``part / whole * amount`` in cents; zero when the whole is zero."""
    return F.when(whole != 0, cents(part / whole * amount)).otherwise(F.lit(0.0))

"""Guarded ratios in the three forms the reports use."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import ColumnOrName, col


def ratio_double(part: ColumnOrName, whole: ColumnOrName, digits: int = 4) -> Column:
    """Double rounded to ``digits``; null unless the whole is positive."""
    return F.round(ratio_exact(part, whole), digits)


def ratio_exact(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """Unrounded double; null unless the whole is positive."""
    return F.when(col(whole) > 0, col(part).cast("double") / col(whole).cast("double"))


def ratio_decimal(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """decimal(6,4), half up; null when the whole is zero or a side is null."""
    whole_or_null = F.nullif(col(whole), F.lit(0).cast("bigint"))
    exact = col(part).cast("decimal(18,4)") / whole_or_null.cast("decimal(18,4)")
    return exact.try_cast("decimal(6,4)")


def complement_decimal(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """1 - part/whole as decimal(6,4), from the unrounded ratio."""
    return ratio_decimal(col(whole) - col(part), whole)


def percent(part: ColumnOrName, whole: ColumnOrName, digits: int = 2) -> Column:
    return F.round(ratio_exact(part, whole) * 100, digits)


def steady_round(c: ColumnOrName, digits: int) -> Column:
    """Round a mean of doubles. The sum behind it depends on the order of the rows in
    the last bits; rounding to ten digits first keeps that from deciding a tie."""
    return F.round(F.round(col(c), 10), digits)

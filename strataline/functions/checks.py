"""Boolean checks used by quality rules. Each returns true or false, never null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .text import ColumnOrName, col, is_blank


def _known(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def missing_or_outside(c: ColumnOrName, low: float, high: float) -> Column:
    """Null, or outside the closed range."""
    return col(c).isNull() | ~_known(col(c).between(low, high))


def bad_day_counts(possible: ColumnOrName, attended: ColumnOrName) -> Column:
    """A count is missing or negative, or more days were attended than possible."""
    p, a = col(possible), col(attended)
    return p.isNull() | a.isNull() | _known(F.least(p, a) < 0) | _known(a > p)


def outside_vocabulary(c: ColumnOrName, allowed: Sequence[str]) -> Column:
    """Null, blank, or not one of the allowed values."""
    return is_blank(c) | ~_known(col(c).isin(*allowed))


def after_day(c: ColumnOrName, as_of: ColumnOrName | None = None,
              null_fails: bool = False) -> Column:
    """Later than ``as_of`` (today unless given); optionally also when null."""
    limit = F.current_date() if as_of is None else col(as_of)
    late = _known(col(c) > limit)
    return (late | col(c).isNull()) if null_fails else late


def status_in(c: ColumnOrName, statuses: Sequence[str]) -> Column:
    """Case-insensitive membership; null counts as no status."""
    return F.upper(F.coalesce(col(c), F.lit(""))).isin(*[s.upper() for s in statuses])


def reason_without_absence(possible: ColumnOrName, attended: ColumnOrName,
                           reason: ColumnOrName) -> Column:
    return _known(col(possible) == col(attended)) & ~is_blank(reason)


def absence_without_reason(possible: ColumnOrName, attended: ColumnOrName,
                           reason: ColumnOrName) -> Column:
    return _known(col(attended) < col(possible)) & is_blank(reason)


def flag(condition: Column) -> Column:
    """0/1 form of a condition; unknown is 0."""
    return _known(condition).cast("int")

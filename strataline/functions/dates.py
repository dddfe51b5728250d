"""Calendar parts, integer date keys and the school calendar."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import ColumnOrName, col

# Months of the school terms and southern-hemisphere seasons.
TERM_MONTHS = {"Summer break": (1,), "Term 1": (2, 3, 4), "Term 2": (5, 6, 7),
               "Term 3": (8, 9), "Term 4": (10, 11, 12)}
SEASON_MONTHS = {"Summer": (12, 1, 2), "Autumn": (3, 4, 5), "Winter": (6, 7, 8),
                 "Spring": (9, 10, 11)}


def date_key(c: ColumnOrName) -> Column:
    """yyyymmdd as int."""
    return F.date_format(col(c), "yyyyMMdd").cast("int")


def month_key(month_id: ColumnOrName) -> Column:
    """yyyymm as int from a 'YYYY-MM' id."""
    return F.replace(col(month_id), F.lit("-"), F.lit("")).try_cast("int")


def month_id(c: ColumnOrName) -> Column:
    """'YYYY-MM' of a date."""
    return F.date_format(col(c), "yyyy-MM")


def month_start(month: ColumnOrName) -> Column:
    """First day of a 'YYYY-MM' id."""
    return F.concat(col(month), F.lit("-01")).try_cast("date")


def year_start(year: ColumnOrName) -> Column:
    """First of January of a year number."""
    return F.make_date(col(year), F.lit(1), F.lit(1))


def year_key(year: ColumnOrName) -> Column:
    """yyyy0101 as int."""
    return (col(year) * 10000 + 101).cast("int")


def prior_month_key(day: ColumnOrName) -> Column:
    return F.date_format(F.add_months(col(day), -1), "yyyyMM").cast("int")


def day_before(day: ColumnOrName) -> Column:
    return F.date_sub(col(day), 1)


def year_of_month_id(month: ColumnOrName) -> Column:
    """'YYYY' of a 'YYYY-MM' id, as int."""
    return F.substring(col(month), 1, 4).try_cast("int")


def _by_month(day: Column, table: dict[str, tuple[int, ...]]) -> Column:
    return F.coalesce(*[F.when(F.month(day).isin(*months), F.lit(name))
                        for name, months in table.items()])


def school_term(day: ColumnOrName) -> Column:
    return _by_month(col(day), TERM_MONTHS)


def season(day: ColumnOrName) -> Column:
    return _by_month(col(day), SEASON_MONTHS)


def is_winter(day: ColumnOrName) -> Column:
    return F.month(col(day)).isin(*SEASON_MONTHS["Winter"])


def month_name(day: ColumnOrName) -> Column:
    """Full English name; see ``month_short_name`` for the three-letter form."""
    return F.date_format(col(day), "MMMM")


def month_short_name(day: ColumnOrName) -> Column:
    return F.date_format(col(day), "MMM")

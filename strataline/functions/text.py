"""Trimming, blank handling and safe casts of text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: ColumnOrName) -> Column:
    """Text without leading and trailing blanks."""
    return F.trim(col(c))


def blank_to_null(c: ColumnOrName) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def or_default(c: ColumnOrName, default: str) -> Column:
    """Trimmed text with a default for missing or blank values."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def is_blank(c: ColumnOrName) -> Column:
    """True for null, empty and all-blank text; never null."""
    return F.coalesce(F.trim(col(c)) == "", F.lit(True))


def to_int(c: ColumnOrName) -> Column:
    """Whole number, null for text that is not one (also for blanks)."""
    return clean(c).try_cast("int")


def to_decimal(c: ColumnOrName, precision: int, scale: int) -> Column:
    """Fixed-point number, null for bad text."""
    return clean(c).try_cast(f"decimal({precision},{scale})")


def to_day(c: ColumnOrName, pattern: str = "yyyy-MM-dd") -> Column:
    """Date in a known format, null for text in any other form."""
    return F.try_to_date(clean(c), pattern)


def to_day_any(c: ColumnOrName) -> Column:
    """Date by a safe cast (ISO forms), null for bad text."""
    return clean(c).try_cast("date")


def json_payload(columns: list[str]) -> Column:
    """The row's columns as one JSON text; null fields are left out."""
    return F.to_json(F.struct(*columns))

"""Dimension building blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates
from ..functions.keys import hash_key
from .numbering import dense_order_numbers
from .quality import union_all


def hashed_dimension(df: DataFrame, column: str, key_name: str,
                     attributes: dict[str, Column] | None = None) -> DataFrame:
    """Distinct non-null values of a column with a hash key and derived attributes."""
    values = df.select(column).dropna().distinct()
    return values.select(hash_key(column).alias(key_name), column,
                         *[c.alias(n) for n, c in (attributes or {}).items()])


def numbered_dimension(df: DataFrame, column: str, allowed: Sequence[str], key_name: str,
                       name: str | None = None) -> DataFrame:
    """Allowed values that occur, numbered in alphabetical order from 1.

    The number is the rank among the values present, computed on one row of
    flags per value of the vocabulary, so only that small set is ever ordered.
    """
    name = name or column
    present = df.filter(F.col(column).isin(*allowed)).select(F.col(column).alias(name)).distinct()
    everyone = present.agg(F.sort_array(F.collect_set(name)).alias("_all"))  # <= vocabulary
    return everyone.select(F.posexplode("_all").alias("_pos", name)).select(
        (F.col("_pos") + 1).cast("bigint").alias(key_name), name)


def group_dimension(df: DataFrame, attributes: Sequence[str], key_name: str,
                    count_name: str) -> DataFrame:
    """Distinct attribute combinations with a member count and an ordered number."""
    groups = df.groupBy(*attributes).agg(F.count(F.lit(1)).alias(count_name))
    return dense_order_numbers(groups, attributes, key_name)


def sparse_dates(sources: Sequence[tuple[DataFrame, Column]], as_of: Column) -> DataFrame:
    """Distinct dates that occur in the sources, none after ``as_of``. Each source
    is made distinct on its own before the union."""
    days = union_all([df.select(day.alias("calendar_date")).distinct() for df, day in sources])
    return (
        days.filter(F.col("calendar_date") <= as_of).distinct()
        .select(dates.date_key("calendar_date").alias("date_key"), "calendar_date",
                F.year("calendar_date").alias("calendar_year"),
                F.month("calendar_date").alias("calendar_month"),
                dates.month_name("calendar_date").alias("month_name"),
                F.quarter("calendar_date").alias("calendar_quarter"))
    )


def date_bounds(sources: Sequence[tuple[DataFrame, Column]]) -> DataFrame:
    days = union_all([
        df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date")) for df, day in sources
    ])
    return days.agg(F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))


def dense_dates(bounds: DataFrame) -> DataFrame:
    """One row per day from the earliest to the latest date."""
    day = F.col("full_date")
    start = F.trunc(day, "month")
    return bounds.filter(F.col("min_date").isNotNull()).select(
        F.explode(F.sequence("min_date", "max_date")).alias("full_date")
    ).select(
        dates.date_key(day).alias("date_key"), "full_date",
        F.year(day).alias("calendar_year"), F.quarter(day).alias("quarter_number"),
        F.month(day).alias("month_number"), dates.month_short_name(day).alias("month_name"),
        start.alias("month_start_date"), F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week_number"),
        F.date_format(day, "E").alias("day_of_week_name"), (day == start).alias("is_month_start"))


def month_dimension(months: DataFrame, month: str = "reporting_month") -> DataFrame:
    """School calendar attributes of 'YYYY-MM' ids."""
    day = F.col("month_start_date")
    return (
        months.select(F.col(month).alias("reporting_month")).dropna().distinct()
        .withColumn("month_start_date", dates.month_start("reporting_month"))
        .select(dates.month_key("reporting_month").alias("month_key"), "reporting_month",
                "month_start_date", F.year(day).alias("calendar_year"),
                F.month(day).alias("calendar_month_number"),
                dates.month_name(day).alias("calendar_month_name"),
                F.year(day).alias("school_year"), dates.school_term(day).alias("school_term"),
                dates.season(day).alias("season"),
                dates.prior_month_key(day).alias("prior_month_key"),
                dates.is_winter(day).alias("is_winter_month"))
    )

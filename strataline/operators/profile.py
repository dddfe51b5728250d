"""Counts, null profiles, bounds and range checks; one aggregate each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from .quality import union_all


def counts_by(frames: Mapping[str, DataFrame], by: Sequence[str], name: str = "row_count") -> DataFrame:
    """(table_name, by..., count) over several tables; missing columns become null."""
    return union_all([
        df.groupBy(*[c for c in by if c in df.columns]).agg(F.count(F.lit(1)).alias(name))
        .withColumn("table_name", F.lit(table))
        for table, df in frames.items()
    ]).select("table_name", *by, name)


def null_profile(df: DataFrame, columns: Sequence[str], distinct: str | None = None,
                 by: Sequence[str] = (), prefix: str = "missing_") -> DataFrame:
    """Rows, nulls per column and optionally distinct ids, overall or per group."""
    wanted = [F.count(F.lit(1)).alias("total_records")]
    wanted += [F.count_if(F.col(c).isNull()).alias(prefix + c) for c in columns]
    if distinct is not None:
        wanted.append(F.countDistinct(distinct).alias(f"distinct_{distinct}s"))
    return df.groupBy(*by).agg(*wanted)


def null_profile_long(frames: Mapping[str, tuple[DataFrame, Sequence[str]]],
                      by: Sequence[str]) -> DataFrame:
    """The profiles of several tables as (table_name, by..., total, metric, count)."""
    return union_all([
        null_profile(df, columns, by=by, prefix="invalid_or_missing_")
        .unpivot([*by, "total_records"], [f"invalid_or_missing_{c}" for c in columns],
                 "metric", "failed_count")
        .withColumn("table_name", F.lit(table))
        for table, (df, columns) in frames.items()
    ]).select("table_name", *by, "total_records", "metric", "failed_count")


def bounds(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, minimum and maximum of a column."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"),
                               F.min(column).alias(f"min_{column}"),
                               F.max(column).alias(f"max_{column}"))


def range_check(df: DataFrame, column: str, low: float, high: float,
                by: Sequence[str] = ()) -> DataFrame:
    """Minimum, maximum and rows outside a closed range, with PASS or FAIL."""
    value = F.col(column)
    return df.groupBy(*by).agg(
        F.min(value).alias("min_value"), F.max(value).alias("max_value"),
        F.count_if(~value.between(low, high)).alias("out_of_range_count"),
    ).withColumn("check_status", F.when(F.col("out_of_range_count") == 0, "PASS").otherwise("FAIL"))


def grain_profile(df: DataFrame, key: str, foreign_keys: Sequence[str],
                  by: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct keys and missing foreign keys of a fact or dimension."""
    return null_profile(df, foreign_keys, distinct=key, by=by)

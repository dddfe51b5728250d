"""Integer surrogates: kept once assigned, or dense in a given order.

Both number the whole table without sending it to one task: rows are numbered
inside many buckets, and a table with one row per bucket carries the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise

HASH_DIGITS = 3  # 16**3 buckets; the offset table has at most that many rows


def _number_in_buckets(rows: DataFrame, bucket: str, order: Sequence[str], name: str) -> DataFrame:
    """Row number within the bucket plus the rows of the buckets before it.

    The offsets come from the numbered rows, so both sides share one shuffle.
    There is at most one row per bucket: the running total and the broadcast are
    bounded by the number of buckets.
    """
    window = Window.partitionBy(bucket).orderBy(*order)
    numbered = rows.withColumn("_rn", F.row_number().over(window))
    sizes = numbered.groupBy(bucket).agg(F.max("_rn").cast("bigint").alias("_n"))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        numbered.join(F.broadcast(offsets), bucket)
        .withColumn(name, F.col("_before") + F.col("_rn")).drop(bucket, "_before", "_rn")
    )


def extend_surrogates(key_map: DataFrame, keys: DataFrame, key: str, name: str, above: int | None = None) -> DataFrame:
    """Keep every number of ``key_map`` and number the keys it lacks above its maximum, or above a number that is known
    to be the highest given, where the map holds a part of the keys only.

    New keys are ordered by (hash prefix, key): deterministic, spread evenly
    whatever the keys look like, and independent of the partitioning.
    """
    fresh = (
        keys.select(key).dropna().distinct()
        .join(key_map.select(key), key, "left_anti")
        .withColumn("_bucket", F.substring(F.sha2(F.col(key).cast("string"), 256), 1, HASH_DIGITS))
    )
    offset = _number_in_buckets(fresh, "_bucket", [key], "_offset")
    if above is None:
        highest = key_map.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint").alias("_highest"))
        offset = offset.crossJoin(highest)  # one row
    else:
        offset = offset.withColumn("_highest", F.lit(above).cast("bigint"))
    numbered = offset.select(key, (F.col("_highest") + F.col("_offset")).alias(name))
    return key_map.select(key, F.col(name).cast("bigint").alias(name)).unionByName(numbered)


def dense_order_numbers(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY ...) of a whole table.

    Rows are range-partitioned by the order columns, so partition i precedes
    partition i + 1. The partition ids are then fixed by a reliable
    checkpoint: both the counts and the numbers below must see the same ones,
    also when an executor is lost in between.
    """
    ranged = materialise(
        df.repartitionByRange(*[F.col(c) for c in order])
        .withColumn("_range", F.spark_partition_id()))
    return _number_in_buckets(ranged, "_range", order, name).select(name, *df.columns)


def key_map_with_dates(key_map: DataFrame, sightings: DataFrame, key: str, day: str) -> DataFrame:
    """Restricted map from natural key to surrogate with the first and last day seen."""
    seen = sightings.groupBy(key).agg(F.min(day).alias("effective_from_date"),
                                      F.max(day).alias("last_seen_date"))
    return key_map.join(seen, key, "left")


def replace_with_surrogate(df: DataFrame, key_map: DataFrame, key: str, name: str) -> DataFrame:
    """Swap the natural key for its surrogate; the key itself is dropped."""
    kept = [c for c in df.columns if c != key]
    return df.join(key_map.select(key, name), key, "left").select(name, *kept)

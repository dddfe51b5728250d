"""Choosing rows per key: latest, first, duplicates, surplus copies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


Order = Column | str


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """The first row of each key under ``order`` (pass descending columns for "latest").

    ``order`` must be total within a key. The ``rn = 1`` filter lets Spark cut
    every map task's rows to one per key before the shuffle
    (WindowGroupLimit), so a hot key does not travel whole to one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_unless_rejected(df: DataFrame, keys: Sequence[str], order: Sequence[Order], rejected: str) -> DataFrame:
    """``latest_per_key`` of the keys of which no row is ``rejected``, a boolean that is never null.

    The rejected rows of a key come first in it, and a key whose first row is one falls out: exclusion and choice are one
    shuffle, cut to a row per key and map task like ``latest_per_key``.
    """
    return latest_per_key(df, keys, [F.desc(rejected), *order]).filter(~F.col(rejected)).drop(rejected)


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, without nulls, that more than one row holds; with the row count."""
    return (
        df.dropna(subset=list(keys)).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .filter("duplicate_count > 1")
    )


def duplicate_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of every duplicated key (rows with a null in the key never count).

    Counting is partial per map task and the join side holds one row per
    duplicated key, so no group is gathered in one task. Whether that side is
    broadcast is AQE's choice, on its measured size.
    """
    return df.join(duplicated_keys(df, keys).select(*keys), list(keys), "left_semi")


def surplus_rows(df: DataFrame, keys: Sequence[str], row_order: str) -> DataFrame:
    """All rows of a key but the one with the lowest ``row_order``.

    ``row_order`` is a load sequence without ties in a key. Only duplicated keys take part in the
    join, one row each: broadcast when few, and otherwise a hot key is split by AQE.
    """
    firsts = (
        df.dropna(subset=list(keys)).groupBy(*keys)
        .agg(F.min(row_order).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1").drop("_copies")
    )
    return (
        df.join(firsts, list(keys)).filter(F.col(row_order) > F.col("_first"))
        .select(*df.columns)
    )


SPREAD = "_spread"


def null_spread(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for rows whose key can match, a hash of the whole row for those with a null in it: they match nothing, and as a
    further key this deals them out evenly instead of to one task."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return F.when(missing, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long"))


def whole_spread(keys: Sequence[str]) -> Column:
    """``SPREAD`` of the rows that can be matched, 0, as a value of the row: the optimiser takes a literal out of the
    join's keys, which then are not those the other side is partitioned and sorted by."""
    return F.xxhash64(*keys).bitwiseAND(F.lit(0).cast("long"))


def mark_duplicates(df: DataFrame, keys: Sequence[str], flag: str,
                    row_order: str | None = None) -> DataFrame:
    """Add a boolean: the row belongs to a duplicated key, or, with
    ``row_order``, is a surplus copy (not the lowest) of one.

    Rows meet their neighbours in one shuffle, and in none where ``df`` comes partitioned by some of the keys and
    ``SPREAD``, which it then has as a column. A key's rows stream past: only the one before and after count, or the
    rank, so no group is held. They leave sorted by ``SPREAD`` and the keys, so that a join on the first of these sorts
    nothing again.
    """
    dealt = df if SPREAD in df.columns else df.withColumn(SPREAD, null_spread(df, keys))
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    window = Window.partitionBy(SPREAD, *keys)
    if row_order is None:
        beside = window.orderBy(keys[0])
        hit = F.lag(keys[0]).over(beside).isNotNull() | F.lead(keys[0]).over(beside).isNotNull()
    else:
        hit = (F.rank().over(window.orderBy(F.asc_nulls_last(row_order))) > 1) & F.col(row_order).isNotNull()
    return dealt.withColumn(flag, complete & hit).select(*df.columns, flag)


def latest_overall(df: DataFrame, *order: Order) -> DataFrame:
    """The single first row under ``order``: a top-1 with no global sort."""
    return df.orderBy(*order).limit(1)


def top_rows(df: DataFrame, n: int, *order: Order) -> DataFrame:
    """Top-n preview (each task keeps n rows, then one merge of those)."""
    return df.orderBy(*order).limit(n)

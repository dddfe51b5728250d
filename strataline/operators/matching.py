"""Joins: orphans, exclusions, semi joins, as-of and latest lookups, prior period."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_blank
from .rows import SPREAD, null_spread, whole_spread


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct non-null keys: the build side of membership joins."""
    return df.select(*keys).dropna().distinct()


def by_shuffle(side: DataFrame) -> DataFrame:
    """The side of a join that grows with the data, such as the students: it is never broadcast, however small its file. A
    stored layer is judged by its compressed size, and a few MB of file can hold millions of rows (the snapshots of all
    months repeat each student), which the driver would have to gather and build a table of."""
    return side.hint("shuffle_merge")


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str],
            blank_is_orphan: bool = True) -> DataFrame:
    """Child rows without a parent.

    Null keys match nothing, so they are orphans; with ``blank_is_orphan``
    false, rows whose last key is null or blank are left out first.
    """
    if not blank_is_orphan:
        child = child.filter(~is_blank(keys[-1]))
    return child.join(distinct_keys(parent, keys), list(keys), "left_anti")


def exclude(df: DataFrame, rejected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the rejected ones (null keys stay)."""
    return df.join(distinct_keys(rejected, keys), list(keys), "left_anti")


def exclude_in_place(df: DataFrame, rejected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows as ``exclude``, by an outer join: the optimiser pushes an anti join below the joins ``df`` is made of,
    where it costs a shuffle of its own; here it shares the one of the choice per key that follows."""
    found = distinct_keys(rejected, keys).withColumn("_rejected", F.lit(True))
    return df.join(found, list(keys), "left").filter(F.col("_rejected").isNull()).select(*df.columns)


def unknown_to_all(child: DataFrame, parents: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Non-null child keys that none of several parent sets holds: one anti join
    against the union of the key sets."""
    known = reduce(DataFrame.unionByName, [p.select(*keys) for p in parents])
    return child.dropna(subset=list(keys)).join(distinct_keys(known, keys), list(keys), "left_anti")


def deal_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` partitioned by ``SPREAD``, which it gets as a column, and the keys: marks and joins on them follow without
    a shuffle of their own."""
    return df.withColumn(SPREAD, null_spread(df, keys)).repartition(SPREAD, *keys)


def mark_present(child: DataFrame, parent: DataFrame, keys: Sequence[str], flag: str,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Add a boolean: a parent with the row's key exists. ``keep=[SPREAD]`` leaves the helper column, so that what
    follows can use the partitioning of this join. A child that has it already (``deal_by``) is neither dealt nor sorted
    again."""
    if SPREAD in child.columns:
        dealt, zero = child, whole_spread(keys)
    else:
        dealt, zero = child.withColumn(SPREAD, null_spread(child, keys)), F.lit(0).cast("long")
    present = distinct_keys(parent, keys).withColumns({flag: F.lit(True), SPREAD: zero})
    columns = [c for c in child.columns if c != SPREAD]
    return (
        dealt.join(present, [SPREAD, *keys], "left")
        .select(*columns, *keep, F.coalesce(F.col(flag), F.lit(False)).alias(flag))
    )


def mark_known(child: DataFrame, history: DataFrame, batch: DataFrame, key: str,
               slice_columns: Sequence[str], in_history: str, in_batch: str, keep: Sequence[str] = ()) -> DataFrame:
    """Add two booleans in one join on the key: some earlier state holds it; the
    row's own slice holds it. ``history`` has the key, ``batch`` key and slice.

    A known key carries the set of slices it occurs in, at most one per slice. ``keep`` as in ``mark_present``.
    """
    ever = history.select(key).withColumns({"_h": F.lit(True), "_slice": F.lit(None)})
    own = F.struct(*slice_columns)
    now = batch.select(key, own.alias("_slice")).withColumn("_h", F.lit(False))
    known = (
        ever.select(key, "_h", F.col("_slice").cast(now.schema["_slice"].dataType).alias("_slice"))
        .unionByName(now).dropna(subset=[key])
        .groupBy(key).agg(F.max("_h").alias("_h"), F.collect_set("_slice").alias("_slices"))
    )
    known = known.withColumn(SPREAD, F.lit(0).cast("long"))
    return (
        child.withColumn(SPREAD, null_spread(child, [key])).join(known, [key, SPREAD], "left")
        .select(*child.columns, *keep, F.coalesce(F.col("_h"), F.lit(False)).alias(in_history),
                F.coalesce(F.array_contains("_slices", own), F.lit(False)).alias(in_batch))
    )


def keep_if_or_present(df: DataFrame, condition: Column, activity: DataFrame,
                       keys: Sequence[str]) -> DataFrame:
    """Rows that meet a condition or have activity (EXISTS under an OR)."""
    return (
        mark_present(df, activity, keys, "_active").filter(condition | F.col("_active"))
        .drop("_active")
    )


def not_allowed_parent(child: DataFrame, parent: DataFrame, allowed: Column,
                       keys: Sequence[str]) -> DataFrame:
    """Child rows whose parent is missing or not in an allowed state."""
    return orphans(child, parent.filter(allowed), keys)


def as_of_join(facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str,
               valid_from: str = "effective_from_date", valid_to: str = "effective_to_date",
               take: Sequence[str] = ()) -> DataFrame:
    """Left join each row to the version valid on its date.

    The key equality drives a hash or merge join; the closed interval (null =
    open end) is its residual condition. Versions of one key must not overlap.
    """
    side = versions.select(
        *[F.col(k).alias(f"_v_{k}") for k in keys],
        F.col(valid_from).alias("_v_from"), F.col(valid_to).alias("_v_to"),
        *[F.col(c) for c in take],
    )
    on = [F.col(k) == F.col(f"_v_{k}") for k in keys]
    on += [F.col(at) >= F.col("_v_from"),
           F.col("_v_to").isNull() | (F.col(at) <= F.col("_v_to"))]
    return facts.join(side, on, "left").select(*facts.columns, *take)


def latest_lookup(df: DataFrame, history: DataFrame, keys: Sequence[str], value: str,
                  order: Sequence[str], name: str) -> DataFrame:
    """Left join the value of each key's latest history row (by ``order``, which
    needs a unique last column). One map-side-combined aggregate instead of a
    correlated top-1."""
    latest = history.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(name))
    return df.join(latest, list(keys), "left")


def prior_period(df: DataFrame, period: str, prior: Column, keys: Sequence[str],
                 values: dict[str, str]) -> DataFrame:
    """Self join to the row of an earlier period. A gap gives nulls, where a
    ``lag`` would silently reach further back."""
    on_keys = [F.col(k).eqNullSafe(F.col(f"_p_{k}")) for k in keys]
    earlier = df.select(
        F.col(period).alias("_p_period"), *[F.col(k).alias(f"_p_{k}") for k in keys],
        *[F.col(v).alias(new) for v, new in values.items()],
    )
    return (
        df.withColumn("_prior", prior)
        .join(earlier, [F.col("_prior") == F.col("_p_period"), *on_keys], "left")
        .select(*df.columns, *values.values())
    )


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of an at most one-row frame to every row (nulls if empty)."""
    return df.join(one_row, F.lit(True), "left")

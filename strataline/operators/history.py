"""Slowly changing dimensions, delta replay and monthly snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.keys import hash_key
from .matching import exclude, keep_if_or_present
from .rows import duplicated_keys, latest_per_key

VERSION_COLUMNS = ("version_key", "entity_key", "attribute_hash", "effective_from_batch_id",
                   "effective_from_date", "effective_to_date", "is_current")


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise when a key appears twice: an action that stops at the first one found."""
    if duplicated_keys(df, keys).take(1):
        raise ValueError(f"Duplicate {', '.join(keys)} values found in {what}.")


def first_versions(rows: DataFrame, key: str, attributes: Sequence[str], batch_id: str) -> DataFrame:
    """Incoming rows as open versions that start at their batch."""
    return rows.withColumns({
        "entity_key": hash_key(key),
        "attribute_hash": hash_key(*attributes),
        "effective_from_batch_id": F.lit(batch_id),
        "effective_from_date": F.lit(batch_id).try_cast("date"),
        "effective_to_date": F.lit(None).cast("date"),
        "is_current": F.lit(True),
        "version_key": hash_key(key, F.lit(batch_id)),
    })


def scd2_merge(versions: DataFrame, incoming: DataFrame) -> DataFrame:
    """New history from the old one and a batch of ``first_versions``.

    Changed keys: the open version ends the day before the batch and the new one
    follows. Equal hashes change nothing, so a rerun is a no-op. A corrected
    rerun of the same batch replaces the version of that batch, because closing
    it would give an interval that ends before it starts.

    Both sides are unique on the key, so every history row meets at most one
    incoming row.
    """
    offer = incoming.select(
        F.col("entity_key").alias("_key"), F.col("attribute_hash").alias("_hash"),
        F.col("effective_from_date").alias("_from"),
    )
    met = versions.join(offer, F.col("entity_key") == F.col("_key"), "left")
    hit = (F.col("is_current") & F.col("_key").isNotNull()
           & (F.col("attribute_hash") != F.col("_hash")))
    same_batch = hit & (F.col("effective_from_date") == F.col("_from"))
    history = (
        met.filter(~same_batch)
        .withColumns({
            "effective_to_date": F.when(hit, F.date_sub(F.col("_from"), 1))
                                  .otherwise(F.col("effective_to_date")),
            "is_current": F.col("is_current") & ~hit,
        })
        .select(*versions.columns)
    )
    unchanged = (
        versions.filter("is_current")
        .select(F.col("entity_key"), F.col("attribute_hash"))
    )
    opened = incoming.join(unchanged, ["entity_key", "attribute_hash"], "left_anti")
    return history.unionByName(opened.select(*versions.columns))


def scd2_from_history(rows: DataFrame, key: str, attributes: Sequence[str], day: str) -> DataFrame:
    """All versions of many dated states at once: consecutive equal states merge,
    each version ends the day before the next one starts."""
    order = Window.partitionBy(key).orderBy(day)
    starts = (
        rows.withColumn("attribute_hash", hash_key(*attributes))
        .withColumn("_before", F.lag("attribute_hash").over(order))
        .filter(~F.col("_before").eqNullSafe(F.col("attribute_hash")))
        .drop("_before")
    )
    following = F.lead(day).over(order)
    return starts.withColumns({
        "effective_from_date": F.col(day),
        "effective_to_date": F.date_sub(following, 1),
        "is_current": following.isNull(),
    }).drop(day)


def overlapping_versions(versions: DataFrame, key: str = "entity_key") -> DataFrame:
    """Versions that start before the preceding one of the key has ended (none, if right)."""
    order = Window.partitionBy(key).orderBy("effective_from_date")
    previous_end = F.lag(F.coalesce("effective_to_date", F.lit("9999-12-31").cast("date"))).over(order)
    return (
        versions.withColumn("_previous_end", previous_end)
        .filter(F.col("_previous_end") >= F.col("effective_from_date")).drop("_previous_end")
    )


def replay_state(changes: DataFrame, keys: Sequence[str], month: str, row_order: Sequence[Column | str],
                 upto: str | None = None) -> DataFrame:
    """State after the changes up to a month: the last change of each key wins, by
    month and then by position in the delta."""
    if upto is not None:
        changes = changes.filter(F.col(month) <= upto)
    return latest_per_key(changes, keys, [F.desc(month), *row_order])


def replay_all_months(changes: DataFrame, months: DataFrame, keys: Sequence[str], month: str,
                      row_order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """State of every key at every month from its first change on.

    Each key's changes become validity intervals, and a month joins the
    interval it falls in by exploding only that interval's months: the output is
    keys x months, never more. ``months`` is the small calendar of month ids.
    """
    last_of_month = latest_per_key(changes, [*keys, month], [F.desc(c) for c in row_order])
    order = Window.partitionBy(*keys).orderBy(month)
    spans = last_of_month.withColumn("_next", F.lead(month).over(order))
    calendar = months.agg(F.sort_array(F.collect_set(month)).alias("_months"))
    inside = F.filter("_months", lambda m: (m >= F.col(month))
                      & (F.col("_next").isNull() | (m < F.col("_next"))))
    return (
        spans.crossJoin(calendar)  # one row
        .select(*keys, *columns, F.explode(inside).alias("state_month"))
    )


def monthly_snapshot(state: DataFrame, enrolled: Column, activity: DataFrame, rejected: DataFrame,
                     keys: Sequence[str]) -> DataFrame:
    """Members of a month: enrolled or active in it, and not rejected."""
    return exclude(keep_if_or_present(state, enrolled, activity, keys), rejected, keys)

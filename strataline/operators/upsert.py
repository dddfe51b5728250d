"""Upserts as joins. Each returns the new state; nothing is written here.

Keys are unique on both sides (see ``latest_per_key``), so no key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _null_safe(keys: Sequence[str], prefix: str = "_s_"):
    return [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys]


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows are replaced, the others inserted. Null keys match null keys,
    so a rerun never inserts them twice."""
    source_keys = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys]).distinct()
    kept = target.join(source_keys, _null_safe(keys), "left_anti")
    return kept.unionByName(source)


def touched_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str],
                       partition: str) -> list[str]:
    """Partitions an upsert changes: those of the source and those that hold one of its
    keys now. Reads only the key columns of the target; the list is bounded by
    the number of partitions."""
    source_keys = source.select(*keys).distinct()
    held = target.join(source_keys, list(keys), "left_semi").select(partition)
    return [row[0] for row in held.unionByName(source.select(partition)).distinct().collect()]


def upsert_changed(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   hash_column: str, month_column: str, keep: Sequence[str]) -> DataFrame:
    """Replace a matched row only when its hash differs or its month moved;
    columns in ``keep`` hold their first value for ever."""
    t, s = target.alias("t"), source.alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    in_target = F.col(f"t.{keys[0]}").isNotNull()
    in_source = F.col(f"s.{keys[0]}").isNotNull()
    moved = (
        ~F.col(f"t.{hash_column}").eqNullSafe(F.col(f"s.{hash_column}"))
        | ~F.col(f"t.{month_column}").eqNullSafe(F.col(f"s.{month_column}"))
    )
    take_source = in_source & (~in_target | moved)

    def pick(name: str):
        if name in keep:
            return F.when(in_target, F.col(f"t.{name}")).otherwise(F.col(f"s.{name}")).alias(name)
        return F.when(take_source, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name)

    return t.join(s, on, "full").select(*[pick(c) for c in target.columns])


def append_run_row(ledger: DataFrame, row: DataFrame) -> DataFrame:
    """Run log as an append-only table: a state change is a new row."""
    return ledger.unionByName(row, allowMissingColumns=True)


def latest_run_state(ledger: DataFrame, run_key: str, order: Sequence[str],
                     columns: Sequence[str]) -> DataFrame:
    """The last row of each run, by one map-side-combined aggregate."""
    last = F.max_by(F.struct(*columns), F.struct(*order)).alias("_last")
    return ledger.groupBy(run_key).agg(last).select(run_key, "_last.*")

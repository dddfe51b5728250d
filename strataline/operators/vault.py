"""Data Vault shapes: hubs, links and satellites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_blank


def _named(df: DataFrame, columns: Sequence[str], keys: Sequence[str],
           record_source: Column) -> DataFrame:
    present = ~is_blank(keys[0])
    for key in keys[1:]:
        present = present & ~is_blank(key)
    return df.filter(present).select(*columns, record_source.alias("record_source"))


def hub(df: DataFrame, key: str, record_source: Column) -> DataFrame:
    """Distinct non-blank business keys."""
    return _named(df, [key], [key], record_source).distinct()


def link(df: DataFrame, keys: Sequence[str], hubs: Sequence[DataFrame],
         record_source: Column) -> DataFrame:
    """Distinct key pairs whose members are all in their hubs. Pairs are made
    distinct before the semi joins, which then move each pair once."""
    pairs = _named(df, keys, keys, record_source).distinct()
    for key, members in zip(keys, hubs):
        pairs = pairs.join(members.select(key), key, "left_semi")
    return pairs.select(*keys, "record_source")


def satellite(df: DataFrame, key: str, attributes: Sequence[str], record_source: Column,
              hub_rows: DataFrame | None = None, distinct: bool = False) -> DataFrame:
    """Attributes of non-blank keys: record level, or distinct and tied to a hub."""
    rows = _named(df, [key, *attributes], [key], record_source)
    if hub_rows is not None:
        rows = rows.join(hub_rows.select(key), key, "left_semi")
    return rows.distinct() if distinct else rows


def with_load_timestamp(df: DataFrame, name: str = "load_timestamp") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())

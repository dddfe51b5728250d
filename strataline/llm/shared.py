"""Helpers the operators of this subpackage share: stored intermediates, table paths, input guards."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def folder_for(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    Cuts the lineage and survives lost executors; later reads prune columns.
    """
    spark = df.sparkSession
    path = folder_for(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows and bytes that go to a Python worker at once: whole texts can be long, and several workers share an executor.
ARROW_ROWS, ARROW_BYTES = 1000, 8 << 20


def map_arrow(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with small batches. Sets the session's Arrow batch limits, which hold for all its queries."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return df.mapInArrow(work, schema)


_HELD: dict[tuple, object] = {}


def held(kind: str, path: str, build: Callable[[str], object]):
    """This worker's copy of a large helper, one at a time: workers serve many tasks and stages, and what one operator
    keeps for its next task must not stay beside another operator's."""
    if (kind, path) not in _HELD:
        _HELD.clear()
        _HELD[kind, path] = build(path)
    return _HELD[kind, path]


def only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns alone, so that extra columns of any name can't clash with an operator's own."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def free_name(taken: Sequence[str], name: str) -> str:
    """``name``, or the first of it with underscores before it that no column has (names differ by more than case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def finite_vector(vector: str) -> Column:
    """True for a vector that is not null or empty and has only finite components."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & ~bad

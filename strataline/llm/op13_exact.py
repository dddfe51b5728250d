"""Exact dedup by a tree merge of sorted digest runs.

Every input partition merges its own digests, sorted, to one entry per digest with the row that stays and a count; the
entries of a partition, or of a few, are a run. The runs then merge in binomial rounds of fan-in ``FAN_IN``: in round r the partitions whose numbers differ in
digit r alone exchange parts of their runs, each taking the digests whose slot has its own digit there, and merge the
sorted parts they get. After ``log(partitions)`` rounds every partition holds all entries of its own slots, one per
digest, so no partition, and not the driver, ever holds more than its share.

An entry stands for equal texts only if digest (sha256), byte length and an independent 64-bit hash all agree, at every
level. A digest that a third of all rows share is one entry per run from the start. The way back is as even: each run's
entries learn the outcome (a digest has at most one entry per run), and rows read it from their own run's entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .shared import stored

FAN_IN = 4
SAME = ["digest", "size", "check"]


def merge_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted stream of entries the last one of each run of equal keys, with the sum of their counts ``n``."""
    waiting = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if waiting is None else [waiting, batch]).combine_chunks()
        if not len(table):
            continue
        differs = np.zeros(len(table) - 1, bool)
        for name in ["run", *SAME]:
            column = table[name]
            differs |= pc.not_equal(column.slice(1), column.slice(0, len(table) - 1)).to_numpy()
        ends = np.append(np.flatnonzero(differs), len(table) - 1)
        starts = np.append([0], ends[:-1] + 1)
        counts = np.add.reduceat(table["n"].to_numpy(), starts)
        merged = table.take(pa.array(ends))
        at = merged.schema.get_field_index("n")
        merged = merged.set_column(at, merged.schema.field(at), pa.array(counts, pa.int64()))
        rows = merged.combine_chunks().to_batches()[0]
        if len(rows) > 1:
            yield rows.slice(0, len(rows) - 1)
        waiting = rows.slice(len(rows) - 1)
    if waiting is not None:
        yield waiting


def _rounds(df: DataFrame) -> tuple[int, int]:
    """Number of rounds, and the power of the fan-in that reaches the session's number of shuffle partitions."""
    wanted, rounds = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1
    while FAN_IN ** rounds < wanted:
        rounds += 1
    return rounds, FAN_IN ** rounds


def _digit(number: Column, place: int) -> Column:
    return F.pmod(F.floor(number / F.lit(FAN_IN ** place)), F.lit(FAN_IN)).cast("int")


def merged_runs(runs: DataFrame, rounds: int, order: list[Column]) -> DataFrame:
    """Entries of all runs (columns ``run``, ``slot``, the key, ``keep_id``, ``keep_no``, ``n``) merged to one per key."""
    for place in range(rounds):
        partner = F.col("run") + (_digit(F.col("slot"), place) - _digit(F.col("run"), place)) * F.lit(FAN_IN ** place)
        sent = runs.withColumn("run", partner.cast("int")).repartitionById(FAN_IN ** rounds, "run")
        runs = sent.sortWithinPartitions(*SAME, *order).mapInArrow(merge_neighbours, sent.schema)
    return runs


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                     normalised: Column | None = None, smallest: bool = True) -> DataFrame:
    """One row per input row: ``id_column``, ``keep_id`` (id of the row of its equal texts that stays), ``group_size``,
    ``kept``, ``text_sha256`` (lowercase hex of the normalised text in UTF-8).

    The row with the smallest id stays, or the one with the largest; a null id only where all are null. Of repeated rows
    with that id exactly one is kept. ``normalised`` is the text to compare, ``text_column`` as it is by default; null
    counts as empty. An empty table gives no rows; a long text moves only as its digest; other columns, whatever their
    names, are ignored.
    """
    rounds, parts = _rounds(docs)
    text = F.coalesce(F.col(f"`{text_column}`") if normalised is None else normalised, F.lit("")).cast("binary")
    # Stored, so that runs and row numbers are the same for every later pass, also when an executor is lost.
    rows = stored(docs.select(
        F.col(f"`{id_column}`").alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).alias("size"),
        F.xxhash64(text).alias("check"), F.monotonically_increasing_id().alias("row_no"),
        F.pmod(F.spark_partition_id(), F.lit(parts)).alias("run")), "digests")
    # The last entry of equal keys stays, so the one to keep is sorted last; null ids come first either way.
    order = [F.col("keep_id").desc_nulls_first(), F.col("keep_no").desc()] if smallest else [
        F.col("keep_id").asc_nulls_first(), F.col("keep_no")]
    entries = rows.select("run", F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("int").alias("slot"), *SAME,
                          F.col("id").alias("keep_id"), F.col("row_no").alias("keep_no"), F.lit(1).cast("long").alias("n"))
    local = entries.sortWithinPartitions("run", *SAME, *order).mapInArrow(merge_neighbours, entries.schema)
    gathered = local.repartitionById(parts, "run").sortWithinPartitions("run", *SAME, *order)
    runs = stored(gathered.mapInArrow(merge_neighbours, entries.schema), "runs")
    classes = stored(merged_runs(runs, rounds, order).select(*SAME, "keep_id", "keep_no", "n"), "classes")
    outcome = runs.select("run", *SAME).join(classes, SAME)
    return rows.join(outcome, ["run", *SAME]).select(
        F.col("id").alias(id_column), "keep_id", F.col("n").alias("group_size"),
        (F.col("row_no") == F.col("keep_no")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))

"""Token ids of a corpus as ORC files: integer run-length encoding, row indexes and Bloom filters on document ids.

Documents are range-partitioned by id and sorted, so each file covers an id range of its own: file and stripe
statistics and row indexes prune lookups, Bloom filters settle single ids, and readers take stripes in parallel. A
row keeps its position inside its file's part; the few part totals, read from the files, make positions global.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .shared import map_arrow, only
from .tokens import encoder, vocabulary_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1000
IDS_OUT = 1 << 20  # ids of an outgoing batch
SCHEMA = "{id} {kind}, part int, part_start long, n_tokens long, ids array<int>"


def _tokenise(path: str, end_id: int, id_type: pa.DataType, names: list[str]):
    end = int(end_id).to_bytes(4, "little")

    def flush(docs: list, parts: list[bytes], part: int, start: int) -> pa.RecordBatch:
        sizes = np.array([len(p) // 4 for p in parts], np.int64)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return pa.RecordBatch.from_arrays([
            pa.array(docs, id_type), pa.array(np.full(len(docs), part, np.int32)), pa.array(start + ends[:-1]),
            pa.array(sizes),
            pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(parts), "<i4"))),
        ], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, start = encoder(path).encode, TaskContext.get().partitionId(), 0
        docs, parts, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                docs.append(doc.as_py())
                parts.append(encode(text.as_py()) + end)
                held += len(parts[-1]) // 4
                if held >= IDS_OUT:
                    yield flush(docs, parts, part, start)
                    start, docs, parts, held = start + held, [], [], 0
        if docs:
            yield flush(docs, parts, part, start)
    return work


def write_tokens(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text",
                 vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Write the ids of every whole text, each followed by ``end_id``, in ascending id order (null ids first; rows of
    one id by a hash of their text). Null and empty texts are the end id alone. An empty table writes no rows;
    other columns are ignored."""
    kind = docs.schema[id_column].dataType.simpleString()
    ordered = only(docs, [id_column, text_column]).withColumn("_tie", F.xxhash64(f"`{text_column}`"))
    order = [F.col(f"`{id_column}`").asc_nulls_first(), F.col("_tie")]
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    id_type = pa.string() if kind == "string" else {"int": pa.int32()}.get(kind, pa.int64())
    rows = map_arrow(ordered, 
        _tokenise(vocabulary or vocabulary_path(VOCABULARY), end_id, id_type, [id_column, "part", "part_start", "n_tokens", "ids"]),
        SCHEMA.format(id=f"`{id_column}`", kind=kind))
    (rows.write.mode("overwrite")
     .option("orc.bloom.filter.columns", id_column).option("orc.bloom.filter.fpp", "0.01")
     .option("orc.row.index.stride", str(INDEX_ROWS)).option("orc.stripe.size", str(STRIPE_BYTES))
     .option("orc.compress", "ZSTD").orc(path))


def read_tokens(spark: SparkSession, path: str, id_column: str = "doc_id", kind: str = "bigint") -> DataFrame:
    """The stored rows: ``id_column``, ``part``, ``part_start``, ``n_tokens``, ``ids``. Filters on the id reach the
    stripes' statistics, row indexes and Bloom filters."""
    return spark.read.schema(SCHEMA.format(id=f"`{id_column}`", kind=kind)).orc(path)


def lookup(spark: SparkSession, path: str, wanted: Sequence[int], id_column: str = "doc_id") -> DataFrame:
    """Rows of a few ids, by pushed-down equality."""
    return read_tokens(spark, path, id_column).where(F.col(id_column).isin(list(wanted)))


def with_positions(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`read_tokens` with ``start``: ids of all documents before it. The totals table has one row
    per written part, which bounds its window and its broadcast."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(offsets), "part").withColumn("start", F.col("before") + F.col("part_start")).drop("before")


def checksums(rows: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``id_column``, ``start``, ``n_tokens`` (counted from the ids read) and ``ids_crc32`` of rows with positions."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(2)
            ends = np.asarray(ids.offsets).tolist()
            values = memoryview(np.ascontiguousarray(np.asarray(ids.values), "<i4")).cast("B")
            sums = [zlib.crc32(values[4 * a:4 * b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(ends), pa.int64()), pa.array(sums, pa.int64())],
                [id_column, "start", "n_tokens", "ids_crc32"])

    kind = rows.schema[id_column].dataType.simpleString()
    return map_arrow(rows.select(id_column, "start", "ids"), 
        work, f"`{id_column}` {kind}, start long, n_tokens long, ids_crc32 long")

"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint maps to the bit counts of its 32 two-bit segments. Changing one bit changes one count by one, so the
Manhattan distance of two embeddings never exceeds the Hamming distance of the fingerprints. The range join uses a
grid over subspaces: of four blocks of eight counts, a pair within distance 2 leaves at least two blocks unchanged,
so it shares one of six cells that fix the counts of two blocks. Pairs of a cell pass the Manhattan bound, then the
exact Hamming test.

Cells of more than ``cell_pairs`` fingerprints never emit their pairs. Their members go an exact way that is linear
in their number: fingerprints are within two bits exactly if they share a neighbour within one bit, so each emits its
65 such neighbours and is tied to the smallest fingerprint that emitted the same one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .graph import components
from .shared import map_arrow, only, stored

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 2
BLOCK_MASKS = tuple(0xFFFF << (16 * i) for i in range(4))
LOW_BITS = 0x5555555555555555
CELL_PAIRS = 48
CHUNK = 1 << 16  # hashes whose bits are counted at once


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _bit_counts(hashes: list[int] | np.ndarray) -> np.ndarray:
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = np.array(hashes[at:at + CHUNK], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts


def fingerprint_of(hashes: list[int] | np.ndarray) -> int:
    """The unsigned 64-bit SimHash of shingle hashes: a bit is set if it is set in over half of them. None give zero."""
    bits = 2 * _bit_counts(hashes) > len(hashes)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text: A-Z lower-cased, words between ASCII white space, word shingles with
    repeats, XXH64; a bit is set if it is set in over half the hashes. No words give zero."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    return fingerprint_of([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())])


def with_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``row_key`` (hash of id and text) and ``fingerprint`` (the 64 bits as a signed long), a row per
    input row, without a shuffle."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [signed(fingerprint(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(values, pa.int64())], [id_column, "row_key", "fingerprint"])

    chosen = only(docs, [id_column, text_column]).select(
        f"`{id_column}`", f"`{text_column}`", row_key(id_column, text_column).alias("row_key"))
    kind = chosen.schema[id_column].dataType.simpleString()
    return map_arrow(chosen, work, f"`{id_column}` {kind}, row_key long, fingerprint long")


def links(fingerprints: DataFrame, cell_pairs: int = CELL_PAIRS) -> DataFrame:
    """Edges ``(a, b)`` over distinct fingerprints (column ``fingerprint``, longs): enough of the links at two or
    fewer differing bits that the linked groups are whole; every edge is such a link or joins two fingerprints by
    way of a third that both differ from in one bit at most, which again is within two bits."""
    x, y = F.col("fingerprint"), F.shiftrightunsigned(F.col("fingerprint"), 1)
    low = F.lit(LOW_BITS)
    both, either = x.bitwiseAND(y).bitwiseAND(low), x.bitwiseOR(y).bitwiseAND(low)
    # The count of each two-bit segment in unary (00, 01, 11): differing bits then are the Manhattan distance.
    embedded = fingerprints.select("fingerprint", F.shiftleft(both, 1).bitwiseOR(either).alias("counts"))
    pairs = [BLOCK_MASKS[i] | BLOCK_MASKS[j] for i in range(4) for j in range(i + 1, 4)]
    cells = embedded.select("fingerprint", "counts", F.posexplode(F.array(*[
        F.col("counts").bitwiseAND(F.lit(signed(mask))) for mask in pairs])).alias("grid", "cell"))
    sizes = cells.groupBy("grid", "cell").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(cells.join(sizes, ["grid", "cell"]), "cells")

    small = shared.where(F.col("n") <= cell_pairs)
    left = small.select("grid", "cell", F.col("fingerprint").alias("a"), F.col("counts").alias("u"))
    right = small.select("grid", "cell", F.col("fingerprint").alias("b"), F.col("counts").alias("v"))
    near = (
        left.join(right, ["grid", "cell"])
        .where("a < b")
        .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DISTANCE)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)
        .select("a", "b")
    )
    large = shared.where(F.col("n") > cell_pairs).select("fingerprint").distinct()
    flips = [F.lit(0).cast("long")] + [F.lit(signed(1 << i)).cast("long") for i in range(BITS)]
    balls = large.select("fingerprint", F.explode(F.array(*flips)).alias("flip")).select(
        "fingerprint", F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("neighbour"))
    # At most 65 fingerprints emit the same neighbour, so these lists are bounded.
    tied = balls.groupBy("neighbour").agg(F.collect_set("fingerprint").alias("all")).where(F.size("all") > 1)
    stars = tied.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b")
    return near.union(stars).distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``id_column``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable
    by links at two or fewer differing bits, itself included), ``row_key`` (hash of the row's id and text).

    Null, empty and blank texts have fingerprint zero, which links like any other. Equal fingerprints are one node,
    so repeated rows and large groups of copies cost one row each. A null id is kept and counts as smallest only if
    its component has no other. An empty table gives no rows; other columns are ignored.
    """
    rows, classes = _grouped(docs, id_column, text_column)
    return rows.join(classes, "fingerprint").select(
        id_column, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("keeper.id").alias("component_id"), "row_key")


def keepers(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``row_key`` of the row that stays of each group: the one with the smallest id, of several with that id the one
    with the smallest key."""
    return _grouped(docs, id_column, text_column)[1].select("keeper.row_key").distinct()


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """The hash of id and text that tells rows apart."""
    return F.xxhash64(f"`{id_column}`", F.lit("/"), f"`{text_column}`")


def _grouped(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows with fingerprints, and per fingerprint the first row of its group."""
    rows = stored(with_fingerprints(docs, id_column, text_column), "fingerprints")
    first = F.struct(F.col(f"`{id_column}`").isNull().alias("no_id"), F.col(f"`{id_column}`").alias("id"), "row_key")
    nodes = stored(rows.groupBy("fingerprint").agg(F.min(first).alias("first")), "nodes")
    found = components(links(nodes.select("fingerprint")))
    labelled = nodes.join(found, nodes["fingerprint"] == found["node"], "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("component"))
    groups = labelled.groupBy("component").agg(F.min("first").alias("keeper"))
    return rows, labelled.join(groups, "component").select("fingerprint", "keeper")

"""Near-duplicate embeddings by an epsilon grid order join.

Vectors within cosine ``c`` have unit vectors within ``eps = sqrt(2 - 2c)``. Unit vectors are projected on leading
principal dimensions, gridded with cells of width ``eps`` and sorted by their cells, first dimension first. The sorted
sequence is cut into intervals. A recursion over the tree of sequence intervals (groups of ranges, ranges, intervals,
then halves inside a task) drops every pair of intervals whose boxes are further apart than ``eps``; projections
never lengthen distances, so nothing is lost. What stays is compared by cosine in double precision.

Equal vectors are one class with a size, so copies cost one row. Pairs are never emitted: a comparison gives the
number of links of each vector and a spanning forest of the links it found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .graph import components
from .shared import finite_vector, map_arrow, only, stored

COSINE = 0.95
DIMENSIONS = 16  # leading principal dimensions that order and prune
SAMPLE = 4096  # vectors the dimensions are fitted on, the first by hash; they order and prune and decide nothing
INTERVAL = 4096  # vectors of an interval
LEAF = 256
_INTERVALS = "place long, dim int, lo array<double>, hi array<double>, n int, ids binary, sizes binary, vectors binary"


def _radius(cosine: float) -> float:
    return math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-7


def principal_dimensions(classes: DataFrame, sample: int = SAMPLE, keep: int = DIMENSIONS) -> dict[int, np.ndarray]:
    """An orthonormal basis per vector length, fitted on a sample of fixed size that the driver collects."""
    rows = classes.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").collect()
    by_length: dict[int, list] = {}
    for (vector,) in rows:
        by_length.setdefault(len(vector), []).append(vector)
    out = {}
    for length, vectors in by_length.items():
        unit = _unit(np.array(vectors, float))
        out[length] = np.ascontiguousarray(np.linalg.eigh(np.cov(unit.T, bias=True).reshape(length, length))[1][:, ::-1][:, :keep])
    return out


def _basis(bases: dict[int, np.ndarray], length: int) -> np.ndarray:
    """The fitted basis, or the first coordinates for a length the sample lacks."""
    return bases[length] if length in bases else np.eye(length)[:, :DIMENSIONS]


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no square over- or underflows
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _grid_keys(bases: dict[int, np.ndarray], radius: float):
    """Adds the sort key: vector length and grid cells as big-endian numbers."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets, flat = np.asarray(lists.offsets), np.asarray(lists.values, dtype=float)
            sizes = np.diff(offsets)
            keys: list[bytes] = [b""] * len(sizes)
            for length in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == length)
                rows = flat[offsets[at][:, None] + np.arange(length)]
                cells = np.floor(_unit(rows) @ _basis(bases, length) / radius) + (1 << 30)
                for i, cell in zip(at.tolist(), cells.astype(">u4")):
                    keys[i] = length.to_bytes(4, "big") + cell.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "cells"])
    return work


def _cut_intervals(bases: dict[int, np.ndarray], interval: int):
    """Sorted rows of a range to intervals: one row each with its box."""
    def pack(place: int, ids: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        spots = _unit(rows.astype(float)) @ _basis(bases, rows.shape[1])
        box = [np.pad(spots.min(axis=0), (0, DIMENSIONS - spots.shape[1])), np.pad(spots.max(axis=0), (0, DIMENSIONS - spots.shape[1]))]
        values = [place, rows.shape[1], box[0].tolist(), box[1].tolist(), len(ids), ids.tobytes(), sizes.tobytes(), rows.tobytes()]
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        names = [f.split(" ")[0] for f in _INTERVALS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, length = TaskContext.get().partitionId() << 32, [], None
        for batch in batches:
            lists = batch.column(2)
            offsets, flat = np.asarray(lists.offsets), np.asarray(lists.values, dtype=np.float64)
            ids, sizes = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                if held and (len(held) >= interval or b - a != length):
                    yield pack(place, *(np.array(x) for x in zip(*held)))
                    place, held = place + 1, []
                length = b - a
                held.append((ids[i], sizes[i], flat[a:b]))
        if held:
            yield pack(place, *(np.array(x) for x in zip(*held)))
    return work


def _apart(lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column) -> Column:
    """Squared distance of two boxes given as arrays."""
    gap = F.zip_with(F.zip_with(lo_b, hi_a, lambda x, y: x - y), F.zip_with(lo_a, hi_b, lambda x, y: x - y),
                     lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.aggregate(gap, F.lit(0.0), lambda total, g: total + g * g)


def _interval_pairs(intervals: DataFrame, radius: float) -> DataFrame:
    """Pairs ``(a, b)``, a <= b, of interval places that may hold links. The tree's levels are all intervals, groups
    of sixteen ranges, ranges, intervals; a pair of a level meets the pairs of its parents by an equi-join."""
    boxes = stored(intervals.select("place", "dim", "lo", "hi"), "boxes")

    def level(node: Column, parent: Column) -> DataFrame:
        parts = [F.array(*[f(F.col(side)[i]) for i in range(DIMENSIONS)]).alias(side) for f, side in ((F.min, "lo"), (F.max, "hi"))]
        return boxes.groupBy("dim", node.alias("node"), parent.alias("parent")).agg(*parts)

    ranges = F.shiftright("place", 32)
    nothing = F.lit(0).cast("long")
    pairs = boxes.select("dim", nothing.alias("a"), nothing.alias("b")).distinct()
    for nodes in (level(F.shiftright("place", 36), nothing), level(ranges, F.shiftright("place", 36)), level(F.col("place"), ranges)):
        left = nodes.select("dim", F.col("parent").alias("a"), F.col("node").alias("new_a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"))
        right = nodes.select("dim", F.col("parent").alias("b"), F.col("node").alias("new_b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"))
        pairs = (
            pairs.join(left, ["dim", "a"]).join(right, ["dim", "b"]).where("new_a <= new_b")
            .where(_apart(F.col("lo_a"), F.col("hi_a"), F.col("lo_b"), F.col("hi_b")) <= radius * radius)
            .select("dim", F.col("new_a").alias("a"), F.col("new_b").alias("b"))
        )
    return pairs.select("a", "b")


def _hits(a: np.ndarray, b: np.ndarray, spots_a: np.ndarray, spots_b: np.ndarray, cosine: float, radius: float,
          same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of links between two intervals, by recursive halving of the longer until boxes are apart or short;
    of an interval with itself each pair comes once."""
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        if same and k >= j or i >= j or k >= m:
            if not (same and k >= j):
                continue
        gap = np.maximum(spots_a[i:j].min(axis=0) - spots_b[k:m].max(axis=0), spots_b[k:m].min(axis=0) - spots_a[i:j].max(axis=0))
        gap = np.maximum(gap, 0)
        if gap @ gap > radius * radius:
            continue
        if max(j - i, m - k) > LEAF:
            if j - i >= m - k:
                mid = (i + j) // 2
                todo += [(i, mid, k, m), (mid, j, k, m)]
            else:
                mid = (k + m) // 2
                todo += [(i, j, k, mid), (i, j, mid, m)]
            continue
        if same and m <= i:
            continue  # the mirrored pair is compared
        x, y = np.nonzero(a[i:j] @ b[k:m].T >= cosine)
        x, y = x + i, y + k
        if same:
            keep = x < y
            x, y = x[keep], y[keep]
        if len(x):
            yield x, y


def _forest(x: np.ndarray, y: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links between positions in ``nodes``: each linked node with the smallest it reaches."""
    used, flat = np.unique(np.concatenate((x, y)), return_inverse=True)
    i, j = flat[:len(x)], flat[len(x):]
    order = np.argsort(nodes[used], kind="stable")
    label = np.empty(len(used), np.int64)
    label[order] = np.arange(len(used))
    by_rank = used[order]
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = np.minimum(new, new[order[new]])
        if (new == label).all():
            break
        label = new
    return nodes[used], nodes[by_rank[label]]


def _compare(bases: dict[int, np.ndarray], cosine: float):
    radius = _radius(cosine)

    def read(batch: pa.RecordBatch, row: int, at: int):
        dim, n = batch.column(at)[row].as_py(), batch.column(at + 1)[row].as_py()
        ids, sizes, vectors = (np.frombuffer(batch.column(at + k)[row].as_buffer(), kind) for k, kind in ((2, np.int64), (3, np.int64), (4, np.float64)))
        unit = _unit(vectors.reshape(n, dim))
        return ids, sizes, unit, unit @ _basis(bases, dim)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                same = batch.column(0)[row].as_py() == batch.column(1)[row].as_py()
                ids_a, sizes_a, a, spots_a = read(batch, row, 2)
                ids_b, sizes_b, b, spots_b = (ids_a, sizes_a, a, spots_a) if same else read(batch, row, 7)
                shift = 0 if same else len(ids_a)
                nodes = ids_a if same else np.concatenate((ids_a, ids_b))
                links, xs, ys = np.zeros(len(nodes), np.int64), [], []
                for x, y in _hits(a, b, spots_a, spots_b, cosine, radius, same):
                    np.add.at(links, x, sizes_b[y])
                    np.add.at(links, y + shift, sizes_a[x])
                    xs.append(x)
                    ys.append(y + shift)
                if not xs:
                    continue
                node, least = _forest(np.concatenate(xs), np.concatenate(ys), nodes)
                linked = np.flatnonzero(links)
                columns = ([nodes[linked], node], [nodes[linked], least], [links[linked], np.zeros(len(node), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["a", "b", "n"])
    return work


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_column: str = "vec_id",
                    vector_column: str = "embedding", interval: int = INTERVAL) -> DataFrame:
    """One row per input row: ``vec_id``, ``n_links`` (other rows linked directly), ``component_id`` (smallest id
    reachable by links, itself included), ``kept`` (whether that is the row's own id).

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; so do vectors of
    different lengths with each other, and rows without an id (no component, not kept). Repeated rows link with each
    other; rows that share an id are one node. An empty table gives no rows; other columns are ignored.
    """
    chosen = only(vectors, [id_column, vector_column]).select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector_column}`").alias("vector"))
    usable = F.col("vec_id").isNotNull() & finite_vector("vector") & F.exists("vector", lambda x: x != 0)
    marked = chosen.select("vec_id", F.when(usable, F.col("vector")).alias("vector"))
    same = [F.xxhash64("vector").alias("hash_1"), F.hash("vector").alias("hash_2")]
    classes = stored(marked.where("vector IS NOT NULL").groupBy("vector").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies")).select("id", "copies", "vector", *same), "classes")

    bases = principal_dimensions(classes)
    radius = _radius(cosine)
    kind = classes.schema["vector"].dataType.simpleString()
    keyed = map_arrow(classes.select("id", "copies", "vector"), 
        _grid_keys(bases, radius), f"id long, copies long, vector {kind}, cells binary")
    # Ranges of an interval or more: narrow ones would make many short intervals and so many more pairs of them.
    # Adjacent ranges are merged before the sort, so a task still holds one stretch of the sequence.
    ranges = max(1, classes.count() // interval)
    ordered = keyed.repartitionByRange(ranges, "cells", "id").coalesce(ranges).sortWithinPartitions("cells", "id")
    intervals = stored(map_arrow(ordered.select("id", "copies", "vector"), _cut_intervals(bases, interval), _INTERVALS), "intervals")

    def side(place: str) -> DataFrame:
        return intervals.select(F.col("place").alias(place), *[F.col(c).alias(f"{c}_{place}") for c in ("dim", "n", "ids", "sizes", "vectors")])

    pairs = _interval_pairs(intervals, radius).join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", *[f"{c}_{p}" for p in "ab" for c in ("dim", "n", "ids", "sizes", "vectors")])
    found = stored(map_arrow(pairs, _compare(bases, cosine), "a long, b long, n long"), "links")
    links = found.groupBy("a").agg(F.sum("n").alias("n"))
    groups = components(found.where("n = 0").select("a", "b"))
    labelled = classes.select("id", "copies", "hash_1", "hash_2").join(links, F.col("id") == F.col("a"), "left").join(
        groups, F.col("id") == F.col("node"), "left").select(
            "hash_1", "hash_2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component"))
    keys = marked.select("vec_id", F.col("vector").isNotNull().alias("usable"), *same)
    return keys.where("usable").join(labelled, ["hash_1", "hash_2"]).select(
        "vec_id", "n_links", F.col("component").alias("component_id"), (F.col("vec_id") == F.col("component")).alias("kept"),
    ).union(keys.where("NOT usable").select(
        "vec_id", F.lit(0).cast("long"), "vec_id", F.col("vec_id").isNotNull()))

"""Exact top-k search by a bit-sliced index.

Components are quantised to integers; an index row holds a block of vectors as bitmaps, one per component and bit. A
query's scores for a whole block are the sum of its components' multiples of the block's slices, formed with bitmap
adders only: the sixteen multiples a hexadecimal digit can select are built once per block and added digit by digit.
The k best are read off the sum's slices from the most significant downward, keeping the rows surely above and the
rows still equal to the boundary; ties at the boundary go to the smaller id.

Queries meet the index in blocks: every block of queries is sent to every shelf of index blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import finite_vector, map_arrow, only, stored

SCALE = 256
BLOCK = 8192  # vectors of an index block
QUERIES = 64  # queries of a query block
LARGEST = 1 << 24  # vectors with a quantised component beyond this are blocked apart and may need Python's integers
LONG = 1 << 63
DIGIT = 4
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _batches(column: pa.Array, ids: np.ndarray) -> Iterator[tuple[tuple[int, bool], np.ndarray, np.ndarray]]:
    """Length and whether a component is beyond ``LARGEST``, ids and quantised rows of the vectors of each such kind."""
    offsets, flat = np.asarray(column.offsets), np.asarray(column.values, dtype=np.int64)
    sizes = np.diff(offsets)
    for length in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == length)
        rows = flat[offsets[at][:, None] + np.arange(length)]
        large = (np.abs(rows) > LARGEST).any(axis=1)
        for kind in np.unique(large).tolist():
            yield (length, kind), ids[at[large == kind]], rows[large == kind]


def _grouped(size: int, pack, names: list[str], kinds: list[pa.DataType]):
    """A partition's vectors in rows of up to ``size`` vectors of one kind, as ``pack`` forms them."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list] = {}
        shelf = TaskContext.get().partitionId()

        def out(kind: tuple[int, bool]) -> pa.RecordBatch:
            ids = np.concatenate([x[0] for x in held[kind]])
            rows = np.concatenate([x[1] for x in held[kind]])
            order = np.argsort(ids, kind="stable")
            held[kind] = [(ids[order[size:]], rows[order[size:]])]
            values = [shelf, kind[0], *pack(ids[order[:size]], rows[order[:size]])]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for kind, ids, rows in _batches(batch.column(1), np.asarray(batch.column(0))):
                held.setdefault(kind, []).append((ids, rows))
                while sum(len(x[0]) for x in held[kind]) >= size:
                    yield out(kind)
        for kind in list(held):
            while sum(len(x[0]) for x in held[kind]):
                yield out(kind)
    return work


def _slice_block(ids: np.ndarray, rows: np.ndarray) -> tuple:
    """Bitmaps of a block: component by component, bit by bit from the lowest, above each component's least value."""
    least = rows.min(axis=0)
    lifted = rows.astype(np.uint64) - least.astype(np.uint64)  # modulo 2**64, which holds any difference of longs
    bits = max(1, int(lifted.max()).bit_length())
    words = -(-len(ids) // 64)
    planes = np.zeros((rows.shape[1], bits, words * 64), bool)
    for bit in range(bits):
        planes[:, bit, :len(ids)] = ((lifted >> np.uint64(bit)) & np.uint64(1)).T.astype(bool)
    packed = np.packbits(planes, axis=2, bitorder="little")
    return len(ids), bits, ids.tobytes(), least.tobytes(), packed.tobytes()


def _add(total: np.ndarray, term: np.ndarray, at: int) -> None:
    """Add bit slices ``term`` (bit, ...) to ``total`` from bit ``at`` on, in place."""
    carry = None
    for j in range(at, len(total)):
        here = total[j]
        if j - at < len(term):
            x = term[j - at]
            half = here ^ x
            if carry is None:
                carry = here & x
                total[j] = half
            else:
                both = here & x
                total[j] = half ^ carry
                carry &= half
                carry |= both
        else:
            if not carry.any():
                return
            flipped = here ^ carry
            carry &= here
            total[j] = flipped


def scores(slices: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit slices (bit, query, word) of non-negative sums, and what to add to each query's sums: of
    ``slices`` (component, bit, word) and signed ``queries`` (query, component). A negative factor times a value is
    its absolute value times the complement, less a constant."""
    n_parts, bits, words = slices.shape
    top = (1 << bits) - 1
    size = np.abs(queries)
    width = max(1, int(size.sum(axis=1).max() * top).bit_length())
    total = np.zeros((width, len(queries), words), np.uint64)
    digits = max(1, -(-int(size.max()).bit_length() // DIGIT))
    for part in range(n_parts):
        factor, negative = size[:, part], queries[:, part] < 0
        if not factor.any():
            continue
        multiples = np.zeros((bits + DIGIT, 1 << (DIGIT + 1), words), np.uint64)  # 16 of the value, 16 of its complement
        for flip, plain in enumerate((slices[part], ~slices[part])):
            base = flip << DIGIT
            for k in range(1, 1 << DIGIT):
                low = k & -k
                if k == low:
                    shift = low.bit_length() - 1
                    multiples[shift:shift + bits, base + k] = plain
                else:
                    multiples[:, base + k] = multiples[:, base + k - low]
                    _add(multiples[:, base + k], plain, low.bit_length() - 1)
        for digit in range(digits):
            chosen = ((factor >> (DIGIT * digit)) & ((1 << DIGIT) - 1)) + (negative.astype(np.int64) << DIGIT)
            if (chosen & ((1 << DIGIT) - 1)).any():
                _add(total, multiples[:, chosen], DIGIT * digit)
    return total, -(np.where(queries < 0, size, 0).sum(axis=1) * top)


def best(total: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps (query, word) of the rows surely among the k best and of the rows equal to the last of them, from the
    most significant slice downward; ``allowed`` has the rows that count."""
    above, level = np.zeros_like(allowed), allowed.copy()
    for plane in total[::-1]:
        with_bit = above | (level & plane)
        many = np.bitwise_count(with_bit).sum(axis=1)[:, None] > k
        above = np.where(many, above, with_bit)
        level &= np.where(many, plane, ~plane)
    return above, level


def _fits(queries: np.ndarray, least: np.ndarray, bits: int) -> bool:
    """Whether no sum over the block can leave the longs the bitmaps are read into."""
    largest = max(int(np.abs(least.astype(object)).max()), 1) + (1 << bits)
    return max(sum(map(abs, row)) for row in queries.tolist()) * largest < LONG >> 1


def _exactly(slices: np.ndarray, least: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray,
             k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of a block in Python's integers: query ids, ids, scores. Scores that are no long take no part."""
    lifted = np.zeros((len(ids), len(least)), object)
    for bit in range(slices.shape[1]):
        plane = np.unpackbits(np.ascontiguousarray(slices[:, bit]).view(np.uint8), axis=1, bitorder="little")[:, :len(ids)]
        lifted += plane.T.astype(object) * (1 << bit)
    rows = lifted + least.astype(object)
    out = []
    for query_id, query in zip(query_ids.tolist(), queries.astype(object)):
        scored = [(-score, i) for score, i in zip(rows @ query, ids.tolist()) if i != query_id and -LONG <= score < LONG]
        out += [(query_id, i, -score) for score, i in sorted(scored)[:k]]
    found = np.array(out, np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def _search(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, dim, bits = row["n"], row["dim"], row["bits"]
                words = -(-n // 64)
                slices = np.frombuffer(row["slices"], np.uint64).reshape(dim, bits, words)
                ids, least = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["least"], np.int64)
                query_ids = np.frombuffer(row["query_ids"], np.int64)
                queries = np.frombuffer(row["query_rows"], np.int64).reshape(len(query_ids), dim)
                if not _fits(queries, least, bits):
                    yield pa.RecordBatch.from_arrays(
                        list(map(pa.array, _exactly(slices, least, ids, queries, query_ids, k))), ["query_id", "vec_id", "score"])
                    continue
                total, constant = scores(slices, queries)
                constant = constant + queries @ least
                valid = np.zeros((len(query_ids), words * 64), bool)
                valid[:, :n] = ids[None, :] != query_ids[:, None]
                allowed = np.packbits(valid, axis=1, bitorder="little").view(np.uint64)
                above, level = best(total, allowed, k)
                query_at, found = [], []
                for q in range(len(query_ids)):
                    sure = np.flatnonzero(np.unpackbits(above[q].view(np.uint8), bitorder="little"))
                    ties = np.flatnonzero(np.unpackbits(level[q].view(np.uint8), bitorder="little"))[:k - len(sure)]
                    query_at += [q] * (len(sure) + len(ties))
                    found += [sure, ties]  # ids ascend in a block, so the first ties have the smallest
                at, q = np.concatenate(found).astype(np.int64), np.array(query_at, np.int64)
                bit = (total[:, q, at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
                value = (bit.astype(np.int64) << np.arange(len(total))[:, None]).sum(axis=0) + constant[q]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[q]), pa.array(ids[at]), pa.array(value)], ["query_id", "vec_id", "score"])
    return work


def build_index(quantised: DataFrame, block: int = BLOCK) -> DataFrame:
    """Index rows of ``(vec_id, vector array<long>)``: ``shelf``, ``dim``, ``n``, ``bits``, ``ids``, ``least``,
    ``slices``. Each partition forms its own blocks; nothing is shuffled."""
    names = ["shelf", "dim", "n", "bits", "ids", "least", "slices"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return map_arrow(quantised, _grouped(block, _slice_block, names, kinds),
                                "shelf int, dim int, n int, bits int, ids binary, least binary, slices binary")


def quantise(vectors: DataFrame, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id`` and floor(scale * x) of each component x as a double, of the rows that take part."""
    chosen = only(vectors, [id_column, vector_column]).select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector_column}`").alias("vector"))
    usable = F.col("vec_id").isNotNull() & finite_vector("vector") & ~F.exists(
        "vector", lambda x: F.abs(x.cast("double") * scale) >= float(LONG))
    return chosen.where(usable).select(
        "vec_id", F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vector"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE, id_column: str = "vec_id",
          vector_column: str = "embedding") -> DataFrame:
    """The ``k`` rows with the highest inner product of quantised vectors for each row where ``is_query`` (over the
    column ``vec_id``) holds: ``query_id``, ``rank``, ``vec_id``, ``score``; all others if they are fewer; ties to
    the smaller id.

    Vectors that are null, empty, or hold null, non-finite or unquantisable components (no long after scaling) take no
    part, nor do rows without an id, nor candidates whose score with a query is no long; zero vectors do. A row is not its own candidate: rows with the query's id are left
    out. Vectors of another length than the query's are no candidates. Empty tables give no rows; other columns are
    ignored.
    """
    rows = stored(quantise(vectors, scale, id_column, vector_column), "quantised")
    index = stored(build_index(rows), "index")
    names = ["block", "dim", "query_ids", "query_rows"]
    asked = map_arrow(rows.where(is_query), 
        _grouped(QUERIES, lambda ids, values: (ids.tobytes(), values.tobytes()), names, [pa.int32(), pa.int32(), pa.binary(), pa.binary()]),
        "block int, dim int, query_ids binary, query_rows binary")
    shelves = index.select("shelf", "dim").distinct()
    # The query set against all rows, in blocks: a block of queries for each shelf that has vectors of its length.
    sent = asked.drop("block").join(shelves, "dim")
    # Few bytes but much arithmetic: spread over all cores instead of by size.
    spread = sent.join(index, ["shelf", "dim"]).repartition(4 * vectors.sparkSession.sparkContext.defaultParallelism)
    found = map_arrow(spread, _search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates share a cell. The first cells are op 8's: SimHash fingerprints of the sets, linked at two or fewer differing
bits by its segment-count grid, its Manhattan bound and its exact Hamming test; a cell holds a fingerprint and those it is
linked with. The others are 32 bands of five minima of the set under random orders, since pairs at 0.8 lie about ten of 64
bits apart and up to twenty: a pair at similarity s shares no band with probability (1 - s**5)**32, which is 3e-6 at 0.8
and less above. What shares a cell of either kind is compared exactly. Texts with equal sets are one node.

No pairs are made. All cells with the same least node are one unit, so a set travels once per unit and not once per cell
or pair. Units are cut into parts of a block's size; a task takes one part, opens its sets through an inverted index and
returns a spanning forest of the links it finds. Inside a part every pair of nodes that earlier links leave apart is
compared. Parts of one unit are tied by four leaders that all of them get. What then is still in another component than
most of its unit goes, block by block, past every part of it: the only work that can exceed a multiple of the nodes, and
it is done on blocks, with one row per node and block and no row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import op8_simhash
from .graph import components
from .shared import free_name, map_arrow, stored
from .words import mix

SHINGLE = 5
SIMILARITY = 0.8
SEED = 42
BANDS, ROWS = 32, 5
LEADERS = 4
BLOCK_NODES, BLOCK_SHINGLES = 1024, 1 << 19  # of a part; a single longer set is a part of its own size
CHUNK = 1 << 13  # shingles put in all orders at once
_RANDOM = np.random.default_rng(SEED)
_FACTORS = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
_JOIN = _RANDOM.integers(0, 1 << 64, (BANDS, ROWS), np.uint64) | np.uint64(1)
_BAND = _RANDOM.integers(0, 1 << 64, BANDS, np.uint64)


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Ascending distinct hashes of a text's word shingles: A-Z lower-cased, words between ASCII white space; fewer
    words than a shingle make one, no words none."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())], np.uint64))


def set_key(hashes: np.ndarray) -> bytes:
    """A 128-bit hash of a shingle set."""
    import xxhash

    return xxhash.xxh128_digest(hashes.tobytes(), SEED)


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """A 128-bit hash of id and text, which tells rows apart."""
    parts = [F.col(f"`{c}`").cast("string") for c in (id_column, text_column)]
    return F.unhex(F.md5(F.concat(F.coalesce(parts[0], F.lit("-")), F.lit("/"), F.coalesce(F.concat(F.lit("/"), parts[1]), F.lit("")))))


def cells(hashes: np.ndarray) -> np.ndarray:
    """The cell of each band, as signed longs; none for an empty set."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), CHUNK):
        least = np.minimum(least, (hashes[at:at + CHUNK, None] * _FACTORS + _SHIFTS).min(axis=0))
    return mix((mix(least).reshape(BANDS, ROWS) * _JOIN).sum(axis=1, dtype=np.uint64) + _BAND).view(np.int64)


def _sketched(docs: DataFrame, id_column: str, text_column: str, shingle: int) -> DataFrame:
    """``id``, ``row_key``, ``set_key``, ``size`` and ``fingerprint`` of the shingle set, ``cells``; a row per input row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([set_key(s) for s in sets], pa.binary()),
                 pa.array(map(len, sets), pa.int64()),
                 pa.array([op8_simhash.signed(op8_simhash.fingerprint_of(s)) for s in sets], pa.int64()),
                 pa.array([cells(s) for s in sets], pa.list_(pa.int64()))],
                ["id", "row_key", "set_key", "size", "fingerprint", "cells"])

    chosen = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"),
                         row_key(id_column, text_column).alias("row_key"))
    kind = chosen.schema["id"].dataType.simpleString()
    return map_arrow(chosen, work, f"id {kind}, row_key binary, set_key binary, size long, fingerprint long, cells array<long>")


def _sets(docs: DataFrame, nodes: DataFrame, id_column: str, text_column: str, shingle: int) -> DataFrame:
    """``node`` and ``hashes`` of the nodes, from the text of one row of each."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingles(t.as_py(), shingle).tobytes() for t in batch.column(1)], pa.binary())],
                ["node", "hashes"])

    rows = docs.select(row_key(id_column, text_column).alias("row_key"), F.col(f"`{text_column}`").alias("text"))
    found = rows.join(nodes.select("node", "first.row_key"), "row_key").dropDuplicates(["node"])  # of repeated rows, one
    return stored(map_arrow(found.select("node", "text"), work, "node long, hashes binary"), "shingles")


def forest(hashes: list[np.ndarray], component: np.ndarray, asked: np.ndarray | None, similarity: float) -> list[tuple[int, int]]:
    """Links between sets of different components, enough to join all that links join.

    With ``asked`` the asked sets are compared with all others; without, all with all. ``component`` is updated.
    """
    n = len(hashes)
    if (component == component[0]).all():
        return []
    sizes = np.array([len(h) for h in hashes])
    ends = np.cumsum(sizes)
    _, token = np.unique(np.concatenate(hashes), return_inverse=True)
    order = np.argsort(token, kind="stable")
    owner = np.repeat(np.arange(n), sizes)[order]
    first = np.searchsorted(token[order], np.arange(token.max() + 2 if len(token) else 1))
    links: list[tuple[int, int]] = []

    def visit(i: int) -> None:
        mine = token[ends[i] - sizes[i]:ends[i]]
        count = first[mine + 1] - first[mine]
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        both = np.bincount(owner[np.repeat(first[mine], count) + step], minlength=n)
        near = np.flatnonzero((both / np.maximum(sizes + sizes[i] - both, 1) >= similarity) & (component != component[i]))
        for j in near.tolist():
            if component[j] != component[i]:
                links.append((i, j))
                component[component == component[j]] = component[i]

    if asked is not None:
        for i in np.flatnonzero(asked).tolist():
            visit(i)
        return links
    for i in range(min(LEADERS, n)):
        visit(i)
    # Pairs of sets that nobody visits must end up in one component: the largest.
    names, counts = np.unique(component, return_counts=True)
    member = int(np.flatnonzero(component == names[counts.argmax()])[0])
    for i in range(LEADERS, n):
        if component[i] != component[member]:
            visit(i)
    return links


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows that agree in the first columns."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = np.stack([np.asarray(batch.column(k)).astype(np.int64) for k in range(keys)])
        edges = [0, *(np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1).tolist(), len(batch)]
        for a, b in zip(edges[:-1], edges[1:]):
            key = tuple(columns[:, a].tolist())
            if waiting and key != last:
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(batch.slice(a, b - a))
            last = key
    if waiting:
        yield pa.Table.from_batches(waiting)


def _linked(rows: DataFrame, sets: DataFrame, keys: list[str], similarity: float) -> DataFrame:
    """Spanning forests ``(a, b)`` of the groups that agree in ``keys``; rows have a ``node``, its ``component`` and
    ``asked`` (null: compare all)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, len(keys)):
            node, component = group["node"].to_numpy(), group["component"].to_numpy().copy()
            asked = None if group["asked"].null_count else group["asked"].to_numpy()
            hashes = [np.frombuffer(h.as_buffer(), np.uint64) for h in group["hashes"]]
            links = np.array(forest(hashes, component, asked, similarity), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(node[links[:, 0]]), pa.array(node[links[:, 1]])], ["a", "b"])

    met = rows.join(sets, "node").select(*keys, "node", "component", "asked", "hashes")
    return stored(map_arrow(met.repartition(*keys).sortWithinPartitions(*keys), work, "a long, b long"), "links")


def _parts(nodes: str, shingle_count: str) -> Column:
    """Number of blocks for so many nodes and shingles."""
    return F.greatest(F.ceil(F.col(nodes) / BLOCK_NODES), F.ceil(F.col(shingle_count) / BLOCK_SHINGLES)).cast("int")


def _near_prints(nodes: DataFrame) -> DataFrame:
    """``node``, ``size``, ``cell`` by op 8's links: a cell of every fingerprint for itself and all it is linked with."""
    prints = nodes.select("fingerprint").distinct()
    linked = stored(op8_simhash.links(prints), "prints")
    held = prints.select(F.col("fingerprint").alias("centre"), "fingerprint").union(linked.select("a", "b"))
    return nodes.join(held, "fingerprint").select("node", "size", F.xxhash64(F.lit("fingerprint"), "centre").alias("cell"))


def _units(nodes: DataFrame) -> DataFrame:
    """``unit``, ``node``, ``size``: what is to be compared with each other. All cells with the same least node are one
    unit, named by it: nodes that share a cell share its unit, and a node has few of them though it has 33 cells and
    more."""
    spread = nodes.select("node", "size", F.explode("cells").alias("cell")).union(_near_prints(nodes))
    shared = spread.groupBy("cell").agg(F.min("node").alias("unit"), F.count("*").alias("n")).where("n > 1").select("cell", "unit")
    return spread.join(shared, "cell").select("unit", "node", "size").distinct()


def keepers(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
            similarity: float = SIMILARITY) -> DataFrame:
    """``row_key`` of the row that stays of each group of near copies, linked directly or by way of others: the one with
    the smallest id (null last), of several with that id the one with the smallest key. Null, empty and blank texts are
    one group; an empty table gives no rows; other columns, whatever their names, are ignored."""
    rows = stored(_sketched(docs, id_column, text_column, shingle), "sketches")
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "row_key")
    nodes = stored(rows.groupBy("set_key").agg(
        F.min(first).alias("first"), F.first("size").alias("size"), F.first("fingerprint").alias("fingerprint"),
        F.first("cells").alias("cells")).select(
            F.monotonically_increasing_id().alias("node"), "first", "size", "fingerprint", "cells"), "nodes")
    units = stored(_units(nodes), "units")
    cut = stored(units.groupBy("unit").agg(F.count("*").alias("n"), F.sum("size").alias("s")).select(
        "unit", _parts("n", "s").alias("parts")), "parts")
    chance = F.xxhash64("node")
    dealt = units.join(cut, "unit").withColumn("part", F.pmod(chance, F.col("parts")).cast("int"))
    several = cut.agg(F.max("parts")).first()[0] or 1
    if several > 1:
        dealt = stored(dealt, "dealt")
        leaders = dealt.where("parts > 1").groupBy("unit", "parts", F.pmod(chance, F.lit(LEADERS)).alias("k")).agg(
            F.min(F.struct(chance.alias("chance"), "node")).alias("least")).select(
                "unit", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("least.node").alias("node"))
        compared = dealt.select("unit", "part", "node").union(leaders).distinct()
    else:
        compared = dealt.select("unit", "part", "node")
    sets = _sets(docs, nodes.join(units.select("node").distinct(), "node", "left_semi"), id_column, text_column, shingle)
    links = _linked(compared.withColumns({"component": F.col("node"), "asked": F.lit(None).cast("boolean")}), sets,
                    ["unit", "part"], similarity)
    found = components(links)
    if several > 1:
        more = _apart(dealt.where("parts > 1"), found, sets, similarity)
        found = components(links.union(more))
    labelled = nodes.select("node", "first").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    return labelled.groupBy("component").agg(F.min("first").alias("keeper")).select("keeper.row_key")


def _apart(dealt: DataFrame, found: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links of what the leaders left in another component than most of a unit of several parts, against all its parts."""
    placed = stored(dealt.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
    most = placed.groupBy("unit", "component").agg(F.count("*").alias("k")).groupBy("unit").agg(
        F.max_by("component", F.struct("k", "component")).alias("most"), F.count("*").alias("n")).where("n > 1").drop("n")
    apart = stored(placed.join(most, "unit").where("component <> most"), "apart")
    blocks = stored(apart.groupBy("unit").agg(F.count("*").alias("n"), F.sum("size").alias("s")).select(
        "unit", _parts("n", "s").alias("blocks")), "blocks")
    columns = ["unit", "part", "block", "node", "component"]
    past = placed.join(blocks, "unit").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = apart.join(blocks, "unit").withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = past.select(*columns, F.lit(False).alias("asked")).union(sent.select(*columns, F.lit(True))).groupBy(
        *columns).agg(F.max("asked").alias("asked"))
    return _linked(tiles, sets, ["unit", "part", "block"], similarity)


def kept(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns; of repeated rows, one."""
    names = docs.columns
    key = free_name(names, "row_key")
    keyed = docs.withColumn(key, row_key(id_column, text_column))
    stay = keepers(docs, id_column, text_column).withColumnRenamed("row_key", key)
    return keyed.join(stay, key, "left_semi").dropDuplicates([key]).select(*[f"`{c}`" for c in names])

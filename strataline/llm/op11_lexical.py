"""Ranked lexical search over range-maximum tables of posting lists.

Documents are read once per wave of items into forward rows (document, length, its terms that items ask for, their
counts); those rows give the corpus statistics and, dealt out evenly by document, shards of up to ``SHARD_POSTINGS``
postings. A shard holds one posting list per term, sorted by document, with the impact (weight times saturated count) of
each posting and a sparse table that answers "largest impact in this range of the list" from two entries.

An item's search in a shard keeps intervals of documents. The sum of its lists' range maxima bounds every score in an
interval. The intervals with the highest bounds come first; each is split at the document of its largest impact, which
is scored exactly by the same binary searches that cut the lists for both halves; intervals of a few documents are
scored whole. What cannot reach the item's 50th best score so far, over all shards the task has seen, is never opened.
Bounds never fall short and equal bounds are opened, so the result is exact, ties included.

Items are the stated query set: they go past every shard in waves of at most ``WAVE_TERMS`` terms (an item with more is
a wave by itself), which bounds what tasks and driver hold of them, whatever their number.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .shared import map_arrow, only, stored

TOP = 50
WAVE_TERMS = 1 << 18
SHARD_POSTINGS = 1 << 20
SHARD_DOCUMENTS = 1 << 15
WIDTH = 64   # intervals opened at once
SMALL = 24   # documents of an interval that is scored whole
PIECE = 1 << 20  # bytes of a text whose terms are counted at once
SCALE, SLOPE, PIVOT = 1_000_000_000, 1000, 20  # of a posting's impact
LEVEL, SHARE = 100, 50  # of a document's length norm

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def counted(text: str | None) -> Counter[bytes]:
    """Terms of a whole text with their counts: maximal runs of ASCII letters and digits and of all characters beyond
    ASCII, only A-Z lower-cased; null has none."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    found: Counter[bytes] = Counter()
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + PIECE)
        end = gap.start() if gap else len(data)
        found.update(_TERM.findall(data, at, end))
        at = end
    return found


def weight(documents: int, holding: int) -> int:
    """A term's weight, from the documents with a term and those that hold this one."""
    return floor(1000 * log((2 * documents + 2) / (2 * holding + 1)))


def _forward(docs: DataFrame, id_column: str, text_column: str, known: dict[bytes, int]) -> DataFrame:
    """``id``, ``length``, ``terms`` (numbers of the wave's terms), ``counts``; a row per document with any term."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, terms, counts = [], [], [], []
            for identity, text in zip(batch.column(0), batch.column(1)):
                found = counted(text.as_py())
                if found:
                    asked = found.keys() & known.keys()
                    ids.append(identity.as_py())
                    lengths.append(found.total())
                    terms.append([known[t] for t in asked])
                    counts.append([found[t] for t in asked])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], ["id", "length", "terms", "counts"])

    chosen = only(docs, [id_column, text_column]).withColumn(id_column, F.col(f"`{id_column}`").cast("long"))
    return stored(map_arrow(chosen, work, "id long, length long, terms array<int>, counts array<long>"), "forward")


class Shard:
    """Posting lists of some documents end to end, sorted by (term, document), with range maxima over their impacts."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, owner: np.ndarray, terms: np.ndarray, counts: np.ndarray,
                 weights: np.ndarray, documents: int, total: int):
        norms = LEVEL - SHARE + (SHARE * lengths * documents) // total
        order = np.lexsort((owner, terms))
        owner, terms, counts = owner[order], terms[order], counts[order]
        self.ids, self.owner = ids, owner
        self.impacts = weights[terms] * ((SCALE * counts) // (SLOPE * counts + PIVOT * norms[owner]))
        self.names, self.starts = np.unique(terms, return_index=True)
        self.ends = np.append(self.starts[1:], len(terms))
        # Lists follow each other, so one sorted key finds a document in any of them.
        self.keys = np.repeat(np.arange(len(self.names)), self.ends - self.starts) * (len(ids) + 1) + owner
        # best[k][i] is the place of the largest impact among the 2**k postings from i on.
        best = [np.arange(len(terms), dtype=np.int32)]
        longest = int((self.ends - self.starts).max()) if len(self.names) else 0
        for k in range(max(longest, 1).bit_length() - 1):
            left, right = best[k][:len(best[k]) - (1 << k)], best[k][1 << k:]
            best.append(np.where(self.impacts[left] >= self.impacts[right], left, right))
        self.base = np.concatenate(([0], np.cumsum([len(b) for b in best])[:-1]))
        self.flat = np.concatenate(best)

    def largest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest impact of each range ``[low, high)`` of postings and its place; zero for an empty range."""
        size = high - low
        some = size > 0
        k = np.zeros(size.shape, np.int64)
        k[some] = np.frexp(size[some].astype(np.float64))[1] - 1
        at = self.base[k]
        first = self.flat[np.where(some, at + low, 0)]
        second = self.flat[np.where(some, at + high - (np.int64(1) << k), 0)]
        x, y = np.where(some, self.impacts[first], 0), np.where(some, self.impacts[second], 0)
        return np.maximum(x, y), np.where(x >= y, first, second)

    def whole(self, begin: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the given disjoint intervals and their exact scores."""
        width = end - begin
        offset = np.cumsum(width) - width
        size = (high - low).ravel()
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        postings = np.repeat(low.ravel(), size) + step
        shift = np.repeat(np.broadcast_to((offset - begin)[:, None], low.shape).ravel(), size)
        scores = np.zeros(int(width.sum()), np.int64)
        np.add.at(scores, self.owner[postings] + shift, self.impacts[postings])
        return np.repeat(begin - offset, width) + np.arange(len(scores)), scores

    def search(self, asked: np.ndarray, found: tuple[np.ndarray, np.ndarray], top: int) -> tuple[np.ndarray, np.ndarray]:
        """``found`` (scores and ids of the best so far) with this shard's documents among them."""
        lists = np.flatnonzero(np.isin(self.names, asked, assume_unique=True))
        if not len(lists):
            return found
        begin, end = np.array([0]), np.array([len(self.ids)])
        low, high = self.starts[lists][None, :], self.ends[lists][None, :]
        bound = self.largest(low, high)[0].sum(axis=1)
        while len(bound):
            least = max(1, int(found[0][-1])) if len(found[0]) >= top else 1
            open_ = bound >= least
            if not open_.any():
                break
            begin, end, low, high, bound = begin[open_], end[open_], low[open_], high[open_], bound[open_]
            chosen = np.zeros(len(bound), bool)
            chosen[np.argpartition(-bound, WIDTH - 1)[:WIDTH] if len(bound) > WIDTH else slice(None)] = True
            small = chosen & (end - begin <= SMALL)
            large = chosen & ~small
            documents, scores = self.whole(begin[small], end[small], low[small], high[small])
            parts = [(begin[~chosen], end[~chosen], low[~chosen], high[~chosen], bound[~chosen])]
            if large.any():
                b, e, lo, hi = begin[large], end[large], low[large], high[large]
                value, at = self.largest(lo, hi)
                cut = self.owner[at[np.arange(len(b)), value.argmax(axis=1)]]
                middle = np.searchsorted(self.keys, lists[None, :] * (len(self.ids) + 1) + cut[:, None])
                here = (middle < hi) & (self.owner[np.minimum(middle, len(self.owner) - 1)] == cut[:, None])
                documents = np.concatenate((documents, cut))
                scores = np.concatenate((scores, np.where(here, self.impacts[np.minimum(middle, len(self.impacts) - 1)], 0).sum(axis=1)))
                halves = (np.concatenate((b, cut + 1)), np.concatenate((cut, e)), np.concatenate((lo, middle + here)),
                          np.concatenate((middle, hi)))
                parts.append((*halves, self.largest(halves[2], halves[3])[0].sum(axis=1)))
            begin, end, low, high, bound = (np.concatenate(x) for x in zip(*parts))
            good = scores >= least
            if good.any():
                found = best_of(np.concatenate((found[0], scores[good])), np.concatenate((found[1], self.ids[documents[good]])), top)
        return found


def best_of(scores: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest scores in order, equal ones by ascending id."""
    order = np.lexsort((ids, -scores))[:top]
    return scores[order], ids[order]


def _shards(batches: Iterator[pa.RecordBatch], weights: np.ndarray, documents: int, total: int) -> Iterator[Shard]:
    """Consecutive documents cut into shards of bounded size; one document with more postings is a shard by itself."""
    waiting: list[tuple] = []
    held = rows = 0

    def flush() -> Shard:
        ids, lengths, sizes, terms, counts = (np.concatenate(x) for x in zip(*waiting))
        return Shard(ids, lengths, np.repeat(np.arange(len(ids)), sizes), terms, counts, weights, documents, total)

    for batch in batches:
        sizes = np.diff(np.asarray(batch.column(2).offsets)).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        columns = [np.asarray(batch.column(0)), np.asarray(batch.column(1)), sizes]
        terms = np.asarray(batch.column(2).flatten()).astype(np.int64)
        counts = np.asarray(batch.column(3).flatten())
        while at < len(batch):
            done = int(ends[at - 1]) if at else 0
            take = int(np.searchsorted(ends, done + SHARD_POSTINGS - held, side="right")) - at
            take = min(take, SHARD_DOCUMENTS - rows, len(batch) - at)
            if take <= 0 and not rows:
                take = 1
            if take > 0:
                until = int(ends[at + take - 1])
                waiting.append((*(c[at:at + take] for c in columns), terms[done:until], counts[done:until]))
                held, rows, at = held + until - done, rows + take, at + take
            if at < len(batch):
                yield flush()
                waiting, held, rows = [], 0, 0
    if waiting:
        yield flush()


def _searched(forward: DataFrame, items: list[tuple[int, np.ndarray]], weights: np.ndarray, documents: int, total: int,
              shards: int, top: int) -> DataFrame:
    """Each task's best documents of each item: ``item_id``, ``doc_id``, ``score``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        found = [none] * len(items)
        for shard in _shards(batches, weights, documents, total):
            found = [shard.search(terms, best, top) for (_, terms), best in zip(items, found)]
        for (item, _), (scores, ids) in zip(items, found):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(scores), item)), pa.array(ids), pa.array(scores)], ["item_id", "doc_id", "score"])

    spread = forward.where("id is not null and size(terms) > 0").repartition(shards, "id")
    return map_arrow(spread, work, "item_id long, doc_id long, score long")


def _waves(items: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple[int, Counter[bytes]]]]:
    """Items with their terms, as many at a time as the limit on terms allows."""
    wave: list[tuple[int, Counter[bytes]]] = []
    size = 0
    texts = only(items, [id_column, text_column]).dropna().groupBy(f"`{id_column}`").agg(F.collect_list(f"`{text_column}`"))
    for item, rows in texts.toLocalIterator():
        terms: Counter[bytes] = Counter()
        for text in rows:
            terms.update(counted(text))
        if wave and size + len(terms) > WAVE_TERMS:
            yield wave
            wave, size = [], 0
        wave.append((item, terms))
        size += len(terms)
    if wave:
        yield wave


def search(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", doc_text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``top`` best documents of each item: ``item_id``, ``rank`` from 1, ``doc_id``, ``score``.

    Only scores above zero count; equal ones rank by ascending id. Repeated rows are documents of their own. Null and
    empty texts have no terms: as documents they take no part in the statistics, as items they give no rows. Documents
    without an id count in the statistics but can't be returned; items without an id give none. Ids are integers.
    Rows of items with the same id are one item with the terms of all. Empty tables give no rows; texts of any
    length are read whole; other columns are ignored.
    """
    spark = docs.sparkSession
    parts: list[DataFrame] = []
    for wave in _waves(items, item_id, item_text):
        known = {t: i for i, t in enumerate(sorted(set().union(*(terms for _, terms in wave))))}
        forward = _forward(docs, doc_id, doc_text, known)
        documents, total = forward.agg(F.count("*"), F.sum("length")).first()
        if not documents:
            continue
        holding = np.zeros(len(known), np.int64)  # one number per term of the wave
        for term, n in forward.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            holding[term] = n
        weights = np.array([weight(documents, int(n)) for n in holding], np.int64)
        asked = [(item, np.sort(np.array([known[t] for t in terms], np.int64))) for item, terms in wave]
        shards = 1 + int(holding.sum()) // SHARD_POSTINGS
        parts.append(stored(_searched(forward, asked, weights, documents, total, shards, top), "found"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    ranked = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("item_id").alias(item_id), "rank", F.col("doc_id").alias(doc_id), "score")


#: The same ranking from plain SQL.
ORACLE = r"""
WITH lowered AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM lowered GROUP BY 1, 2),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY 1),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counts, corpus GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (
  SELECT item_id, c.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked a JOIN counts c ON c.term = a.term JOIN weights ON weights.term = c.term JOIN lengths l ON l.doc_id = c.doc_id, corpus
  GROUP BY 1, 2),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50"""

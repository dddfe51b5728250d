"""Substring dedup by level-wise doubling: windows repeated at one length alone are extended to twice that length.

The lengths double from a quarter of the window to the whole: 9, 18, 35 words. A window is represented at the base level by its
anchor, the base-length run with the smallest hash in it; equal windows have equal anchors at the same place, so a
window can only repeat if its anchor run is also the anchor of another window. Anchors are about one in fourteen
words, so the first level moves a fourteenth of the corpus instead of a hash per word.

1. Base length: count anchor runs; only anchors whose run repeats survive.
2. Twice that: an anchor survives if its run extended to the right or to the left, whichever its windows contain,
   repeats among the survivors.
3. Full length: all windows of one anchor form a stretch. Stretches that repeat whole are settled as classes, one
   row per class. Where the stretches of an anchor differ, one representative of each class emits its windows,
   weighted by whether the class has copies, and window hashes of 128 bits decide.

Every level counts with map-side aggregation and joins the few repeated keys back, which Spark splits where a key is
hot; no group is gathered. Texts are shuffled once, for the join with their marks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import map_arrow, stored
from .words import WORD_BASES, Windows, Words, chunks, sliding_argmin

WINDOW = 35

_MEMBERS = "run long, right_run long, left_run long, stretch long, doc_key long, begin int, anchor int, n int"
_WINDOWS = "doc_key long, begin int, one long, two long, weight int"


def lengths(window: int) -> list[int]:
    """A quarter of the window, half of it and the whole, rounding up. With a quarter as base, any window contains
    its anchor's extension to one side at least."""
    half = (window + 1) // 2
    return [(half + 1) // 2, half, window]


def _texts(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Row offset and texts of consecutive slices of a batch."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for a, b in chunks(sizes):
        yield a, [(t or "").encode("utf-8", "surrogatepass") for t in column.slice(a, b - a).to_pylist()]


def _batch(schema: str, columns: list[np.ndarray]) -> pa.RecordBatch:
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    kinds = {"long": np.int64, "int": np.int32}
    return pa.RecordBatch.from_arrays(
        [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(kinds[k])) for c, (_, k) in zip(columns, fields)],
        [name for name, _ in fields])


def _stretches(words: Words, window: int, base: int):
    """Anchor, first window and number of windows of each stretch: a maximal run of windows of one text that share
    their anchor. Word indexes of the slice, and the hash function they come from."""
    hashes = Windows(words.hashes(), WORD_BASES[0])
    n = len(words.begin)
    runs = np.arange(max(0, n - base + 1))
    run_hash = hashes.of(runs, runs + base)
    anchors = sliding_argmin(run_hash, window - base + 1)
    starts = np.flatnonzero(words.left[:len(anchors)] >= window)
    anchors = anchors[starts]
    if not len(starts):
        return starts, starts, starts, hashes, run_hash
    change = np.flatnonzero(np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1))))
    counts = np.diff(np.concatenate((change, [len(starts)])))
    return anchors[change], starts[change], counts, hashes, run_hash


def _members(window: int, base: int, only_runs: bool):
    """Rows for the anchors of each text; ``only_runs`` leaves all but the anchor run's hash away."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(0))
            for at, texts in _texts(batch.column(1)):
                words = Words(texts)
                anchor, begin, count, hashes, run_hash = _stretches(words, window, base)
                run = run_hash[anchor]
                if only_runs:
                    # Repeats within the slice are counted here, before anything is shuffled.
                    run, n = np.unique(run, return_counts=True)
                    yield _batch("run long, n int", [run, n])
                    continue
                doc = np.searchsorted(words.first, begin, side="right") - 1
                most = anchor - begin  # words before the anchor in the stretch's first window, and in its last
                least = most - (count - 1)
                reach, zero = window - 2 * base, np.uint64(0)
                right = np.where(least <= reach, hashes.of(anchor, np.minimum(anchor + 2 * base, len(words.begin))), zero)
                left = np.where(most > reach, hashes.of(np.maximum(anchor - base, 0), anchor + base), zero)
                stretch = hashes.of(begin, begin + count - 1 + window) * np.uint64(2 * window + 1) + most.astype(np.uint64)
                yield _batch(_MEMBERS, [run, right, left, stretch, keys[at + doc], begin - words.first[doc],
                                        anchor - words.first[doc], count])
    return work


def _repeated(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys of several rows. Stored, so that a join with them deals out both sides anew: on top of the aggregate's own
    exchange Spark could not split a hot key."""
    return stored(rows.groupBy(*key).agg(F.count("*").alias("n_same")).where("n_same > 1").select(*key), "repeated")


def _alive(keyed: DataFrame, window: int, base: int) -> DataFrame:
    """Anchors that survive the base length and twice the base length."""
    counted = map_arrow(keyed, _members(window, base, True), "run long, n int")
    runs = stored(counted.groupBy("run").agg(F.sum("n").alias("n_same")).where("n_same > 1").select("run"), "runs")
    members = map_arrow(keyed, _members(window, base, False), _MEMBERS)
    alive = stored(members.join(runs, "run"), "anchors")
    right = _repeated(alive.where("right_run <> 0"), ["run", "right_run"]).withColumn("right_same", F.lit(True))
    left = _repeated(alive.where("left_run <> 0"), ["run", "left_run"]).withColumn("left_same", F.lit(True))
    kept = alive.join(right, ["run", "right_run"], "left").join(left, ["run", "left_run"], "left")
    return kept.where("right_same OR left_same").drop("right_same", "left_same", "right_run", "left_run")


def _window_rows(window: int):
    """The windows of the stretches a row lists (``begin``, ``n``, ``weight`` each), hashed to 128 bits."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(0))
            listed = batch.column(2)
            for at, texts in _texts(batch.column(1)):
                words = Words(texts)
                plain = words.hashes()
                one, two = (Windows(plain, b) for b in WORD_BASES)
                part = listed.slice(at, len(texts))
                begin, n, weight = (np.asarray(x, dtype=np.int64) for x in part.flatten().flatten())
                row = np.repeat(np.arange(len(texts)), np.diff(np.asarray(part.offsets)))
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(begin + words.first[row], n) + step
                doc = np.repeat(row, n)
                yield _batch(_WINDOWS, [keys[at + doc], start - words.first[doc], one.of(start, start + window),
                                        two.of(start, start + window), np.repeat(weight, n)])
    return work


def repeated_windows(keyed: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_key, begin, n)``: the n windows of a text from word ``begin`` on occur elsewhere.

    ``keyed`` has the columns ``doc_key`` (long, equal only for rows of equal text) and ``text``.
    """
    base = lengths(window)[0]
    alive = stored(_alive(keyed, window, base), "alive")
    # One row per class of equal stretches, and one per anchor run that has several classes.
    classes = stored(alive.groupBy("run", "stretch").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc_key", "begin", "n")).alias("first")), "classes")
    mixed = _repeated(classes, ["run"])
    whole = classes.where("copies > 1").select("run", "stretch")
    settled = alive.join(whole, ["run", "stretch"]).select("doc_key", "begin", "n")
    open_ = classes.join(mixed, "run").select(
        F.col("first.doc_key").alias("doc_key"),
        F.struct(F.col("first.begin").alias("begin"), F.col("first.n").alias("n"),
                 F.when(F.col("copies") > 1, 2).otherwise(1).alias("weight")).alias("item"))
    # A text has at most one stretch per word, so its list is bounded by the text itself.
    lists = open_.groupBy("doc_key").agg(F.collect_list("item").alias("items"))
    texts = keyed.select("doc_key", "text").join(lists, "doc_key")
    rows = stored(map_arrow(texts, _window_rows(window), _WINDOWS), "windows")
    # Rows of equal text share their key and list, and each emits: they count as the copies they are.
    same = stored(rows.groupBy("one", "two").agg(F.sum("weight").alias("n_same")).where("n_same > 1").select("one", "two"), "same")
    single = rows.where("weight = 1").join(same, ["one", "two"]).select("doc_key", "begin", F.lit(1).alias("n"))
    return settled.union(single)


def _cut(window: int, names: list[str]):
    """Text and marks of a row to its counts and what is kept of it."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = batch.column(0), batch.column(1)
            words_n, removed_n, kept_text = [], [], []
            for text, spans in zip(texts, marks):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                n = len(words)
                if spans.is_valid and n:
                    edge = np.zeros(n + 1, np.int64)
                    begin, count = (np.asarray(x, dtype=np.int64) for x in spans.values.flatten())
                    np.add.at(edge, begin, 1)
                    np.add.at(edge, begin + count - 1 + window, -1)
                    keep = np.cumsum(edge[:n]) == 0
                    kept = [w for w, k in zip(words, keep.tolist()) if k]
                else:
                    kept = words
                words_n.append(n)
                removed_n.append(n - len(kept))
                kept_text.append(b" ".join(kept).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array(words_n, pa.int64()), pa.array(removed_n, pa.int64()), pa.array(kept_text, pa.string())],
                [*names, "n_words", "n_removed", "kept_text"])
    return work


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text",
                   carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: ``id_column``, the columns ``carry`` as they are, ``n_words``, ``n_removed``,
    ``kept_text`` (kept words joined by a space).

    A word goes if a window of ``window`` words that covers it also starts anywhere else, in the same text or
    another; all occurrences go. Null, empty and short texts have no windows and keep their words (null: none).
    Repeated rows are copies of each other, so whole texts of at least ``window`` words go. Ids may be null or
    repeated: rows are told apart by id and text together. An empty table gives no rows; other columns are ignored.
    """
    if window < 4:
        raise ValueError("a window has at least 4 words")
    names = [id_column, *carry]
    key = F.xxhash64(f"`{id_column}`", F.lit("/"), f"`{text_column}`")
    found = repeated_windows(docs.select(key.alias("doc_key"), F.col(f"`{text_column}`").alias("text")), window)
    marks = found.distinct().groupBy("doc_key").agg(F.collect_list(F.struct("begin", "n")).alias("marks"))
    # Carried columns go by place, so none of their names can clash.
    carried = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(names)]
    keyed = docs.select(key.alias("doc_key"), F.col(f"`{text_column}`").alias("text"), *carried)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return map_arrow(keyed.join(marks, "doc_key", "left").select("text", "marks", *[f"_{i}" for i in range(len(names))]), 
        _cut(window, names), f"{kinds}, n_words long, n_removed long, kept_text string")

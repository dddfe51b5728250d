"""Language identification by segmentation-marginalised unigrams over a fixed public vocabulary.

Each language has a probability per piece of the vocabulary. A text's likelihood sums over all ways to cut it into
pieces: pieces don't cross words, so it is the product of its words' likelihoods, each from a forward pass over the
word. Training is expectation maximisation on the word counts of labelled rows: a forward-backward pass gives the
expected count of every piece. Words are computed once per worker while it keeps them, many words of one length at a
time.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared import held, map_arrow, only, stored
from .tokens import vocabulary_path
from .words import mix

VOCABULARY = "piece_bpe_32k.model"
TRAIN_ROWS = 2000  # labelled rows a language learns from, about: the bound of the training sample
ROUNDS = 2
PRIOR_COUNT = 0.05  # of every piece in every language
WORD_START = "▁"
LONGEST_WORD = 48  # longer words are cut, which with growth() keeps products of probabilities in range
KEPT_WORDS = 250_000
TEXTS = 500  # scored together
WORD_BATCHES = 20  # batches of training words counted together
UNKNOWN = 0  # a character that is no piece
TABLE_SHIFT = 43
TABLE = 1 << (64 - TABLE_SHIFT)
_BASE = 0xD1342543DE82EF95
_POWER = np.array([pow(_BASE, i, 1 << 64) for i in range(256)], np.uint64)
_INVERSE = np.array([pow(_BASE, -i, 1 << 64) for i in range(256)], np.uint64)
_LETTER = re.compile(r"[^\W\d_]")


def words_of(text: str) -> list[str]:
    """Lower-case words, each with the vocabulary's mark of a word's start; very long ones in parts."""
    out = [WORD_START + w for w in text.lower().split()]
    if max(map(len, out), default=0) > LONGEST_WORD:
        out = [w[i:i + LONGEST_WORD] for w in out for i in range(0, len(w), LONGEST_WORD)]
    return out


def growth(probabilities: np.ndarray) -> np.ndarray:
    """Per language the power of two, about one over the root of its rarest piece's probability, that a pass multiplies
    in for every character: products over a word then stay within that probability to the power of plus or minus 24,
    in range down to 1e-12, where plain products underflow at 1e-7."""
    least = np.where(probabilities > 0, probabilities, 1.0).min(axis=0)
    return np.exp2(np.round(-np.log2(least) / 2))


class Pieces:
    """The vocabulary: an index per piece, 0 for an unknown character, ``nothing`` for what is no piece."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.index = {name: i + 1 for i, name in enumerate(names)}
        self.longest = max(map(len, names))
        self.nothing = len(names) + 1
        self._table()

    def _table(self) -> None:
        """An open-addressing table from a piece's 64-bit hash to its index, for lookups of many words at once."""
        self._keys, self._values = np.zeros(TABLE, np.uint64), np.full(TABLE, self.nothing, np.int32)
        self._probes = 1
        everything = list(self.index)
        for length, at in self.by_length(everything).items():
            names = [everything[i] for i in at]
            for name, key in zip(names, self._hashes(self._sums(names), 0, length).tolist()):
                slot, probe = key >> TABLE_SHIFT, 1
                while self._keys[slot]:
                    slot, probe = (slot + 1) % TABLE, probe + 1
                self._keys[slot], self._values[slot] = key, self.index[name]
                self._probes = max(self._probes, probe)

    @staticmethod
    def _sums(words: list[str]) -> np.ndarray:
        """Prefix sums of a polynomial over the characters: a row per position, a column per word of one length."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1).T
        sums = np.zeros((len(codes) + 1, len(words)), np.uint64)
        np.cumsum(codes.astype(np.uint64) * _POWER[:len(codes), None], axis=0, out=sums[1:])
        return sums

    @staticmethod
    def _hashes(sums: np.ndarray, a: int, b: int) -> np.ndarray:
        return mix((sums[b] - sums[a]) * _INVERSE[a] + np.uint64(b - a)) | np.uint64(1)

    def lattice(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
        """For words of one length: begin, end and each word's piece there, by ascending end."""
        sums = self._sums(words)
        for b in range(1, len(words[0]) + 1):
            for a in range(max(0, b - self.longest), b):
                keys = self._hashes(sums, a, b)
                slots = (keys >> np.uint64(TABLE_SHIFT)).astype(np.int64)
                found = np.where(self._keys[slots] == keys, self._values[slots], self.nothing)
                for probe in range(1, self._probes):
                    here = (slots + probe) % TABLE
                    hit = self._keys[here] == keys
                    if hit.any():
                        found[hit] = self._values[here[hit]]
                if a == b - 1:
                    found[found == self.nothing] = UNKNOWN
                elif (found == self.nothing).all():
                    continue
                yield a, b, found

    @staticmethod
    def by_length(words: list[str]) -> dict[int, list[int]]:
        groups: dict[int, list[int]] = defaultdict(list)
        for i, word in enumerate(words):
            groups[len(word)].append(i)
        return groups

    def log_likelihoods(self, words: list[str], probabilities: np.ndarray) -> np.ndarray:
        """A row per word, a column per language: the log of the sum over all segmentations."""
        out, grown = np.empty((len(words), probabilities.shape[1])), growth(probabilities)
        for length, at in self.by_length(words).items():
            forward = np.zeros((length + 1, len(at), probabilities.shape[1]))
            forward[0] = 1
            for a, b, found in self.lattice([words[i] for i in at]):
                forward[b] += forward[a] * probabilities[found] * grown ** (b - a)
            out[at] = np.log(forward[length]) - length * np.log(grown)
        return out

    def expected(self, words: list[str], counts: np.ndarray, probability: np.ndarray) -> np.ndarray:
        """Expected count of each piece in the words, given one language's probabilities."""
        total, grown = np.zeros(self.nothing + 1), growth(probability)
        for length, at in self.by_length(words).items():
            steps = list(self.lattice([words[i] for i in at]))
            forward, backward = np.zeros((length + 1, len(at))), np.zeros((length + 1, len(at)))
            forward[0], backward[length] = 1, 1
            for a, b, found in steps:
                forward[b] += forward[a] * probability[found] * grown ** (b - a)
            for a, b, found in reversed(sorted(steps, key=lambda s: s[0])):
                backward[a] += backward[b] * probability[found] * grown ** (b - a)
            share = counts[at] / forward[length]
            for a, b, found in steps:
                np.add.at(total, found, forward[a] * probability[found] * grown ** (b - a) * backward[b] * share)
        total[self.nothing] = 0
        return total


def pieces(path: str) -> Pieces:
    """This worker's copy of the vocabulary."""
    return held("pieces", path, Pieces)


@dataclass(frozen=True)
class Model:
    """Languages, their log shares of the training rows, and a column of piece probabilities each."""

    path: str
    languages: tuple[str, ...]
    log_shares: np.ndarray
    probabilities: np.ndarray


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that never train: crc32 of the id as text leaves 2 modulo 4. Null ids may train."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
        vocabulary: str | None = None, train_rows: int = TRAIN_ROWS, rounds: int = ROUNDS) -> Model:
    """Learn from rows that are not held out and have a text and a language, a sample of about ``train_rows`` per
    language chosen by hash. The driver gets one row per language and, each round, the expected counts: vocabulary
    times languages, whatever the corpus."""
    path = vocabulary or vocabulary_path(VOCABULARY)
    known = only(docs, [id_column, text_column, lang_column]).where(
        ~held_out(id_column) & F.col(f"`{lang_column}`").isNotNull() & F.col(f"`{text_column}`").isNotNull())
    totals = sorted(tuple(r) for r in known.groupBy(F.col(f"`{lang_column}`")).count().collect())
    languages = tuple(lang for lang, _ in totals)
    index = {lang: i for i, lang in enumerate(languages)}
    vocabulary_pieces = pieces(path)
    if not languages:
        return Model(path, (), np.zeros(0), np.zeros((vocabulary_pieces.nothing + 1, 0)))
    draw = F.pmod(F.xxhash64(F.lit("train"), f"`{id_column}`", F.hash(f"`{text_column}`")), F.lit(1_000_000))
    limits = docs.sparkSession.createDataFrame(
        [(lang, i, min(1_000_000, -(-train_rows * 1_000_000 // n))) for (lang, n), i in zip(totals, range(len(totals)))],
        "label string, lang_no int, upto long")
    sample = known.join(F.broadcast(limits), F.col(f"`{lang_column}`").cast("string") == F.col("label")).where(draw < F.col("upto"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, Counter] = defaultdict(Counter)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen[lang].update(words_of(text.as_py()))
            for lang, words in seen.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(words), lang, np.int32)), pa.array(list(words)), pa.array(list(words.values()), pa.int64())],
                    ["lang_no", "word", "n"])

    counted = map_arrow(sample.select("lang_no", F.col(f"`{text_column}`").alias("text")), 
        count, "lang_no int, word string, n long")
    words = stored(counted.groupBy("lang_no", "word").agg(F.sum("n").alias("n")), "words")

    size = vocabulary_pieces.nothing + 1
    probabilities = np.full((size, len(languages)), 1.0 / size)
    probabilities[vocabulary_pieces.nothing] = 0
    for _ in range(rounds):
        sent = docs.sparkSession.sparkContext.broadcast(probabilities)

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own, held = pieces(path), []

            def out() -> Iterator[pa.RecordBatch]:
                rows = pa.Table.from_batches(held).combine_chunks()
                held.clear()
                lang, word, n = np.asarray(rows.column(0)), rows.column(1).to_pylist(), np.asarray(rows.column(2)).astype(float)
                for no in np.unique(lang):
                    at = np.flatnonzero(lang == no)
                    total = own.expected([word[i] for i in at], n[at], sent.value[:, no])
                    piece = np.flatnonzero(total)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(piece), no, np.int32)), pa.array(piece.astype(np.int32)), pa.array(total[piece])],
                        ["lang_no", "piece", "expected"])

            for batch in batches:
                held.append(batch)
                if len(held) >= WORD_BATCHES:  # many words of one length at a time
                    yield from out()
            if held:
                yield from out()

        sums = map_arrow(words, expect, "lang_no int, piece int, expected double").groupBy("lang_no", "piece").agg(
            F.sum("expected").alias("expected")).collect()
        probabilities = np.full((size, len(languages)), PRIOR_COUNT)
        for no, piece, value in sums:
            probabilities[piece, no] += value
        probabilities[vocabulary_pieces.nothing] = 0
        probabilities /= probabilities.sum(axis=0)
    shares = np.array([n for _, n in totals], float)
    return Model(path, tuple(map(str, languages)), np.log(shares / shares.sum()), probabilities)


class Scorer:
    """A worker's scorer: keeps the likelihoods of the words it met, in two generations."""

    def __init__(self, model: Model):
        self.model, self.pieces = model, pieces(model.path)
        self.kept: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.languages)))
        self.used = 0

    def _learn(self, words: set[str]) -> None:
        missing = [w for w in words if w not in self.kept]
        if not missing:
            return
        if len(self.kept) > KEPT_WORDS:
            again = [w for w in words if w in self.kept]
            rows = self.rows[[self.kept[w] for w in again]]
            self.kept, self.used = {w: i for i, w in enumerate(again)}, len(again)
            self.rows[:self.used] = rows
        need = self.used + len(missing)
        if need > len(self.rows):
            grown = np.zeros((max(need, 2 * len(self.rows)), self.rows.shape[1]))
            grown[:self.used] = self.rows[:self.used]
            self.rows = grown
        self.rows[self.used:need] = self.pieces.log_likelihoods(missing, self.model.probabilities)
        self.kept.update(zip(missing, range(self.used, need)))
        self.used = need

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = [("und", 0.0)] * len(texts)
        if not self.model.languages:
            return out
        lists = {i: words_of(t) for i, t in enumerate(texts) if t and _LETTER.search(t)}
        self._learn({w for words in lists.values() for w in words})
        for i, words in lists.items():
            total = self.rows[list(map(self.kept.__getitem__, words))].sum(axis=0) + self.model.log_shares
            best = int(np.argmax(total))
            out[i] = (self.model.languages[best], float(1 / np.exp(total - total[best]).sum()))
        return out


def predict(docs: DataFrame, model: Model, text_column: str = "text", keep: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """The columns ``keep`` of ``docs``, which include ``text_column``, with ``lang_pred`` and ``score``, the
    posterior of that language. Null texts and texts without a letter are ``und`` with score 0; ties go to the language
    first by code point. Every whole text is scored. Repeated rows are scored alike; other columns are ignored."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    chosen = only(docs, keep)
    at_text = list(keep).index(text_column)
    names = [*keep, "lang_pred", "score"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            scored: list[tuple[str, float]] = []
            for at in range(0, batch.num_rows, TEXTS):
                scored += scorer.score(batch.column(at_text).slice(at, TEXTS).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([s[0] for s in scored], pa.string()), pa.array([s[1] for s in scored], pa.float64())], names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema)
    return map_arrow(chosen, work, f"{kinds}, lang_pred string, score double")


def identify(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
             **options: object) -> DataFrame:
    """Fit on the labelled rows and predict every row: ``id_column``, ``text_column``, ``lang_pred``, ``score``,
    ``held_out``. An empty table, or one without labelled rows, gives ``und`` throughout."""
    model = fit(docs, id_column, text_column, lang_column, **options)
    return predict(docs, model, text_column, (id_column, text_column)).withColumn("held_out", held_out(id_column))



"""Packing by vector bin packing: pieces of tokenised examples fill sequences under three limits at once, on tokens,
segments and loss-bearing tokens.

Each partition packs its own rows as they stream by; nothing is shuffled. An example is first cut into pieces that
fill a sequence alone; the rest of it waits in a pool of bounded size. A sequence opens with the pool's largest piece
and then takes, again and again, the piece that fits and has the largest dot product of its demand with the room
left, both as fractions of the limits: the scarcest resource weighs most. A gap that no waiting piece fits is filled
by cutting one, unless the gap is too small to be worth a piece. What is left at the end of a partition is cut into
sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .shared import map_arrow, only
from .tokens import encoder, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
POOL = 1024  # pieces that wait at most; each is shorter than a sequence
LEAST_CUT = 32  # a smaller gap is padded
ROWS_OUT = 20_000


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = 1024
    segments: int = 128
    loss: int = 1024

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("limits are positive")


def padded_length(length: int, limits: Limits = Limits()) -> int:
    """What a sequence occupies: itself at a power of two, else the whole token limit."""
    return length if length & (length - 1) == 0 else limits.tokens


@dataclass
class Piece:
    """Tokens ``[start, start + length)`` of a document; ``loss_from`` is where its loss-bearing tokens begin."""

    doc: object
    start: int
    ids: bytes | memoryview
    doc_tokens: int
    loss_from: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    @property
    def loss(self) -> int:
        return max(0, self.start + self.length - max(self.start, self.loss_from))

    def fitting(self, tokens: int, loss: int) -> int:
        """The longest beginning of the piece within both limits."""
        return min(self.length, tokens, max(0, self.loss_from - self.start) + loss)

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.start, self.ids[:4 * at], self.doc_tokens, self.loss_from),
                Piece(self.doc, self.start + at, self.ids[4 * at:], self.doc_tokens, self.loss_from))


class Packer:
    """Packs the pieces of one partition; ``add`` and ``finish`` yield complete sequences as lists of pieces."""

    def __init__(self, limits: Limits, pool: int = POOL):
        self.limits, self.pool = limits, pool
        self.waiting: list[Piece] = []

    def add(self, doc: object, ids: bytes, loss_from: int = 0) -> Iterator[list[Piece]]:
        rest = Piece(doc, 0, memoryview(ids), len(ids) // 4, loss_from)  # cutting a view copies nothing
        while rest.length:
            at = rest.fitting(self.limits.tokens, self.limits.loss)
            piece, rest = rest.cut(at)
            if piece.length == self.limits.tokens:
                yield [piece]
            else:
                piece.ids = bytes(piece.ids)  # a waiting piece must not hold its whole document
                self.waiting.append(piece)
        if len(self.waiting) >= self.pool:
            yield from self._pack(self.pool // 2)

    def finish(self) -> Iterator[list[Piece]]:
        yield from self._pack(0)

    def _pack(self, leave: int) -> Iterator[list[Piece]]:
        """Close sequences until at most ``leave`` pieces wait."""
        most = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
        pieces = self.waiting
        demand = np.array([(p.length, 1, p.loss) for p in pieces], float).reshape(-1, 3)
        live = np.ones(len(pieces), bool)
        n_live = len(pieces)
        while n_live > leave:
            room, chosen = most.copy(), []
            while True:
                fits = live & (demand <= room).all(axis=1)
                if not fits.any():
                    break
                score = demand[:, 0] if not chosen else (demand / most) @ (room / most)
                pick = int(np.argmax(np.where(fits, score, -1.0)))
                chosen.append(pieces[pick])
                room -= demand[pick]
                live[pick] = False
                n_live -= 1
            gap = int(room[0])
            if gap >= LEAST_CUT and room[1] >= 1 and n_live:
                # No waiting piece fits whole: the one that is longest gives its beginning.
                pick = int(np.argmax(np.where(live, demand[:, 0], -1.0)))
                at = pieces[pick].fitting(gap, int(room[2]))
                if 0 < at < pieces[pick].length:
                    head, pieces[pick] = pieces[pick].cut(at)
                    demand[pick] = (pieces[pick].length, 1, pieces[pick].loss)
                    chosen.append(head)
                    gap -= at
            if gap and not n_live:
                yield from self._powers_of_two(chosen)
            else:
                yield chosen
        self.waiting = [p for p, alive in zip(pieces, live.tolist()) if alive]

    @staticmethod
    def _powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
        total = sum(p.length for p in pieces)
        for bit in range(total.bit_length() - 1, -1, -1):
            size, out = total & (1 << bit), []
            while size:
                if pieces[0].length > size:
                    head, pieces[0] = pieces[0].cut(size)
                else:
                    head = pieces.pop(0)
                out.append(head)
                size -= head.length
            if out:
                yield out


def _rows(id_field: pa.Field, limits: Limits, path: str, end_id: int, with_ids: bool):
    end = int(end_id).to_bytes(4, "little")
    names = [id_field.name, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]

    def flush(rows: list[tuple], ids: list[bytes]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        arrays = [pa.array(columns[0], id_field.type)] + [pa.array(c, pa.int64()) for c in columns[1:]]
        if with_ids:
            ends = np.cumsum([0] + [len(b) // 4 for b in ids], dtype=np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4"))))
        return pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, rows, ids = encoder(path).encode, Packer(limits), [], []
        sequence = TaskContext.get().partitionId() << 40

        def take(sequences: Iterator[list[Piece]]) -> None:
            nonlocal sequence
            for pieces in sequences:
                offset = 0
                for p in pieces:
                    rows.append((p.doc, p.start, p.length, zlib.crc32(p.ids), p.doc_tokens, sequence, offset, p.loss))
                    if with_ids:
                        ids.append(bytes(p.ids))
                    offset += p.length
                sequence += 1

        for batch in batches:
            prompts = batch.column(2) if batch.num_columns > 2 else [None] * batch.num_rows
            for doc, text, prompt in zip(batch.column(0), batch.column(1), prompts):
                before = encode(prompt.as_py()) if prompt is not None else b""
                take(packer.add(doc.as_py(), before + encode(text.as_py()) + end, len(before) // 4))
                if len(rows) >= ROWS_OUT:
                    yield flush(rows, ids)
                    rows.clear(), ids.clear()
        take(packer.finish())
        if rows:
            yield flush(rows, ids)
    return work


def pack(docs: DataFrame, limits: Limits = Limits(), id_column: str = "doc_id", text_column: str = "text",
         prompt_column: str | None = None, vocabulary: str | None = None, end_id: int = END_ID,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: ``id_column``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset``, ``loss_tokens`` and, if asked for, ``ids``.

    An example's ids are those of its prompt (if a prompt column is named; these bear no loss), of its text, and
    ``end_id``. Null and empty texts give the end id alone. Ids may be null or repeated: every input row is an
    example of its own. Sequence ids are unique and grow by partition; offsets in a sequence have no gaps. An empty
    table gives no rows; other columns are ignored.
    """
    path = vocabulary or vocabulary_path(VOCABULARY)
    chosen = only(docs, [id_column, text_column] + ([prompt_column] if prompt_column else []))
    kind = chosen.schema[id_column].dataType
    field = pa.field(id_column, pa.string() if kind.simpleString() == "string" else pa.int64())
    if field.type == pa.int64():
        chosen = chosen.withColumn(id_column, F.col(f"`{id_column}`").cast("long"))
        kind_name = "long"
    else:
        kind_name = "string"
    schema = (f"`{id_column}` {kind_name}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long, loss_tokens long" + (", ids array<int>" if with_ids else ""))
    return map_arrow(chosen, _rows(field, limits, path, end_id, with_ids), schema)

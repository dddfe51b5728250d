"""Vectorised word and window hashing of whole texts.

Words are maximal runs of bytes outside 0x20 and 0x09-0x0D of the UTF-8 text, which is the pattern
``[^\\x20\\x09-\\x0D]+``. A word's hash is a polynomial over its bytes, a window's hash a polynomial over its words'
hashes, both from prefix sums modulo 2**64 and passed through a finaliser, so every window of a batch of texts costs
a few array operations whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
CHUNK_BYTES = 1 << 19  # texts are hashed together up to about this size, which bounds the arrays

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n; kept between calls while texts are of usual size."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < n:
        size = 1 << n.bit_length()
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            pair.append(np.cumprod(steps, dtype=np.uint64))
        known = (pair[0], pair[1])
        if size <= 4 * CHUNK_BYTES:
            _POWERS[base] = known
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of several texts laid end to end.

    ``begin``/``end`` are byte positions, ``first`` the index of each text's first word (one entry more than texts),
    ``left`` how many words of its text follow from each word on, itself included.
    """

    def __init__(self, texts: list[bytes]):
        self.data = b"".join(texts)
        raw = np.frombuffer(self.data, np.uint8)
        cuts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))))
        word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
        opens = word.copy()
        opens[1:] &= ~word[:-1]
        closes = word.copy()
        closes[:-1] &= ~word[1:]
        inner = cuts[1:-1]
        inner = inner[inner < len(raw)]
        opens[inner] |= word[inner]
        inner = inner[inner > 0]
        closes[inner - 1] |= word[inner - 1]
        self.begin = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.begin, cuts)
        self.counts = np.diff(self.first)
        self.left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.begin))
        self._raw = raw

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        power, inverse = _powers(BYTE_BASE, len(self._raw) + 1)
        sums = np.zeros(len(self._raw) + 1, np.uint64)
        np.cumsum((self._raw.astype(np.uint64) + np.uint64(1)) * power[:len(self._raw)], out=sums[1:])
        return mix((sums[self.end] - sums[self.begin]) * inverse[self.begin] + (self.end - self.begin).astype(np.uint64))


class Windows:
    """Hashes of word sequences ``[start, stop)`` under one of two independent bases."""

    def __init__(self, words: np.ndarray, base: int):
        self._inverse = _powers(base, len(words) + 1)[1]
        self._sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * _powers(base, len(words) + 1)[0][:len(words)], out=self._sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self._sums[stop] - self._sums[start]) * self._inverse[start] + (stop - start).astype(np.uint64))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest value of ``values[i:i + width]`` for each i, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        a, b = best[:-step], best[step:]
        best = np.where(values[b] < values[a], b, a)
        span += step
    return best[:n]


def chunks(sizes: list[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose sizes add up to about ``limit``; one large item is a range of its own."""
    at, total = 0, 0
    for i, size in enumerate(sizes):
        if i > at and total + size > limit:
            yield at, i
            at, total = i, 0
        total += size
    if sizes:
        yield at, len(sizes)

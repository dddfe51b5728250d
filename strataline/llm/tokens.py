"""Token ids of whole texts by a public vocabulary of the ``tokenizers`` library, fast enough for a whole corpus.

A word-level split is the first thing both vocabularies do, and ids never cross it. Where a text has only characters
whose class is beyond doubt (ASCII, Latin letters and signs, common punctuation), it is split here and each distinct
piece is encoded once by the library and kept; any other text goes through the library whole, and so does a text
with an added token of the vocabulary (such as ``<|endoftext|>``) where that is to be one id. Both ways give the library's ids.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable

from .shared import held

KEPT_PIECES = 300_000  # pieces of a generation; a worker keeps two, so common pieces are never encoded again
LONGEST_KEPT = 64  # characters; longer pieces hardly come again

_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-įĲ-ɏ"
_NUMBERS = "0-9²³¹¼½¾"
_SAFE_END = 0x20AD  # beyond the last of them
_SAFE = re.compile(f"[\\t\\n\\r\\x20-\\x7E¡-¬®-įĲ-ɏ‐-‧‰-⁞€]*")
# The split patterns of the two vocabularies, over the characters above.
_BYTE_LEVEL = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\\s{_LETTERS}{_NUMBERS}]+|\\s+(?!\\S)|\\s+")
_WORD_LEVEL = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")


def vocabulary_path(name: str) -> str:
    """Where the installed public vocabulary files keep ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Kept(dict):
    """Pieces and their ids; a piece that is not there is looked for in the generation before, or else encoded."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self._encode, self._older = encode, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self._older.get(piece)
        if ids is None:
            ids = self._encode(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= KEPT_PIECES:
                self._older = self.copy()
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Texts to the little-endian unsigned 32-bit bytes of their ids. An added token that stands in a text is taken as
    ordinary text, or, without ``added_as_text``, as the library takes it by default: as one id."""

    def __init__(self, path: str, added_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = added_as_text
        # A piece is normalised and split already: only the bytes and the model's merges are left to do.
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        safe = [c for c in map(chr, range(_SAFE_END)) if _SAFE.fullmatch(c)]
        self._bytes = {ord(c): byte_level.pre_tokenize_str(c)[0][0] for c in safe}
        self._merge = self._library.model.tokenize
        self._lower = self._library.normalizer is not None
        # Where an added token may stand; a match by letters of either case, since some are found after lower-casing.
        added = [] if added_as_text else [t.content for t in self._library.get_added_tokens_decoder().values() if t.content]
        self._added = re.compile("|".join(map(re.escape, added)) if added else r"(?!)", re.I).search
        self._split = (_WORD_LEVEL if self._lower else _BYTE_LEVEL).findall
        self._kept = _Kept(self._piece)

    def _piece(self, piece: str) -> bytes:
        return _packed([token.id for token in self._merge(piece.translate(self._bytes))])

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        # Lower-casing can lead out of the safe characters, as from Ə to ə.
        split = text.lower() if self._lower else text
        if not _SAFE.fullmatch(text) or (self._lower and not _SAFE.fullmatch(split)) or self._added(text):
            return _packed(self._library.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        return b"".join(map(self._kept.__getitem__, self._split(split)))


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file, with the library's default ids; workers serve many tasks."""
    return held("encoder", path, lambda p: Encoder(p, added_as_text=False))

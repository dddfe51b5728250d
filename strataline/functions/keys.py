"""Hash keys. Nulls become empty text first, so a value cannot move between
columns without changing the hash."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import ColumnOrName, col

SEPARATOR = "||"


def narrow_id(c: ColumnOrName) -> Column:
    """A record id as bytes for shuffles: a hash in hex takes half its width, any other text stays; ``wide_id`` gives
    the text again. Hashes sort as their text does."""
    text = col(c)
    bits = F.unhex(text)
    return F.when(F.coalesce(F.lower(F.hex(bits)) == text, F.lit(False)), F.concat(F.lit(b"\x01"), bits)).otherwise(
        F.concat(F.lit(b"\x00"), F.encode(text, "utf-8")))


def wide_id(c: ColumnOrName) -> Column:
    data = col(c)
    rest = F.substring(data, 2, 2**31 - 1)
    return F.when(F.substring(data, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(F.decode(rest, "utf-8"))


def hash_key(*columns: ColumnOrName) -> Column:
    """sha-256 hex of one or more columns as text, joined by ``||``."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(parts[0] if len(parts) == 1 else F.concat_ws(SEPARATOR, *parts), 256)

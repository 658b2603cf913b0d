"""Words of whole texts as bytes: digits, letters a-z and everything beyond ASCII, A-Z lower-cased."""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import masked, place_of, ship

# UTF-8 bytes of characters beyond ASCII are all >= 0x80, so a table of bytes tells words from the rest.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # the same words, in a lower-cased text
SLICE = 4 << 20  # bytes split at a time


def slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of ``text`` in order, a bounded slice of it at a time."""
    flat = text.translate(FOLD)
    start = 0
    while start < len(flat):
        end = flat.find(b" ", start + SLICE)
        end = len(flat) if end < 0 else end
        found = flat[start:end].split()
        if found:
            yield found
        start = end


def folded(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def byte_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id`` and ``_text`` (UTF-8 bytes; NULL: empty) of every row; other columns are not read."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col(place_of(docs, text_col)).cast("binary"), F.lit(b""))
    return masked(docs).select(F.col(place_of(docs, id_col)).alias("_id"), text.alias("_text"))

"""Words of UTF-8 texts by one translate table and one split."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHUNK = 4_000_000


def translate_table(digits: bool) -> bytes:
    """A-Z become a-z, other ASCII characters than letters (and digits) blanks; all other bytes stay."""
    out = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        out[b] = ord(c.lower()) if c.isalpha() or (digits and c.isdigit()) else 0x20
    return bytes(out)


LETTERS = translate_table(digits=False)
LETTERS_AND_DIGITS = translate_table(digits=True)


def word_lists(text: str | None, table: bytes, size: int = _CHUNK) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists from stretches of about so many bytes."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(table)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        words = data[at:end].split()
        if words:
            yield words
        at = end


def joined_words(text: Column, table: bytes) -> Column:
    """The same words, joined by one blank; empty for null."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    blanks = "".join(re.escape(chr(b)) if b > 32 else f"\\x{b:02x}" for b in range(128) if table[b] == 0x20)
    lowered = F.translate(F.coalesce(text, F.lit("")), upper, lower)
    return F.trim(F.regexp_replace(lowered, f"[{blanks}]+", " "))

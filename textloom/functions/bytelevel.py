"""Byte-level pre-tokenisation (T1) and the byte <-> printable character mapping.

The pre-token pattern and the byte mapping are the public GPT-2 byte-level scheme
that the reference configures (``ByteLevel(add_prefix_space=False)``).  ``(?U)``
makes ``\\s``, ``\\p{L}``, ``\\p{N}`` Unicode-aware in java.util.regex.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the byte-level pre-tokenizer's split pattern.
PRETOKEN_PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=1)
def byte_chars() -> tuple[str, ...]:
    """Byte b -> printable character.

    Rule: bytes that are printable Latin-1 ('!'..'~', '¡'..'¬', '®'..'ÿ') map to
    themselves; the other 68 bytes map, in increasing byte order, to U+0100, U+0101, ...
    """
    printable = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    out, shifted = [], 0
    for b in range(256):
        if b in printable:
            out.append(chr(b))
        else:
            out.append(chr(0x100 + shifted))
            shifted += 1
    return tuple(out)


@lru_cache(maxsize=1)
def char_bytes() -> dict[str, int]:
    return {c: b for b, c in enumerate(byte_chars())}


def pretokens(text: Column) -> Column:
    """``ARRAY<STRING>`` of raw pre-tokens (their concatenation is the text)."""
    return F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), 0)


def byte_symbols(token: Column) -> Column:
    """T1 (second half): the pre-token's UTF-8 bytes as ``ARRAY<STRING>`` of mapped characters."""
    table = F.array(*[F.lit(c) for c in byte_chars()])
    hx = F.hex(F.encode(token, "UTF-8"))
    n = F.length(hx) / 2
    idx = F.sequence(F.lit(0), (n - 1).cast("int"))
    syms = F.transform(idx, lambda i: F.element_at(
        table, F.conv(F.substring(hx, i * 2 + 1, 2), 16, 10).cast("int") + 1))
    return F.when(n > 0, syms).otherwise(F.array().cast("array<string>"))


def byte_level(token: Column) -> Column:
    """The mapped pre-token as one string (``'Ġthe'`` for ``' the'``)."""
    return F.array_join(byte_symbols(token), "")

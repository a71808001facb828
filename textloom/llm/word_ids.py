"""Token ids of whole texts from a public tokenizer file, each distinct word encoded once per batch.

Tokenizers of the kind used here fold white space, lower-case, split a text by a pattern into pieces that
never cross white space, and merge inside each piece. So the ids of a text are the ids of its ASCII
white-space runs in order. A batch's runs are dictionary-encoded; distinct ones of Latin letters go through
the file's own split pattern and a cache of merged pieces. Runs with other characters or a special token,
and files of another kind, go through the whole tokenizer. The cache is bounded; pieces it hasn't got are
merged again in each batch.
"""

from __future__ import annotations

import ctypes
import gc
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries of the cache of pieces; about 80 MB in a worker.
CACHE_PIECES = 400_000
#: Stands between the ids of two runs; no vocabulary is that large.
BETWEEN = 0xFFFFFFFF
#: Longer pieces aren't kept: a text without spaces is one piece.
LONGEST_KEPT = 64
#: Bytes of text handled at a time.
CHUNK_BYTES = 1 << 23

#: Latin letters end before this character (combining marks come after it).
LATIN_END = 0x250
NOT_LATIN = re.compile(f"[{chr(LATIN_END)}-\U0010ffff]")

_ENCODERS: dict[str, PieceEncoder] = {}


def _byte_letters() -> dict[int, str]:
    """The printable character of each byte in byte-level vocabularies: itself, or the next free one from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _latin_class(kind: str) -> str:
    """Characters below ``LATIN_END`` of a general category (its first letter), for a character class."""
    return "".join(re.escape(chr(c)) for c in range(LATIN_END) if unicodedata.category(chr(c))[0] == kind)


class PieceEncoder:
    """``encode(texts) -> (ids, bounds)``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.pieces: dict[str, bytes] = {"\n": array("I", [BETWEEN]).tobytes()}
        self.letters = _byte_letters()
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.find = self._splitter(spec)

    @staticmethod
    def _splitter(spec: dict):
        """findall() of the file's split pattern, or a line end, over lower-cased Latin text; None if the file is of another kind."""
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        norms = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers") or []]
        if norms != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            return None
        first, second = steps
        if not first["invert"] or first["behavior"] != "Removed" or second["use_regex"] or second["add_prefix_space"]:
            return None
        white = "\t\n\x0b\x0c\r \x85\xa0"
        pattern = (first["pattern"]["Regex"].replace(r"\p{L}", _latin_class("L"))
                   .replace(r"\p{N}", _latin_class("N")).replace(r"\s", white))
        return re.compile(pattern + "|\n").findall

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, missing: set[str]) -> dict[str, bytes]:
        tokenize, letters, new = self.tokenizer.model.tokenize, self.letters, {}
        for p in missing:
            mapped = p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(letters)
            new[p] = array("I", [t.id for t in tokenize(mapped)]).tobytes()
        if len(self.pieces) + len(new) <= CACHE_PIECES:
            self.pieces.update((p, v) for p, v in new.items() if len(p) <= LONGEST_KEPT)
        return new

    def _latin(self, words: list[str]) -> pa.Array:
        """Ids of each Latin white-space run, as bytes: all runs are split in one pass, a line each."""
        found = self.find("\n".join(words).lower())
        got = list(map(self.pieces.get, found))
        missing = {p for p, v in zip(found, got, strict=True) if v is None}
        if missing:
            new = self._learn(missing)
            got = [new[p] if v is None else v for p, v in zip(found, got, strict=True)]
        ids = np.frombuffer(b"".join(got), "<u4")
        marks = ids == BETWEEN
        ends = np.append(np.flatnonzero(marks) - np.arange(len(words) - 1), len(ids) - len(words) + 1)
        bounds = np.concatenate([[0], 4 * ends])
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(words), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids[~marks].tobytes())])

    def _words(self, words: list[str]) -> pa.Array:
        """Ids of each white-space run, as bytes."""
        other = [i for i, w in enumerate(words) if not w.isascii() and NOT_LATIN.search(w) or "<" in w and any(s in w for s in self.specials)]
        if not other:
            return self._latin(words)
        plain = dict(zip(other, self._plain([words[i] for i in other]), strict=True))
        latin = self._latin(["" if i in plain else w for i, w in enumerate(words)]).to_pylist()
        return pa.array([plain.get(i, v) for i, v in enumerate(latin)], pa.large_binary())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, where each text's ids begin and the last end). Null is empty."""
        texts = pc.fill_null(texts, "")
        if self.find is None:
            parts = self._plain(texts.to_pylist())
            ends = np.cumsum([0, *map(len, parts)]) // 4
            return np.frombuffer(b"".join(parts), "<u4"), ends
        runs = pc.ascii_split_whitespace(texts)
        first = runs.offsets.to_numpy().astype(np.int64)
        coded = runs.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
        if not len(coded):
            return np.zeros(0, "<u4"), first * 0
        collecting = gc.isenabled()
        gc.disable()  # millions of short-lived objects and no cycles
        try:
            table = self._words(coded.dictionary.to_pylist())
        finally:
            if collecting:
                gc.enable()
        taken = table.take(coded.indices)
        at = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, taken.offset * 8)
        flat = np.frombuffer(taken.buffers()[2], "<u4", at[-1] // 4) if at[-1] else np.zeros(0, "<u4")
        return flat, at[first - first[0]] // 4


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def give_back() -> None:
    """Return freed memory to the system: a worker is kept for later stages that need none of it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps what it has
        pass


def slices(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of slices of about ``limit`` bytes of text; at least a row each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield start, column.slice(start, stop - start)
        start = stop

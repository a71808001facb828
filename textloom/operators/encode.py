"""Encoding and decoding with a learned vocabulary.

Encoding is a map over the documents: no shuffle, one scan. Built-in expressions cut special tokens and
pre-tokens out of a text in one pass of the pre-token pattern (T1), with the special-token literals as its
first alternatives; an Arrow UDF then turns each document's array of pre-tokens into ids. It merges every
distinct pre-token of a batch once, by lowest merge rank, as bytes, and keeps a bounded cache in the worker. The ids of a
batch are put together and given back a slice of its texts at a time (a text is never cut). The merge table it holds is
bounded by the vocabulary size. Decoding is built-in expressions only.
"""

from __future__ import annotations

import heapq
import json
import re
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.bytelevel import PRETOKEN_PATTERN, byte_chars, char_bytes
from textloom.operators.bpe import BOS, EOS, UNK, Vocabulary

#: Distinct pre-tokens a worker keeps the ids of; some 50 MB, as they are kept as bytes.
CACHE_TOKENS = 200_000
#: Ids of a pre-token kept at most: a text without spaces is one pre-token.
LONGEST_KEPT = 64
#: Pre-tokens encoded at a time; those of one text stay together.
SLICE_PIECES = 1 << 19

_CACHES: dict[str, dict[str, bytes]] = {}


def text_pieces(text: Column, specials: list[str]) -> Column:
    """Special tokens and pre-tokens of a text, in order (their concatenation is the text).

    A special token is cut out wherever it starts, the longest first; the text between two of them is
    pre-tokenised on its own, as the pattern sees no further than the next special token.
    """
    if not specials:
        return F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), 0)
    special = "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))
    # Runs without a special token, or one special token; then the pre-tokens of each run.
    runs = F.regexp_extract_all(text, F.lit(f"(?s)(?:{special})|(?:(?!{special}).)++"), 0)
    alone = F.array(*[F.lit(s) for s in specials])
    return F.flatten(F.transform(runs, lambda r: F.when(F.array_contains(alone, r), F.array(r)).otherwise(
        F.regexp_extract_all(r, F.lit(PRETOKEN_PATTERN), 0))))


def merge_token(token: str, first: list[int], ranks: dict[int, tuple[int, int]]) -> list[int]:
    """Ids of one pre-token: its bytes, merged by the lowest rank first, leftmost of equal ranks.

    The symbols are a linked list and the pairs that can merge a queue by (rank, place), so a pre-token of n bytes takes
    O(n log n) steps. ``ranks`` maps left id * 2**32 + right id to (rank, new id).
    """
    ids = [first[b] for b in token.encode()]
    n = len(ids)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    queue = [(hit[0] << 40) + i for i, (a, b) in enumerate(zip(ids, ids[1:])) if (hit := ranks.get((a << 32) + b))]
    heapq.heapify(queue)
    while queue:
        rank, i = divmod(heapq.heappop(queue), 1 << 40)
        j = after[i]
        if ids[i] < 0 or j == n:
            continue
        hit = ranks.get((ids[i] << 32) + ids[j])
        if hit is None or hit[0] != rank:
            continue  # the pair that was queued is gone
        ids[i], ids[j] = hit[1], -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if hit := ranks.get((ids[i] << 32) + ids[k]):
                heapq.heappush(queue, (hit[0] << 40) + i)
        k = before[i]
        if k >= 0 and (hit := ranks.get((ids[k] << 32) + ids[i])):
            heapq.heappush(queue, (hit[0] << 40) + k)
    return [i for i in ids if i >= 0]


def slices(counts: np.ndarray, limit: int | None = None) -> Iterator[tuple[int, int]]:
    """(first, last + 1) of runs of texts with at most ``limit`` pre-tokens together, or of one text."""
    ends = np.cumsum(counts)
    start = 0
    while start < len(counts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + (limit or SLICE_PIECES), "right")))
        yield start, stop
        start = stop


def _ids_udf(vocab: Vocabulary, specials: list[str]):
    ids = vocab.token_ids()
    unk = ids.get(UNK, 0)
    first = [ids.get(c, unk) for c in byte_chars()]
    ranks = {(a << 32) + b: (r, n) for r, (a, b, n) in enumerate(vocab.merges)}
    fixed = {s: array("i", [ids[s]]).tobytes() for s in specials}
    name = uuid.uuid4().hex  # of this vocabulary's cache in a worker

    def merged(tokens: pa.Array) -> pa.Array:
        """The ids of distinct pre-tokens, as bytes."""
        if name not in _CACHES:  # a worker keeps the cache of one vocabulary
            _CACHES.clear()
        cache = _CACHES.setdefault(name, {})
        table = []
        for token in tokens.to_pylist():
            got = fixed.get(token) or cache.get(token)
            if got is None:
                got = array("i", merge_token(token, first, ranks)).tobytes()
                if len(cache) < CACHE_TOKENS and len(got) <= 4 * LONGEST_KEPT:
                    cache[token] = got
            table.append(got)
        return pa.array(table, pa.large_binary())

    def encoded(counts: np.ndarray, null: np.ndarray, indices: pa.Array, table: pa.Array) -> pa.Array:
        """The ids of texts of so many pre-tokens, whose places in the table of distinct ones are given."""
        taken = table.take(indices)
        bounds, flat = np.zeros(1, np.int64), np.zeros(0, np.int32)
        if len(taken):
            bounds = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1) // 4
            flat = np.frombuffer(taken.buffers()[2] or b"", np.int32, bounds[-1])
        ends = np.concatenate([[0], np.cumsum(counts)])
        return pa.ListArray.from_arrays(pa.array(bounds[ends], pa.int32(), mask=np.append(null, False)), pa.array(flat))

    @F.arrow_udf("array<int>")
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pieces in batches:
            coded = pieces.flatten().dictionary_encode()
            counts = pc.fill_null(pieces.value_lengths(), 0).to_numpy().astype(np.int64)
            null = pieces.is_null().to_numpy(zero_copy_only=False)
            tokens, indices = coded.dictionary, coded.indices
            del pieces, coded
            table = pa.concat_arrays([merged(tokens.slice(i, SLICE_PIECES)) for i in range(0, len(tokens), SLICE_PIECES)]
                                     or [pa.array([], pa.large_binary())])
            ends = np.concatenate([[0], np.cumsum(counts)])
            for i, j in slices(counts):
                yield encoded(counts[i:j], null[i:j], indices.slice(ends[i], ends[j] - ends[i]), table)

    return to_ids


def id_column(text: Column, vocab: Vocabulary, add_special_tokens: bool = True) -> Column:
    """Ids of a text column as ``ARRAY<INT>``; with ``<s> ... </s>`` around by default. Null text is empty."""
    ids = vocab.token_ids()
    specials = [s for s in vocab.specials if s in ids]
    body = _ids_udf(vocab, specials)(text_pieces(F.coalesce(text, F.lit("")), specials))
    if not add_special_tokens:
        return body
    return F.concat(F.array(F.lit(ids[BOS])), body, F.array(F.lit(ids[EOS])))


def encode(docs: DataFrame, vocab: Vocabulary, id_col: str = "id", text_col: str = "text",
           add_special_tokens: bool = True) -> DataFrame:
    """T7 + T8: ``(id, ids ARRAY<INT>)``, one row per row of ``docs``."""
    return docs.select(F.col(id_col).alias("id"), id_column(F.col(text_col), vocab, add_special_tokens).alias("ids"))


def encode_pair(pairs: DataFrame, vocab: Vocabulary, id_col: str = "id") -> DataFrame:
    """``<s> A </s> <s> B </s>`` for columns ``a`` and ``b``."""
    both = F.concat(id_column(F.col("a"), vocab), id_column(F.col("b"), vocab))
    return pairs.select(F.col(id_col).alias("id"), both.alias("ids"))


def tokens_column(ids: Column, vocab: Vocabulary) -> Column:
    """Token strings of an id array, as an encoder prints them."""
    table = F.from_json(F.lit(json.dumps(vocab.tokens)), "array<string>")  # folded into one constant
    return F.transform(ids, lambda i: F.get(table, i))


def decode(encoded: DataFrame, vocab: Vocabulary, ids_col: str = "ids", skip_special_tokens: bool = True) -> Column:
    """Ids -> text: the tokens' bytes concatenated and read as UTF-8 (invalid sequences become
    U+FFFD); special tokens skipped by default, else their own text."""
    back = char_bytes()
    special = set(vocab.specials)

    def bytes_of(token: str) -> str:
        if token in special:
            return "" if skip_special_tokens else token.encode().hex()
        return "".join(f"{back[c]:02x}" for c in token)

    table = F.split(F.lit(",".join(map(bytes_of, vocab.tokens))), ",")  # folded into one constant
    return F.make_valid_utf8(F.unhex(F.array_join(F.transform(F.col(ids_col), lambda i: F.get(table, i)), "")).cast("string"))

"""Merge learning (T4): exact rounds of many merges over the table of distinct pre-tokens.

The words are a written table of blocks ``(symbols, sizes, n)``: about ``BLOCK`` 32-bit symbols of many words, the words'
lengths and their counts, each as bytes. So a task takes a block as three arrays, and what it does per word or per place is
done in arrays. The sequential trainer always takes the pair that comes first by (count desc, left id, right id). A round
finds the next few hundred merges of that sequence at once:

1. Count adjacent pairs of all words (in arrays, summed before the shuffle) and fetch the first ``k + 1``. The first k are
   *covered*; the last is the *cut*. With fewer than that, all pairs that may ever merge are covered and there is no cut.
2. Cut every word where an adjacent pair isn't covered. What is left, the *segments*, is summed up over all words: however
   large the corpus, few covered pairs make few distinct segments. If they are more than ``SEGMENTS``, k is halved.
3. Run the sequential algorithm on the distinct segments and their counts until the next pair comes after the cut.
4. Replace the segments in the words, drop the words in which nothing can merge any more, and write the table anew.

Why step 3 is exact. Every occurrence of a covered pair, and of a pair made of covered ones, lies in a segment, so their counts are
those of the whole corpus at any time. A pair across the end of a segment comes from an uncovered pair (x, y) and
occurs at most as often: no oftener than the cut. If as often as the cut, it holds a symbol made in this round, whose id is greater than
all before it, so it comes after the cut in any case. Uncovered counts only fall. Both need that a merge makes a new
symbol; a merge whose token exists already ends the round.

The driver holds the merge list and at most ``SEGMENTS`` segments. A round reads the words that can still change, so its
cost falls as learning goes on.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize, remove_stage

_SHIFT = 1 << 32  # pair key = left * 2^32 + right (ids < 2^31)
#: Distinct segments that the driver takes in one round, and covered pairs it asks for.
SEGMENTS = 40_000
COVERED = 8_192
FIRST_COVERED = 64
#: Symbols of a block of words (one word may be longer), and the longest segments that are told apart in arrays.
BLOCK = 1 << 19
LONG = 24
BLOCK_SCHEMA = "symbols binary, sizes binary, n binary"


Words = tuple[np.ndarray, np.ndarray, np.ndarray]  # symbols, length of each word, count of each word


def _block(parts: list[Words]) -> pa.RecordBatch:
    symbols, sizes, n = (np.concatenate(x) for x in zip(*parts))
    row = symbols.astype(np.int32), sizes.astype(np.int32), n.astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in row], ["symbols", "sizes", "n"])


def _blocks(parts: Iterable[Words]) -> Iterator[pa.RecordBatch]:
    """Blocks of at least ``BLOCK`` symbols, but for a task's last."""
    held, size = [], 0
    for part in parts:
        if not len(part[0]):
            continue
        held.append(part)
        size += len(part[0])
        if size >= BLOCK:
            yield _block(held)
            held, size = [], 0
    if held:
        yield _block(held)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """The words of each block."""
    for b in batches:
        for symbols, sizes, n in zip(b.column("symbols"), b.column("sizes"), b.column("n")):
            yield (np.frombuffer(symbols.as_buffer(), np.int32), np.frombuffer(sizes.as_buffer(), np.int32),
                   np.frombuffer(n.as_buffer(), np.int64))


def blocks(words: DataFrame) -> DataFrame:
    """Words ``(ids ARRAY<INT>, n)`` as blocks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
        for b in batches:
            ids, n = b.column("ids"), b.column("n").to_numpy()
            sizes = ids.value_lengths().to_numpy()
            ends = np.cumsum(sizes, dtype=np.int64)
            start = 0
            while start < len(b):
                done = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + BLOCK, "right")))
                yield ids.slice(start, stop - start).flatten().to_numpy(), sizes[start:stop], n[start:stop]
                start = stop

    return words.select("ids", F.col("n").cast("long").alias("n")).mapInArrow(lambda batches: _blocks(cut(batches)), BLOCK_SCHEMA)


def _numbers(sizes: np.ndarray) -> np.ndarray:
    """The word number of each symbol."""
    return np.repeat(np.arange(len(sizes)), sizes)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of ``n`` for each."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(n[order], starts)


def _pairs(symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key of each adjacent pair, whether it lies inside a word)."""
    return symbols[:-1].astype(np.int64) * _SHIFT + symbols[1:], word[:-1] == word[1:]


def pair_counts(table: DataFrame) -> DataFrame:
    """``(p, c)``: how often each pair is adjacent in the words of the blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbols, sizes, n in _words(batches):
            word = _numbers(sizes)
            pair, inside = _pairs(symbols, word)
            keys, total = _summed(pair[inside], n[word[:-1][inside]])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total)], ["p", "n"])

    return table.mapInArrow(count, "p long, n long").groupBy("p").agg(F.sum("n").alias("c"))


def _runs(symbols: np.ndarray, word: np.ndarray, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last + 1) places of the segments: maximal runs of symbols joined by covered pairs (sorted keys)."""
    if len(symbols) < 2 or not len(covered):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair, inside = _pairs(symbols, word)
    at = np.minimum(np.searchsorted(covered, pair), len(covered) - 1)
    joined = np.concatenate([[False], (covered[at] == pair) & inside, [False]])
    change = np.diff(joined.astype(np.int8))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1) + 1


def _distinct(symbols: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(number of each segment, the distinct segments by number).

    Segments of one length are told apart in arrays: their symbols are packed into 63 bits, and what is packed so far is
    numbered when the next symbol has no room. The few longer than ``LONG`` are compared as bytes.
    """
    kind, found = np.zeros(len(first), np.int64), []
    size = last - first
    bits = max(1, int(symbols.max()).bit_length()) if len(symbols) else 1
    for length in np.unique(size[size <= LONG]).tolist():
        here = np.flatnonzero(size == length)
        start = first[here]
        key, used = symbols[start].astype(np.int64), bits
        for i in range(1, length):
            if used + bits > 63:
                names, key = np.unique(key, return_inverse=True)
                used = len(names).bit_length()
            key, used = (key << bits) | symbols[start + i], used + bits
        _, example, number = np.unique(key, return_index=True, return_inverse=True)
        kind[here] = number + len(found)
        raw = symbols[start[example][:, None] + np.arange(length)].tobytes()
        found += [raw[i:i + 4 * length] for i in range(0, len(raw), 4 * length)]
    known: dict[bytes, int] = {}
    for k in np.flatnonzero(size > LONG).tolist():
        kind[k] = known.setdefault(symbols[first[k]:last[k]].tobytes(), len(found) + len(known))
    return kind, found + list(known)


def segment_counts(table: DataFrame, covered: np.ndarray) -> DataFrame:
    """``(segment, n)``: the distinct segments, as bytes of their 32-bit symbols, and how often they occur."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbols, sizes, n in _words(batches):
            word = _numbers(sizes)
            first, last = _runs(symbols, word, covered)
            kind, found = _distinct(symbols, first, last)
            total = np.zeros(len(found), np.int64)
            np.add.at(total, kind, n[word[first]])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(total)], ["segment", "n"])

    return table.mapInArrow(cut, "segment binary, n long").groupBy("segment").agg(F.sum("n").alias("n"))


def merge_pair(symbols: list[int], a: int, b: int, new: int) -> list[int]:
    """``symbols`` with every (a, b), from the left, replaced."""
    out, i = [], 0
    while i < len(symbols):
        if symbols[i] == a and i + 1 < len(symbols) and symbols[i + 1] == b:
            out.append(new)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def learn_round(segments: dict[bytes, int], cut: tuple[int, int], floor: int, room: int, new_id) -> tuple[list, dict[bytes, bytes]]:
    """The merges ``(left, right, new)`` up to the cut, and the segments they change.

    ``cut`` is (minus count, pair) of the first pair that isn't covered; ``new_id(left, right)`` gives (id, whether it is a new
    symbol); at most ``room`` new symbols are made.
    """
    held = [np.frombuffer(s, np.int32).tolist() for s in segments]
    times = list(segments.values())
    count: dict[int, int] = defaultdict(int)
    where: dict[int, set[int]] = defaultdict(set)
    for k, symbols in enumerate(held):
        for x, y in zip(symbols, symbols[1:]):
            count[x * _SHIFT + y] += times[k]
            where[x * _SHIFT + y].add(k)
    queue = [(-c, p) for p, c in count.items()]
    heapq.heapify(queue)
    merges: list[tuple[int, int, int]] = []
    changed: set[int] = set()
    while queue and room > 0:
        c, p = heapq.heappop(queue)
        if count.get(p) != -c:
            continue  # an older entry; the newer count has its own
        if -c < floor or (c, p) >= cut:
            break
        a, b = divmod(p, _SHIFT)
        new, fresh = new_id(a, b)
        merges.append((a, b, new))
        room -= fresh
        touched = set()
        for k in where.pop(p):
            old = held[k]
            now = merge_pair(old, a, b, new)
            if len(now) == len(old):
                continue
            for x, y in zip(old, old[1:]):
                q = x * _SHIFT + y
                count[q] -= times[k]
                touched.add(q)
            for x, y in zip(now, now[1:]):
                q = x * _SHIFT + y
                count[q] += times[k]
                where[q].add(k)
                touched.add(q)
            held[k] = now
            changed.add(k)
        for q in touched:
            if count[q] > 0:
                heapq.heappush(queue, (-count[q], q))
            else:
                del count[q]
        if not fresh:
            break
    keys = list(segments)
    return merges, {keys[k]: np.array(held[k], np.int32).tobytes() for k in changed}


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run of that size, one run after the other."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


def _replaced(table: DataFrame, covered: np.ndarray, changed: dict[bytes, bytes]) -> DataFrame:
    """The blocks with the changed segments of their words replaced; words of one symbol are done and dropped."""

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
        for symbols, sizes, n in _words(batches):
            word = _numbers(sizes)
            first, last = _runs(symbols, word, covered)
            kind, found = _distinct(symbols, first, last)
            now = [changed.get(segment, segment) for segment in found]
            size = np.array([len(x) // 4 for x in now], np.int64)
            new = np.frombuffer(b"".join(now), np.int32)
            out, keep = symbols.copy(), np.ones(len(symbols), bool)
            if len(found):
                made = size[kind]
                out[_places(first, made)] = new[_places((np.cumsum(size) - size)[kind], made)]
                keep[_places(first + made, last - first - made)] = False
            out, word = out[keep], word[keep]
            size = np.bincount(word, minlength=len(sizes))
            left = size > 1
            yield out[left[word]], size[left], n[left]

    return table.mapInArrow(lambda batches: _blocks(replace(batches)), BLOCK_SCHEMA)


def learn_merges(words: DataFrame, vocab, vocab_size: int, min_frequency: int = 2,
                 segments: int = SEGMENTS, covered: int = COVERED, log=None):
    """Extend ``vocab`` with merges, learned from words ``(ids ARRAY<INT>, n)``, until ``vocab_size`` tokens or best count < min_frequency."""
    ids = vocab.token_ids()
    floor = max(1, min_frequency)
    table = materialize(blocks(words), "bpe-words")
    k, done = min(FIRST_COVERED, covered), 0

    def new_id(a: int, b: int) -> tuple[int, bool]:
        token = vocab.tokens[a] + vocab.tokens[b]
        if token in ids:
            return ids[token], False
        ids[token] = vocab.size
        vocab.tokens.append(token)
        vocab.kinds.append("merge")
        return ids[token], True

    while vocab.size < vocab_size:
        counts = pair_counts(table).where(F.col("c") >= floor)
        top = [(-r["c"], r["p"]) for r in counts.orderBy(F.desc("c"), F.asc("p")).limit(k + 1).collect()]
        if not top:
            break
        while True:
            cut = top[k] if len(top) > k else (0, 0)
            keys = np.array(sorted(p for _, p in top[:k]), np.int64)
            found = {bytes(r["segment"]): r["n"] for r in segment_counts(table, keys).limit(segments + 1).collect()}
            if len(found) <= segments or k == 1:
                break
            k = max(1, k // 2)
        merges, changed = learn_round(found, cut, floor, vocab_size - vocab.size, new_id)
        vocab.merges += merges
        done += 1
        if log:
            log(f"round {done}: {k} pairs, {len(found)} segments, {len(merges)} merges, vocab {vocab.size}")
        if vocab.size < vocab_size:
            table, old = materialize(_replaced(table, keys, changed), "bpe-words"), table
            remove_stage(old)
        if len(found) < segments // 2:
            k = min(covered, 2 * k)
    remove_stage(table)
    return vocab

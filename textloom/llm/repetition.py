"""Repetition rules over the suffix array of each text's words.

A text's words are numbered and all suffixes of its word sequence sorted by prefix doubling; texts of a
batch are sorted together, but a suffix never compares equal beyond its own text. Where neighbouring
suffixes share a prefix, the longest-common-prefix interval they lie in is a maximal repeated substring.
The union of the spans of all repeats of at least ``min_words`` words is the covered part. A text is
rejected if too large a fraction of its words is covered, or if its longest repeat is too long.

Defined results: a null or empty text, or one without words, has zero counts and fails the base rule (under
50 words); repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from textloom.llm.staging import only
from textloom.llm.word_ids import slices

#: Repeats of fewer words are ordinary phrases.
MIN_WORDS = 8
#: Most of a text's words that repeats may cover: the published limit for duplicate 8-grams (Rae et al., "Scaling Language Models").
MAX_COVERED = 0.12
#: The most words one repeat may have: the published length of a duplicate passage (Lee et al., "Deduplicating Training Data").
MAX_REPEAT = 50
#: The base rule's limits.
BASE_WORDS = 50
BASE_REPEAT_PERCENT = 50
WINDOW = 3

OUT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
       "covered_words long, longest_repeat long")


def repeat_lengths(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every position the length of the longest string starting there that also starts elsewhere in the same text.

    ``symbols`` are the texts' words, already distinct between texts; ``ends`` is the end of each position's text.
    """
    n = len(symbols)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    sa = np.argsort(symbols, kind="stable")
    fresh = np.empty(n, bool)
    fresh[0], fresh[1:] = True, symbols[sa[1:]] != symbols[sa[:-1]]
    starts = np.flatnonzero(fresh)
    class_of = np.cumsum(fresh) - 1
    rank = np.empty(n, np.int64)
    rank[sa] = starts[class_of]
    levels = [rank.copy()]  # levels[j][p]: class of the 2**j words at p
    lcp = np.zeros(n, np.int64)  # lcp[i]: shared words of sa[i - 1] and sa[i]; filled when the two part
    size = np.diff(np.append(starts, n))[class_of]
    active = np.flatnonzero(size > 1)  # places of the suffix array still tied
    h = 1
    while len(active):
        sub = sa[active]
        ahead = sub + h
        inside = ahead < ends[sub]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[sub] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        sub, key = sub[order], key[order]
        sa[active] = sub
        first = np.empty(len(key), bool)
        first[0], first[1:] = True, key[1:] != key[:-1]
        same_class = np.zeros(len(key), bool)
        same_class[1:] = key[1:] // (n + 1) == key[:-1] // (n + 1)
        parted = np.flatnonzero(first & same_class)
        if len(parted):  # these neighbours share h words and fewer than 2h
            a, b = sub[parted - 1], sub[parted]
            shared = np.full(len(parted), h, np.int64)
            for j in range(len(levels) - 2, -1, -1):
                step = 1 << j
                pa_, pb_ = a + shared, b + shared
                ok = (pa_ + step <= ends[a]) & (pb_ + step <= ends[b])
                ok &= levels[j][np.minimum(pa_, n - 1)] == levels[j][np.minimum(pb_, n - 1)]
                shared += step * ok
            # Both were taken in steps below h, so a last comparison by single words isn't needed.
            lcp[active[parted]] = shared
        lead = np.flatnonzero(first)
        rank[sub] = active[lead][np.cumsum(first) - 1]
        size = np.diff(np.append(lead, len(key)))[np.cumsum(first) - 1]
        active = active[size > 1]
        levels.append(rank.copy())
        h *= 2
    np.maximum.at(out, sa, lcp)
    out[sa[:-1]] = np.maximum(out[sa[:-1]], lcp[1:])
    return out


def _covered(length: np.ndarray) -> np.ndarray:
    """Whether each position lies in the span of ``length`` positions from some position on."""
    change = np.zeros(len(length) + 1, np.int64)
    at = np.flatnonzero(length)
    np.add.at(change, at, 1)
    np.add.at(change, at + length[at], -1)
    return np.cumsum(change)[:-1] > 0


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def measure(texts: pa.Array, min_words: int = MIN_WORDS) -> dict[str, np.ndarray]:
    """Counts of every text of an array; null is empty."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    runs = pc.ascii_split_whitespace(texts)
    offsets = runs.offsets.to_numpy().astype(np.int64)
    flat = runs.values.slice(offsets[0], offsets[-1] - offsets[0])
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # text that begins or ends with white space
    bounds = np.concatenate([[0], np.cumsum(real)])[offsets - offsets[0]]
    words = flat.filter(pa.array(real))
    n_words = np.diff(bounds)
    text_of = np.repeat(np.arange(n), n_words)
    ends = np.repeat(bounds[1:], n_words)
    coded = words.dictionary_encode()
    symbols = text_of * np.int64(max(1, len(coded.dictionary))) + coded.indices.to_numpy().astype(np.int64)
    length = repeat_lengths(symbols, ends)
    window = _covered(np.where(length >= WINDOW, WINDOW, 0))
    span = _covered(np.where(length >= min_words, length, 0))
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, text_of, length)

    lines = pc.split_pattern(texts, "\n")
    at = lines.offsets.to_numpy().astype(np.int64)
    flat_lines = lines.values.slice(at[0], at[-1] - at[0])
    line_of = np.repeat(np.arange(n), np.diff(at))
    wordy = pc.match_substring_regex(flat_lines, r"[^ \t\n\x0b\f\r]").to_numpy(zero_copy_only=False)
    codes = flat_lines.dictionary_encode()
    pairs = (line_of * np.int64(max(1, len(codes.dictionary))) + codes.indices.to_numpy())[wordy]
    distinct = np.unique(pairs) // max(1, len(codes.dictionary))
    n_lines = np.bincount(line_of[wordy], minlength=n)
    return {
        "n_words": n_words,
        "word_chars": _per_text(pc.utf8_length(words).to_numpy().astype(np.int64), bounds),
        "n_symbols": pc.count_substring_regex(texts, r"[#*$%&|<>]").to_numpy().astype(np.int64),
        "n_dup_lines": n_lines - np.bincount(distinct.astype(np.int64), minlength=n),
        "n_repeat_words": _per_text(window, bounds),
        "covered_words": _per_text(span, bounds),
        "longest_repeat": longest,
    }


def judge_documents(documents: DataFrame, min_words: int = MIN_WORDS, max_covered: float = MAX_COVERED,
                    max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Counts and verdict of every document; a map over the scan, no shuffle."""
    rows = only(documents, "doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in slices(b.column("text")):
                m = measure(texts, min_words)
                failed = (m["n_words"] < BASE_WORDS) | (100 * m["n_repeat_words"] > BASE_REPEAT_PERCENT * m["n_words"])
                kept = ~failed & (m["covered_words"] <= max_covered * m["n_words"]) & (m["longest_repeat"] <= max_repeat)
                m |= {"base_failed": failed, "kept": kept}
                names = [part.split()[0] for part in OUT.split(", ")]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(first, len(texts)), *(pa.array(m[c]) for c in names)],
                                                 ["doc_id", *names])

    return rows.mapInArrow(judge, f"doc_id {kind}, {OUT}")

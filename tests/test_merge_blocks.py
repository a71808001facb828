"""Words in blocks: the segments of a block are told apart in arrays, and few rows hold all words."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textloom.functions.bytelevel import byte_symbols
from textloom.operators import merges
from textloom.operators.bpe import byte_alphabet, spelled


def test_segments_of_any_length_are_told_apart():
    rng = np.random.default_rng(7)
    for top in (2, 9, 300, 40_000):  # with 16 bits a symbol, segments of more than three symbols are numbered on the way
        symbols = rng.integers(0, top, 4_000).astype(np.int32)
        last = np.cumsum(rng.integers(2, 40, 150))
        first = np.concatenate([[0], last[:-1]])
        symbols[first[9]:first[9] + 2], symbols[first[8]:first[8] + 2] = symbols[:2], symbols[:2]
        kind, found = merges._distinct(symbols, first, last)
        assert len(set(found)) == len(found)
        assert [found[k] for k in kind] == [symbols[i:j].tobytes() for i, j in zip(first, last)]
    kind, found = merges._distinct(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert not len(kind) and found == []


def test_blocks_hold_every_word(spark):
    words = [([i % 7, i % 5, 3] + [i % 3] * (i % 4), i) for i in range(30_000)] + [([4] * (merges.BLOCK + 5), 2)]
    table = merges.blocks(spark.createDataFrame(words, "ids array<int>, n long").coalesce(1))
    rows = table.collect()
    assert len(rows) <= 2  # were as many rows as words
    got = []
    for symbols, sizes, n in merges._words([pa.RecordBatch.from_pylist([r.asDict() for r in rows])]):
        got += zip((x.tolist() for x in np.split(symbols, np.cumsum(sizes)[:-1])), n.tolist())
    assert sorted(got) == sorted((ids, n) for ids, n in words)


def test_changed_segments_are_replaced_and_done_words_dropped(spark):
    words = spark.createDataFrame([([1, 2, 1, 2, 3], 5), ([1, 2], 4), ([3, 1, 2], 2), ([3, 3], 9)], "ids array<int>, n long")
    table = merges.blocks(words.coalesce(1))
    pairs = {(r.p >> 32, r.p & 0xFFFFFFFF): r.c for r in merges.pair_counts(table).collect()}
    assert pairs == {(1, 2): 16, (2, 1): 5, (2, 3): 5, (3, 1): 2, (3, 3): 9}
    covered = np.array([(1 << 32) + 2], np.int64)
    segment, made = (np.array(x, np.int32).tobytes() for x in ([1, 2], [7]))
    assert {bytes(r.segment): r.n for r in merges.segment_counts(table, covered).collect()} == {segment: 16}
    got = next(merges._words([pa.RecordBatch.from_pylist([r.asDict() for r in merges._replaced(table, covered, {segment: made}).collect()])]))
    assert [x.tolist() for x in got] == [[7, 7, 3, 3, 7, 3, 3], [3, 2, 2], [5, 2, 9]]


def test_pretokens_are_spelled_from_their_bytes(spark):
    tokens = ["a", " é", "\x00\x01", "日本", "", "ab", " a"]
    counts = spark.createDataFrame([(t, i) for i, t in enumerate(tokens)], "token string, n long")
    alphabet = byte_alphabet(counts)
    by_row = counts.select(byte_symbols(F.col("token")).alias("s"), "n").collect()
    assert alphabet == sorted({c for r in by_row for c in r.s}, key=ord)
    assert {r.n: [alphabet[i - 14] for i in r.ids] for r in spelled(counts, alphabet, 14).collect()} == {r.n: r.s for r in by_row if len(r.s) > 1}
    assert byte_alphabet(counts.limit(0)) == [] and spelled(counts.limit(0), [], 14).collect() == []

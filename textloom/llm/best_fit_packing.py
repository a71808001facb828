"""Best-fit packing of token sequences with large-item matching.

A document is tokenized, gets its end id, and is cut into capacity-sized pieces only if it is longer
than one sequence. Pieces longer than a third of the capacity go at most two to a bin: from the longest
down, each is matched with the longest partner that still fits beside it. Shorter pieces follow, from
the longest down, each into the tightest gap that holds it, else into a new bin.

Lengths are integers up to the capacity, so the whole plan depends only on how many pieces there are of
each length. That histogram (``capacity`` entries, whatever the data's size) is all the driver sees. The
plan is a list of bin patterns with multiplicities; pieces find their place by their rank among those of
their length, which is counted per file, so no length, however common, meets in one task.

The sequences are written: a row holds a sequence's ids and where each of its pieces lies in them. What
``pack_documents`` returns is read back from there.

Defined results: null text is the empty document (one piece with the end id alone); repeated rows are
packed each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.staging import drop_path, group_ranks, only, release
from textloom.session import fresh_path
from textloom.llm.word_ids import encoder, give_back, slices


def id_kind(tokenizer: str, end_id: int) -> str:
    """Little-endian unsigned integers that hold every id: two bytes, or four for a vocabulary of more than 65,536."""
    return "<u2" if max(encoder(tokenizer).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def piece_rows(documents: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length and ids (packed integers) of every piece; a map over the scan."""
    rows = only(documents, "doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    packed = np.dtype(id_kind(tokenizer, end_id))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            for first, texts in slices(b.column("text")):
                ids, at = enc.encode(texts)
                n = np.diff(at) + 1
                ids = np.insert(ids.astype(packed), at[1:] - at[0], end_id)  # each text's end id after its own
                pieces = -(-n // capacity)
                of = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(n[of] - start, capacity)
                bounds = np.concatenate([[0], np.cumsum(length)]) * packed.itemsize  # pieces follow each other without a gap
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(of + first)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), _binary(bounds, ids.tobytes())],
                    ["doc_id", "piece", "start", "length", "ids"])
        give_back()

    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids binary")


def _binary(bounds: np.ndarray, data) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


class _Bins:
    """Groups of equal bins by remaining gap."""

    def __init__(self) -> None:
        self.by_gap: dict[int, list[list]] = {}  # gap -> [[count, ((length, how many), ...)], ...]

    def put(self, gap: int, count: int, items: tuple) -> None:
        if count:
            self.by_gap.setdefault(gap, []).append([count, items])


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple]]:
    """[(number of bins, ((length, pieces of it per bin), ...)), ...] for a histogram of lengths."""
    left = {n: c for n, c in histogram.items() if c}
    bins = _Bins()
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        longest = large[-1]
        at = bisect_right(large, capacity - longest) - 1
        if at < 0:  # no partner fits beside it
            bins.put(capacity - longest, left.pop(longest), ((longest, 1),))
            large.pop()
            continue
        partner = large[at]
        if partner == longest:
            pairs, odd = divmod(left.pop(longest), 2)
            large.pop()
            bins.put(capacity - 2 * longest, pairs, ((longest, 2),))
            if odd:
                if large:  # the odd one is matched with the next shorter length
                    left[longest] = 1
                    mate = large[-1]
                    left.pop(longest)
                    left[mate] -= 1
                    bins.put(capacity - longest - mate, 1, ((longest, 1), (mate, 1)))
                    if not left[mate]:
                        left.pop(mate)
                        large.pop()
                else:
                    bins.put(capacity - longest, 1, ((longest, 1),))
            continue
        n = min(left[longest], left[partner])
        bins.put(capacity - longest - partner, n, ((longest, 1), (partner, 1)))
        for length in (longest, partner):
            left[length] -= n
            if not left[length]:
                left.pop(length)
                large.remove(length)
    gaps = sorted(bins.by_gap)
    for length in sorted((n for n in left if n > 0), reverse=True):
        todo = left[length]
        at = bisect_right(gaps, length - 1)
        while todo and at < len(gaps):
            gap = gaps[at]
            groups = bins.by_gap[gap]
            each = gap // length  # after one is placed its bin is the tightest for the next
            while todo and groups:
                count, items = groups.pop()
                full = min(count, todo // each)
                bins.put(gap - each * length, full, (*items, (length, each)))
                todo -= full * each
                rest = count - full
                if rest and todo:
                    bins.put(gap - todo * length, 1, (*items, (length, todo)))
                    todo, rest = 0, rest - 1
                if rest:
                    groups.append([rest, items])
            if not groups:
                del bins.by_gap[gap]
            at += 1
        if todo:
            each = capacity // length
            bins.put(capacity - each * length, todo // each, ((length, each),))
            if todo % each:
                bins.put(capacity - todo % each * length, 1, ((length, todo % each),))
        gaps = sorted(bins.by_gap)
    return [(count, items) for groups in bins.by_gap.values() for count, items in groups]


def _slots(patterns: list[tuple[int, tuple]]) -> dict[str, np.ndarray]:
    """Intervals of ranks: for a length, ranks from ``rank`` on fill ``each`` places per bin from bin ``base`` on."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for count, items in patterns:
        offset = 0
        for length, each in items:
            rank = used.get(length, 0)
            rows.append((length, rank, base, each, offset))
            used[length] = rank + count * each
            offset += length * each
        base += count
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "base", "each", "offset"), table.T.copy(), strict=True))


def place(ranked: DataFrame, patterns: list[tuple[int, tuple]]) -> DataFrame:
    """Add sequence_id and offset to pieces that carry their rank within their length."""
    slots = _slots(patterns)  # bounded by the capacity, not by the data

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts: dict[int, tuple[int, int]] = {}
        lengths, first, n = np.unique(slots["length"], return_index=True, return_counts=True)
        for length, a, k in zip(lengths.tolist(), first.tolist(), n.tolist(), strict=True):
            starts[length] = (a, a + k)
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("_rank").to_numpy()
            at = np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                a, z = starts[int(one)]
                here = length == one
                at[here] = a + np.searchsorted(slots["rank"][a:z], rank[here], "right") - 1
            past = rank - slots["rank"][at]
            sequence = slots["base"][at] + past // slots["each"][at]
            offset = slots["offset"][at] + past % slots["each"][at] * length
            names = [c for c in b.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                                             [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"{c} {k}" for c, k in ranked.dtypes if c != "_rank")
    return ranked.mapInArrow(put, f"{kinds}, sequence_id long, offset long")


def assemble(placed: DataFrame, partitions: int) -> DataFrame:
    """sequence_id, ids and pieces (doc_id, piece, start, length, offset) of every sequence: one shuffle of the ids."""
    kind = dict(placed.dtypes)["doc_id"]
    fields = ["doc_id", "piece", "start", "length", "offset"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def rows(b: pa.RecordBatch, cuts: np.ndarray) -> pa.RecordBatch:
            """One row per run of rows between cuts; the ids already stand one after the other."""
            ids = pa.concat_arrays([b.column("ids")])  # begins at the start of its buffer
            at = _bounds(ids)
            inner = pa.StructArray.from_arrays([b.column(c) for c in fields], fields)
            return pa.RecordBatch.from_arrays(
                [b.column("sequence_id").take(pa.array(cuts[:-1])), _binary(at[cuts] - at[0], ids.buffers()[2][int(at[0]):int(at[-1])] if at[-1] else b""),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), inner)], ["sequence_id", "ids", "pieces"])

        for b in batches:
            if held is not None:
                b = pa.concat_batches([held, b])
            of = b.column("sequence_id").to_numpy()
            begins = np.append(0, np.flatnonzero(np.diff(of)) + 1)
            held = b.slice(int(begins[-1]))  # the last sequence may go on in the next batch
            if len(begins) > 1:
                yield rows(b.slice(0, int(begins[-1])), begins)
        if held is not None and held.num_rows:
            yield rows(held, np.array([0, held.num_rows]))
        give_back()

    dealt = placed.select(*fields, "ids", "sequence_id").repartition(partitions, "sequence_id").sortWithinPartitions("sequence_id", "offset")
    return dealt.mapInArrow(join, f"sequence_id long, ids binary, pieces array<struct<doc_id:{kind},piece:int,start:bigint,length:bigint,offset:bigint>>")


def _bounds(values: pa.Array) -> np.ndarray:
    """Where each value of a binary array begins in its data, and the last ends."""
    return np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, 4 * values.offset).astype(np.int64)


def _write(df: DataFrame, name: str, path: str | None = None) -> tuple[DataFrame, str]:
    path = path or fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path), path


def write_sequences(documents: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Write the packed sequences (to ``path``, which must not exist) and read them: sequence_id, ids (integers of
    ``id_kind``, in one binary) and pieces."""
    spark = documents.sparkSession
    pieces, pieces_path = _write(piece_rows(documents, tokenizer, end_id, capacity), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), pieces.rdd.getNumPartitions())
    ranked = group_ranks(pieces, ["length"], "_rank")
    placed, placed_path = _write(place(ranked.select("doc_id", "piece", "start", "length", "ids", "_rank"), plan_bins(histogram, capacity)), "placed-pieces")
    drop_path(spark, pieces_path)
    del pieces, ranked
    release(spark)
    sequences, _ = _write(assemble(placed, partitions), "sequences", path)
    drop_path(spark, placed_path)
    release(spark)
    return sequences


def sequence_pieces(sequences: DataFrame, kind: str) -> DataFrame:
    """One row per piece of written sequences, with the checksum of its ids as four-byte integers."""
    types = {f.name: f.dataType.simpleString() for f in sequences.schema["pieces"].dataType.elementType.fields}
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    width = np.dtype(kind).itemsize

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lists = b.column("ids"), b.column("pieces")
            at, inner = _bounds(ids), lists.flatten()
            each = lists.value_lengths().to_numpy()
            of = np.repeat(np.arange(b.num_rows), each)
            got = dict(zip([f.name for f in inner.type], inner.flatten(), strict=True))
            first = (at[of] - at[0]) // width + got["offset"].to_numpy()
            data = np.frombuffer(ids.buffers()[2] or b"", kind, (at[-1] - at[0]) // width, at[0]).astype("<u4").tobytes() if at[-1] > at[0] else b""
            crc = [zlib.crc32(data[4 * i:4 * j]) for i, j in zip(first.tolist(), (first + got["length"].to_numpy()).tolist(), strict=True)]
            more = {"ids_crc32": pa.array(crc, pa.int64()), "sequence_id": b.column("sequence_id").take(pa.array(of))}
            yield pa.RecordBatch.from_arrays([(got | more)[c] for c in names], names)

    return sequences.mapInArrow(digest, ", ".join(f"{c} {(types | {'ids_crc32': 'long', 'sequence_id': 'long'})[c]}" for c in names))


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece with its sequence, its offset there and its ids' checksum, all read from the written sequences."""
    return sequence_pieces(write_sequences(documents, tokenizer, capacity, end_id), id_kind(tokenizer, end_id))

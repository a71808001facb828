"""Exact-substring deduplication over a logarithmic family of suffix arrays.

Every byte covered by a ``LENGTH``-byte string that also starts somewhere else is removed; strings are judged on
the input and never cross texts.

Sampled suffixes. Each window of ``LENGTH`` bytes picks its ``GRAM``-byte substring of least hash. The choice depends
on the window's bytes alone, so two equal windows pick the same place: a suffix array of the picked places
finds every repeat of ``LENGTH`` bytes, with one suffix in about 70 bytes instead of one a byte.

Family. Texts come in batches. A batch gets a suffix array: its picked suffixes ordered by their first bytes and
the fingerprint of their first ``GRAM`` bytes, in bucketed, sorted tables. The array is merge-scanned against every level
of the family (a sort-merge join of equal buckets, without a shuffle); suffixes that occur in both, or twice in the batch,
are candidates. The array then becomes a level, and levels of equal size merge until no two are equal, so n
batches make at most log2(n) + 1 levels and each suffix is rewritten log2(n) times at most.

Matches. A picked suffix stands for a run of windows. Runs with equal bytes throughout (by two independent 64-bit hashes)
repeat as a whole. A run that only begins or ends inside a repeat is settled by its own bytes: first ``RANGE`` windows at
a time, by all their bytes and by those they share, and then, where the shared bytes repeat but not all, window by window.

Runs of which a task has seen two alike are turned into spans at once, and counts are combined before each shuffle and
joined back on the key, so a passage that a third of all texts hold costs each task a few rows per key. Equal texts are one text with a count. Nothing of the data's size reaches the driver.

Defined results: null and empty texts have no bytes; a text of fewer than ``LENGTH`` bytes keeps all of them; copies of a
text lose all their bytes; repeated rows are such copies.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from textloom.llm.staging import drop_path, release, stage
from textloom.llm.word_ids import give_back
from textloom.session import fresh_path

#: Shortest repeat that is removed, and bytes of a sampled suffix's key.
LENGTH = 200
GRAM = 64
WINDOWS = LENGTH - GRAM + 1
#: Windows of a run are compared this many at a time before they are compared one by one.
RANGE = 16
#: Batches a whole table is inserted in: each doubling costs one more rewrite of the arrays.
BATCHES = 2
#: Buckets whose repeated keys go to one file.
BUCKETS_PER_FILE = 8
#: Bytes of text hashed at a time; places in a chunk take POSITION_BITS bits.
CHUNK = 1 << 19
POSITION_BITS = 22

_MASK = (1 << 64) - 1


def _letters(seed: int) -> np.ndarray:
    """A 64-bit number for each byte value."""
    x = (np.arange(1, 257, dtype=np.uint64) + np.uint64(256 * seed)) * np.uint64(0x9E3779B97F4A7C15)
    return _mixed(_mixed(x)) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Rolling:
    """Polynomial hashes modulo 2**64 of any substring of a buffer."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int):
        base = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)[seed]
        self.seed = seed
        n = len(data) + 1
        have = self._powers.get(seed)
        if have is None or len(have[0]) < n:
            size = max(n, CHUNK + 4096)
            up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            have = self._powers[seed] = (np.cumprod(up), np.cumprod(down))
        self.down = have[1]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(_letters(seed)[data] * have[0][:n - 1], out=self.sums[1:])

    def between(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[stop] - self.sums[start]) * self.down[start])

    def all_of(self, length: int) -> np.ndarray:
        """Hash of every substring of ``length`` bytes."""
        n = len(self.sums) - length
        return _mixed((self.sums[length:] - self.sums[:n]) * self.down[:n])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have, least = 1, x
    while 2 * have <= width:
        least = np.minimum(least[:len(least) - have], least[have:])
        have *= 2
    rest = width - have
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def picked(data: bytes, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Picked suffixes of concatenated texts (``ends``: where each text ends).

    ``at``: place of the suffix; ``lo``, ``hi``: first and last window that picks it; ``kh``: two first bytes and
    fingerprint of the gram; ``sh``: hash of all bytes of those windows; ``text``: number of the text.
    """
    raw = np.frombuffer(data, np.uint8)
    if len(raw) < LENGTH:
        return {k: np.zeros(0, np.int64) for k in ("at", "lo", "hi", "kh", "sh", "text")}
    with np.errstate(over="ignore"):
        first = _Rolling(raw, 0)
        grams = first.all_of(GRAM)
        low = np.uint64((1 << POSITION_BITS) - 1)
        least = _sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), WINDOWS)
        at = (least & low).astype(np.int64)
        sizes = np.diff(ends, prepend=0)
        # Windows that stay inside a text, text by text.
        number = np.maximum(sizes - LENGTH + 1, 0)
        text = np.repeat(np.arange(len(ends)), number)
        p = np.arange(len(text)) + np.repeat(ends - sizes - (np.cumsum(number) - number), number)
        at = at[p]
        fresh = np.ones(len(p), bool)
        fresh[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        head = np.flatnonzero(fresh)
        at, lo, text = at[head], p[head], text[head]
        hi = p[np.append(head[1:], len(p)) - 1]
        start = raw[at].astype(np.uint64) << np.uint64(8) | raw[at + 1]
        kh = start << np.uint64(48) | grams[at] >> np.uint64(16)
        sh = _mixed(_Rolling(raw, 1).between(lo, hi + LENGTH) + _mixed((at - lo).astype(np.uint64) << np.uint64(32) | (hi - lo).astype(np.uint64)))
    return {"at": at, "lo": lo, "hi": hi, "kh": kh.view(np.int64), "sh": sh.view(np.int64), "text": text}


def _chunks(texts: Iterator[tuple[int, memoryview]]) -> Iterator[tuple[bytes, list[int], list[int], np.ndarray]]:
    """(bytes, text ids, where in its text each part begins, part ends) of about ``CHUNK`` bytes; longer texts in overlapping parts."""
    held, ids, begins, ends, size = [], [], [], [], 0
    for t, text in texts:
        # Parts overlap by LENGTH - 1 bytes, so each window lies in one part.
        for begin in range(0, max(len(text) - LENGTH + 1, 1), CHUNK):
            part = text[begin:begin + CHUNK + LENGTH - 1]
            if size and size + len(part) > 2 * CHUNK:
                yield b"".join(held), ids, begins, np.array(ends)
                held, ids, begins, ends, size = [], [], [], [], 0
            held.append(part)
            size += len(part)
            ids.append(t)
            begins.append(begin)
            ends.append(size)
    if held:
        yield b"".join(held), ids, begins, np.array(ends)


def _suffix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()  # copies inside a task are one text

    def texts() -> Iterator[tuple[int, memoryview]]:
        for b in batches:
            for t, value in zip(b.column("t").to_pylist(), b.column("text"), strict=True):
                if t not in seen:
                    seen.add(t)
                    yield t, memoryview(value.as_buffer())

    for data, ids, begins, ends in _chunks(texts()):
        got = picked(data, ends)
        text = got["text"]
        shift = np.array(begins)[text] - (ends - np.diff(ends, prepend=0))[text]
        t = np.array(ids, np.int64)[text]
        at, lo, hi = (got[c] + shift for c in ("at", "lo", "hi"))
        # Two runs of a kind stand for all of that kind here; the others are known to repeat.
        more = _third_on(got["kh"], got["sh"])
        yield _rows(got["kh"][~more], got["sh"][~more], t[~more], at[~more], lo[~more], hi[~more], 0)
        of, start, stop = _joined_spans(text[more], lo[more], hi[more] + LENGTH)
        t = np.array(ids, np.int64)[of]
        with np.errstate(over="ignore"):
            yield _rows(_mixed(t.view(np.uint64)).view(np.int64), t * 0, t, start, start, stop, 1)
    give_back()


def _third_on(kh: np.ndarray, sh: np.ndarray) -> np.ndarray:
    """Whether two rows before each have the same keys."""
    order = np.lexsort((sh, kh))
    a, b = kh[order], sh[order]
    out = np.zeros(len(order), bool)
    out[order[2:]] = (a[2:] == a[:-2]) & (b[2:] == b[:-2])
    return out


def _joined_spans(text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (text, start, stop) in order, joined where they touch."""
    if not len(text):
        return text, start, stop
    order = np.lexsort((start, text))
    text, start, stop = text[order], start[order], stop[order]
    far = int(stop.max()) + 2
    reach = np.maximum.accumulate(stop + text * far)
    first = np.flatnonzero(np.append(True, start[1:] + text[1:] * far > reach[:-1]))
    last = np.append(first[1:], len(text)) - 1
    return text[first], start[first], reach[last] - text[last] * far


def _rows(kh, sh, t, at, lo, hi, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*map(pa.array, (kh, sh, t, at, lo, hi)), pa.array(np.full(len(kh), kind, np.int8))],
                                      ["kh", "sh", "t", "at", "lo", "hi", "kind"])


#: kind 0: a picked suffix; kind 1: a span (lo, hi) of windows that are known to repeat, under a key of its text.
_SUFFIX = "kh long, sh long, t long, at long, lo long, hi long, kind byte"


def text_key(text: Column, seed: int = 0) -> Column:
    return F.xxhash64(F.lit(seed), text)


@dataclass
class SuffixFamily:
    """Levels of sorted suffix arrays in tables bucketed by the suffix key. Level sizes are numbers of batches."""

    spark: SparkSession
    root: str
    buckets: int
    levels: list[tuple[int, str, str]] = field(default_factory=list)  # (batches, table, path)
    made: list[tuple[str, str]] = field(default_factory=list)

    def table(self, rows: DataFrame, kind: str) -> tuple[str, str]:
        """Write rows (already dealt by kh) as a bucketed, sorted table."""
        name = f"suffix_{kind}_{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{name}"
        rows.write.bucketBy(self.buckets, "kh").sortBy("kh").option("path", path).saveAsTable(name)
        self.made.append((name, path))
        return name, path

    def drop(self, name: str, path: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_path(self.spark, path)
        self.made.remove((name, path))

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Insert a batch (kh, t, at; bucketed by kh); returns the keys it has twice or shares with a level."""
        array = suffixes.groupBy("kh").agg(F.first("t").alias("t"), F.first("at").alias("at"), F.count(F.lit(1)).alias("n"))
        name, path = self.table(array, "array")
        scan = self.spark.table(name).select("kh", "n")
        found = F.col("n") > 1
        for i, (_, level, _) in enumerate(self.levels):
            scan = scan.join(self.spark.table(level).select("kh", F.lit(True).alias(f"in_{i}")), "kh", "left")
            found |= F.col(f"in_{i}").isNotNull()
        repeated = stage(scan.where(found).select("kh").coalesce(-(-self.buckets // BUCKETS_PER_FILE)), "repeated")
        self.levels.append((1, name, path))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            self._merge()
        return repeated

    def _merge(self) -> None:
        (size, new, new_path), (_, old, old_path) = self.levels.pop(), self.levels.pop()
        a, b = self.spark.table(old).alias("a"), self.spark.table(new).alias("b")
        both = a.join(b, F.col("a.kh") == F.col("b.kh"), "full").select(
            F.coalesce("a.kh", "b.kh").alias("kh"), F.coalesce("a.t", "b.t").alias("t"), F.coalesce("a.at", "b.at").alias("at"),
            (F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("n"))
        name, path = self.table(both, "array")
        self.levels.append((2 * size, name, path))
        self.drop(old, old_path)
        self.drop(new, new_path)

    def close(self) -> None:
        for name, path in list(self.made):
            self.drop(name, path)


def _texts(documents: DataFrame, text: str) -> tuple[DataFrame, DataFrame, int]:
    """(rows of t and text of LENGTH bytes and more, staged t and number of copies, seed without a clash of keys)."""
    for seed in range(16):
        rows = documents.where(F.octet_length(text) >= LENGTH).select(text_key(F.col(text), seed).alias("t"), F.col(text).alias("text"))
        digest = F.sha2("text", 256)
        copies = stage(rows.select("t", digest.alias("d"), F.octet_length("text").alias("size")).groupBy("t")
                       .agg(F.count(F.lit(1)).alias("copies"), F.max("size").cast("long").alias("size"), F.min("d").alias("lo"), F.max("d").alias("hi")), "texts")
        if not copies.where("lo <> hi").take(1):
            return rows, copies.select("t", "copies", "size"), seed
    raise RuntimeError("text keys clash under every seed")


def candidates(rows: DataFrame, batches: int) -> tuple[DataFrame, DataFrame]:
    """Picked suffixes whose key the family has found twice, and spans already known to repeat (both staged)."""
    spark = rows.sparkSession
    family = SuffixFamily(spark, fresh_path(spark, "family"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    suffixes = rows.mapInArrow(_suffix_rows, _SUFFIX).withColumn("batch", F.pmod(F.xxhash64("t"), F.lit(batches)).cast("int"))
    # The one shuffle of all suffixes; arrays, scans and merges work on equal buckets from here on.
    all_name, _ = family.table(suffixes.repartition(family.buckets, "kh"), "all")
    everything = spark.table(all_name).where("kind = 0").drop("kind")
    known = stage(spark.table(all_name).where("kind = 1").select("t", F.col("lo").alias("start"), F.col("hi").alias("stop")).distinct(), "known")
    repeated = None
    for b in range(batches):
        part = everything.where(F.col("batch") == b)
        found = family.add(part.select("kh", "t", "at").distinct())  # a text that came from several tasks is one
        repeated = found if repeated is None else repeated.union(found)
    out = stage(everything.drop("batch").join(repeated.distinct(), "kh").dropDuplicates(["kh", "t", "at", "lo"]), "candidates")
    family.close()
    return out, known


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the windows of each run that is to be settled."""
    seen: set[int] = set()
    for b in batches:
        out: dict[str, list] = {k: [] for k in ("t", "at", "lo", "hi", "kh", "need", "bytes")}
        for t, value, runs in zip(b.column("t").to_pylist(), b.column("text"), b.column("runs").to_pylist(), strict=True):
            if t in seen:
                continue
            seen.add(t)
            view = memoryview(value.as_buffer())
            for run in runs:
                for k in ("at", "lo", "hi", "kh", "need"):
                    out[k].append(run[k])
                out["t"].append(t)
                out["bytes"].append(bytes(view[run["lo"]:run["hi"] + LENGTH]))
        kinds = {"need": pa.bool_(), "bytes": pa.binary()}
        yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()], list(out))


def _joined(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(all bytes of the batch's runs, where each begins, its numbers)."""
    values = b.column("bytes")
    sizes = np.array([len(v.as_buffer()) for v in values], np.int64)
    data = np.frombuffer(b"".join([v.as_buffer() for v in values]), np.uint8)
    return data, np.cumsum(sizes) - sizes, {c: b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names if c != "bytes"}


def _parts(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(b), 2048):
        yield b.slice(at, 2048)


def _range_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each range of windows of each run: hash of the bytes all of the range's windows share, and of all its bytes."""
    for whole in batches:
        for b in _parts(whole):
            data, base, c = _joined(b)
            if not len(data):
                continue
            origin = c["at"] - (LENGTH - GRAM)  # of the first window that can hold the gram
            low, high = (c["lo"] - origin) // RANGE, (c["hi"] - origin) // RANGE
            n = high - low + 1
            of = np.repeat(np.arange(len(n)), n)
            number = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + low[of]
            first = origin[of] + number * RANGE
            last = np.minimum(first + RANGE - 1, c["at"][of])
            shift = base[of] - c["lo"][of]
            full = (first >= c["lo"][of]) & (last <= c["hi"][of])
            with np.errstate(over="ignore"):
                roll = _Rolling(data, 1)
                core = roll.between(shift + last, shift + first + LENGTH)
                # A range that the run holds only a part of is a class of its own.
                own = _mixed(_mixed(c["t"][of].view(np.uint64)) + c["at"][of].astype(np.uint64) * np.uint64(2) + np.uint64(1)) + c["lo"][of].astype(np.uint64)
                every = roll.between(np.where(full, shift + first, 0), np.where(full, shift + last + LENGTH, 0))
                every = np.where(full, every, own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c["kh"][of]), pa.array(number), pa.array(core.view(np.int64)), pa.array(every.view(np.int64)), pa.array(c["t"][of]), pa.array(c["at"][of]),
                 pa.array(c["lo"][of]), pa.array(np.maximum(first, c["lo"][of])), pa.array(np.minimum(last, c["hi"][of])), pa.array(c["need"][of])],
                ["kh", "range", "core", "every", "t", "at", "lo", "first", "last", "need"])


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both hashes of each window of the ranges that may repeat in part."""
    for whole in batches:
        for b in _parts(whole):
            if not len(b):
                continue
            data, base, c = _joined(b.drop_columns(["ranges"]))
            ranges = b.column("ranges")
            of = np.repeat(np.arange(len(b)), ranges.value_lengths().to_numpy())
            inner = ranges.flatten()
            first, last = inner.field("first").to_numpy(), inner.field("last").to_numpy()
            need = inner.field("need").to_numpy(zero_copy_only=False)
            n = last - first + 1
            back = np.repeat(np.arange(len(n)), n)
            p = np.arange(len(back)) - np.repeat(np.cumsum(n) - n, n) + first[back]
            start = base[of[back]] + p - c["lo"][of[back]]
            with np.errstate(over="ignore"):
                one, two = (_Rolling(data, s).between(start, start + LENGTH).view(np.int64) for s in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), pa.array(c["t"][of[back]]), pa.array(p), pa.array(need[back])],
                                             ["w1", "w2", "t", "p", "need"])


def repeated_spans(documents: DataFrame, text: str = "text", batches: int = BATCHES) -> tuple[DataFrame, int]:
    """(t, spans) of every text with something to remove, and the seed of its key ``t``.

    ``spans`` is an array of (start, stop) in bytes; they may overlap.
    """
    rows, copies, seed = _texts(documents, text)
    found, known = candidates(rows, batches)
    release(rows.sparkSession)
    first = [F.first(c).alias(c) for c in ("t", "at", "lo", "hi")]
    classes = stage(found.groupBy("kh", "sh").agg(F.count(F.lit(1)).alias("n"), *first), "classes")
    same = classes.where("n > 1").select("kh", "sh")
    whole = found.join(same, ["kh", "sh"]).select("t", F.col("lo").alias("start"), (F.col("hi") + LENGTH).alias("stop"))

    # Runs without an equal one, and one of each equal class they may share a part with.
    groups = classes.groupBy("kh").agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least")).where("classes > 1 AND least = 1").select("kh")
    runs = classes.join(groups, "kh").select("kh", "t", "at", "lo", "hi", (F.col("n") == 1).alias("need"))
    by_text = runs.groupBy("t").agg(F.collect_list(F.struct("at", "lo", "hi", "kh", "need")).alias("runs"))
    context = stage(rows.join(by_text, "t").mapInArrow(_contexts, "t long, at long, lo long, hi long, kh long, need boolean, bytes binary")
                    .dropDuplicates(["t", "at", "lo"]), "contexts")
    ranges = stage(context.mapInArrow(_range_rows, "kh long, range long, core long, every long, t long, at long, lo long, first long, last long, need boolean"), "ranges")
    by_bytes = ranges.groupBy("kh", "range", "core", "every").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("t", "at", "lo", "first", "last", "need")])
    parts = stage(by_bytes, "parts")
    # Ranges with equal bytes throughout repeat as a whole.
    equal_ranges = parts.where("n > 1").select("kh", "range", "core", "every")
    mostly = ranges.where("need").join(equal_ranges, ["kh", "range", "core", "every"]).select("t", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("stop"))
    # Ranges that share their core but not all bytes: one of each kind, window by window.
    mixed = parts.groupBy("kh", "range", "core").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("kh", "range", "core")
    asked = (parts.join(mixed, ["kh", "range", "core"])
             .groupBy("t", "at", "lo").agg(F.collect_list(F.struct("first", "last", (F.col("need") & (F.col("n") == 1)).alias("need"))).alias("ranges")))
    windows = stage(context.select("t", "at", "lo", "bytes").join(asked, ["t", "at", "lo"])
                    .mapInArrow(_window_rows, "w1 long, w2 long, t long, p long, need boolean"), "windows")
    release(rows.sparkSession)
    equal = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2")
    partly = windows.where("need").join(equal, ["w1", "w2"]).select("t", F.col("p").alias("start"), (F.col("p") + LENGTH).alias("stop")).union(mostly)

    copied = copies.where("copies > 1").select("t", F.lit(0).cast("long").alias("start"), F.col("size").alias("stop"))
    spans = whole.union(partly).union(known).union(copied).groupBy("t").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return spans, seed


def _union(spans: np.ndarray) -> np.ndarray:
    """Disjoint spans in order from (start, stop) rows."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.append(True, spans[1:, 0] > reach[:-1]))
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], 1)


def _spans_of(column: pa.Array, i: int) -> np.ndarray:
    value = column[i]
    if not value.is_valid or not len(value.values):
        return np.zeros((0, 2), np.int64)
    inner = value.values
    return _union(np.stack([inner.field("start").to_numpy(), inner.field("stop").to_numpy()], 1))


def _kept(text: bytes, spans: np.ndarray) -> bytes:
    cut, at = [], 0
    for start, stop in spans.tolist():
        cut.append(text[at:start])
        at = stop
    return b"".join([*cut, text[at:]])


def _with_spans(documents: DataFrame, text: str, batches: int) -> DataFrame:
    """Every row as a struct, with its text and its spans (null: none)."""
    spans, seed = repeated_spans(documents, text, batches)
    rows = documents.select(F.struct("*").alias("row"), F.col(text).alias("text"), text_key(F.col(text), seed).alias("t"))
    return rows.join(spans, "t", "left").select("row", "text", "spans")


def removal_report(documents: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""

    @arrow_udf("struct<n_bytes: long, n_removed: long, n_spans: long, kept_sha256: string>")
    def report(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for i, value in enumerate(texts):
            data = value.as_buffer().to_pybytes() if value.is_valid else b""
            cut = _spans_of(spans, i)
            left = _kept(data, cut)
            out.append({"n_bytes": len(data), "n_removed": len(data) - len(left), "n_spans": len(cut), "kept_sha256": hashlib.sha256(left).hexdigest()})
        return pa.array(out, pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]))

    rows = _with_spans(documents.select("doc_id", "text"), "text", batches)
    return rows.select(F.col("row.doc_id").alias("doc_id"), report(F.col("text"), F.col("spans")).alias("r")).select("doc_id", "r.*")


def remove_repeats(documents: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The documents with repeated bytes taken out of ``text``; every row and column stays.

    A character of which a part is removed goes as a whole. ``n_chars``, if there, is counted anew.
    """

    @arrow_udf("string")
    def kept(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for i, value in enumerate(texts):
            cut = _spans_of(spans, i)
            if not value.is_valid or not len(cut):
                out.append(value.as_py())
            else:
                out.append(_kept(value.as_buffer().to_pybytes(), cut).decode("utf-8", "ignore"))
        return pa.array(out, pa.string())

    rows = _with_spans(documents, "text", batches)
    done = rows.select(F.col("row").alias("row"), F.when(F.col("spans").isNull(), F.col("text")).otherwise(kept(F.col("text"), F.col("spans"))).alias("left"))
    new = {"text": F.col("left"), "n_chars": F.length("left").cast("long")}
    return done.select(*[(new[c] if c in new else F.col("row").getField(c)).alias(c) for c in documents.columns])

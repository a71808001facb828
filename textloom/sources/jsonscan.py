"""Rebuilding JSON objects that span lines (S4) or are concatenated.

Both are scans in file order: an object ends where the brace depth returns to zero. A split doesn't know the depth it
starts at, so there are two passes over the file:

* the summary pass reduces every split to what it does to the scanner's state, one row per split. States are
  composed along each file over these rows, which gives every split the state it starts in;
* the main pass runs the scanner in each scan task, a split at a time with a carry from batch to batch. An object
  inside a split is complete there. What stands before a split's first end or after its last is a fragment: at most
  two per split, and only they are shuffled, to be stitched with their neighbours.

Fragments after a file's last end are dropped before anything is gathered. Objects never cross an exchange unless they cross a
split. The numbers of chunks and objects rise in file order (the split's start plus the place inside it); they aren't gapless.

The state of the splits (some 40 bytes each) is broadcast up to ``BROADCAST_SPLITS``; beyond, rows are joined to it by a shuffle
and brought back into file order.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.session import materialize
from textloom.sources.jsonl import extract_text
from textloom.sources.positions import read_positioned

#: Splits whose state is broadcast.
BROADCAST_SPLITS = 1_000_000

# Strings are removed in two linear steps (escape pairs, then quoted runs): a single
# alternation pattern recurses per character in java.util.regex and overflows on long lines.
_ESCAPE = r"\\."
_QUOTED = r'"[^"]*"'
_TRAILING_SPACE = r"(?U)[\s\x1c-\x1f]+$"

_PIECES = "split long, kind string, nth long, body binary"
_OPEN, _CLOSE, _QUOTE, _BACKSLASH = (ord(c) for c in '{}"\\')


def _split_id() -> Column:
    return F.xxhash64("file", "block")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_SPLITS else df


def _with_state(rows: DataFrame, states: DataFrame, n_splits: int) -> DataFrame:
    """Rows with the state their split starts in, each split's rows together and in file order."""
    if n_splits <= BROADCAST_SPLITS:  # the scan's own order stays
        return rows.join(F.broadcast(states), "split")
    return rows.join(states, "split").repartition("split").sortWithinPartitions("split", "seq")


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """(split, whether it begins here, its rows) of consecutive rows of one split."""
    current = None
    for b in batches:
        if not len(b):
            continue
        split = b.column("split").to_numpy()
        cuts = np.flatnonzero(np.append(True, split[1:] != split[:-1])).tolist() + [len(b)]
        for at, stop in zip(cuts, cuts[1:]):
            yield int(split[at]), split[at] != current, b.slice(at, stop - at)
            current = split[at]


class _Pieces:
    """Objects and fragments of one split, as (split, kind, nth, body) rows."""

    def __init__(self, split: int):
        self.split, self.rows, self.ends = split, [], 0
        self.pending: list[bytes] = []

    def end(self, body: bytes) -> None:
        whole = b"".join(self.pending) + body
        self.rows.append((self.split, "whole" if self.ends else "head", self.ends, whole))
        self.ends += 1
        self.pending = []

    def close(self) -> None:
        self.rows.append((self.split, "tail" if self.ends else "middle", self.ends, b"".join(self.pending)))

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        cols = list(zip(*rows)) if rows else [[]] * 4
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["split", "kind", "nth", "body"])


def _scan(scanner: Callable[[pa.RecordBatch, bool, _Pieces], None]):
    """The main pass as a function of a task's batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = None
        for split, begins, rows in _by_split(batches):
            if begins:
                if pieces is not None:
                    pieces.close()
                    yield pieces.take()
                pieces = _Pieces(split)
            scanner(rows, begins, pieces)
            if pieces.rows:
                yield pieces.take()
        if pieces is not None:
            pieces.close()
            yield pieces.take()

    return run


def _stitched(pieces: DataFrame, splits: DataFrame, n_splits: int) -> DataFrame:
    """``(file, no, body)``: whole objects as they are, fragments joined over the splits they cross."""
    named = pieces.join(_small(splits.select("split", "file", "block"), n_splits), "split")
    whole = named.where("kind = 'whole'").select("file", (F.col("block") + F.col("nth")).alias("no"), "body")
    parts = named.where("kind <> 'whole'")
    # A head ends in its own split, a tail or a middle in the next split that has an end.
    ending = parts.groupBy("file", "block").agg(F.max(F.when(F.col("kind") == "head", F.col("block"))).alias("own"))
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    ending = ending.withColumn("next", F.first("own", ignorenulls=True).over(ahead))
    target = F.when(F.col("kind") == "head", F.col("block")).otherwise(F.col("next"))
    joined = parts.join(ending, ["file", "block"]).withColumn("no", target).where(F.col("no").isNotNull())
    # Of one split, the head comes before the tail, but they belong to different objects.
    ordered = F.array_sort(F.collect_list(F.struct("block", "body")))
    crossing = joined.groupBy("file", "no").agg(F.array_join(F.transform(ordered, lambda x: F.hex(x["body"])), "").alias("body"))
    return whole.unionByName(crossing.withColumn("body", F.unhex("body")))


def _unclosed(pieces: DataFrame, splits: DataFrame, n_splits: int) -> DataFrame:
    """``(file, no, body)``: what follows a file's last end, a split's share a row, blank ones left out."""
    named = pieces.where("kind <> 'whole'").join(_small(splits.select("split", "file", "block"), n_splits), "split")
    ends = named.groupBy("file").agg(F.max(F.when(F.col("kind") == "head", F.col("block"))).alias("last"))
    left = named.where("kind <> 'head'").join(_small(ends, n_splits), "file").where(F.col("last").isNull() | (F.col("block") >= F.col("last")))
    return left.where(F.col("body").cast("string").rlike(r"(?U)[^\s\x1c-\x1f]")).select(
        "file", (F.col("block") + F.col("nth")).alias("no"), "body")


# ---- S4


def _count(s: Column, ch: str) -> Column:
    return F.length(s) - F.length(F.translate(s, ch, ""))


def _scan_lines(rows: pa.RecordBatch, begins: bool, pieces: _Pieces) -> None:
    if begins:
        pieces.depth = rows.column("depth")[0].as_py()
    depth = pieces.depth + np.cumsum(rows.column("delta").to_numpy())
    lines = [x.as_buffer().to_pybytes() for x in rows.column("value")]
    start = 0
    for i in np.flatnonzero((depth == 0) & rows.column("brace").to_numpy(zero_copy_only=False)).tolist():
        pieces.end(b"\n".join(lines[start:i + 1]) + b"\n")
        start = i + 1
    if start < len(lines):
        pieces.pending.append(b"\n".join(lines[start:]) + b"\n")
    pieces.depth = int(depth[-1])


def _parses(body: Column) -> Column:
    """Whether Python's parser takes a text."""

    @F.arrow_udf("boolean")
    def check(texts: pa.Array) -> pa.Array:
        return pa.array([_loads(t) for t in texts.to_pylist()], pa.bool_())

    return check(body)


def _loads(text: str | None) -> bool:
    try:
        json.loads(text)
    except (TypeError, ValueError, RecursionError):
        return False
    return True


def rebuild_multiline(spark: SparkSession, paths: str | list[str] | DataFrame, on_error: str = "stop", keep_dropped: bool = False) -> DataFrame:
    """Lines are accumulated until a line ending in ``}`` or ``},`` closes the top-level
    object; trailing whitespace and commas are cut and the chunk is parsed strictly.

    The reference resets its buffer only after a successful parse, so after the first
    chunk that fails, nothing more of that file is recovered (``on_error="stop"``);
    ``"skip"`` drops only the bad chunk.  Returns ``file, chunk_no, chunk, status, key, text, obj``.

    ``keep_dropped`` returns what is dropped as well, with its reason for a status: ``invalid``, ``after_invalid`` (behind a
    file's first bad chunk) and ``unclosed`` (behind its last end).
    """
    if on_error not in ("stop", "skip"):
        raise ValueError("on_error must be 'stop' or 'skip'")
    pos = paths if isinstance(paths, DataFrame) else read_positioned(spark, paths)
    no_strings = F.regexp_replace(F.regexp_replace("value", _ESCAPE, ""), _QUOTED, "")
    delta = (_count(no_strings, "{") - _count(no_strings, "}")).alias("delta")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = materialize(
        pos.select("file", "block", delta).groupBy("file", "block").agg(F.sum("delta").alias("delta"))
        .select(_split_id().alias("split"), "file", "block", F.coalesce(F.sum("delta").over(before), F.lit(0)).alias("depth")), "line-splits")
    n_splits = splits.count()
    stripped = F.regexp_replace("value", _TRAILING_SPACE, "")
    brace = (stripped.endswith("}") | stripped.endswith("},")).alias("brace")
    rows = _with_state(pos.select(_split_id().alias("split"), "seq", F.col("value").cast("binary").alias("value"), delta, brace),
                       splits.select("split", "depth"), n_splits)
    pieces = materialize(rows.select("split", "value", "delta", "brace", "depth").mapInArrow(_scan(_scan_lines), _PIECES), "line-pieces")
    text = F.col("body").cast("string")
    chunks = _stitched(pieces, splits, n_splits).select("file", F.col("no").alias("chunk_no"), F.regexp_replace(text, "\n$", "").alias("chunk"))
    body = F.regexp_replace(F.regexp_replace("chunk", _TRAILING_SPACE, ""), ",+$", "")
    checked = chunks.withColumn("body", body)
    after_bad = F.lit(False)
    if on_error == "stop":
        first_bad = materialize(checked.where(~_parses(F.col("body"))).groupBy("file").agg(F.min("chunk_no").alias("bad_from")), "bad-chunks")
        checked = checked.join(_small(first_bad, first_bad.count()), "file", "left")
        after_bad = F.coalesce(F.col("chunk_no") > F.col("bad_from"), F.lit(False))
        if not keep_dropped:
            checked = checked.where(~after_bad)
    cols = ["file", "chunk_no", "chunk", "status", "key", "text", "obj"]
    parsed = extract_text(checked, "body").withColumn("status", F.when(after_bad, F.lit("after_invalid")).otherwise(F.col("status"))).select(*cols)
    if not keep_dropped:
        return parsed.where(F.col("status") != "invalid")
    left = _unclosed(pieces, splits, n_splits).select("file", F.col("no").alias("chunk_no"), F.col("body").cast("string").alias("chunk"), F.lit("unclosed").alias("status"))
    return parsed.unionByName(left, allowMissingColumns=True).select(*cols)


# ---- S5


def brace_places(data: np.ndarray, inside: bool, string_aware: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """(places of braces that count, +1 or -1 of each, whether a string is open at the end) of bytes.

    With ``string_aware``, braces in strings don't count; a quote after an odd run of backslashes isn't one.
    """
    at = np.flatnonzero((data == _OPEN) | (data == _CLOSE))
    if string_aware:
        quote = np.flatnonzero(data == _QUOTE)
        other = np.flatnonzero(data != _BACKSLASH)
        # Backslashes just before a quote: the gap to the nearest byte before it that is none.
        place = np.searchsorted(other, quote) - 1
        run = quote - 1 - np.where(place >= 0, other[np.maximum(place, 0)], -1)
        quote = quote[run % 2 == 0]
        within = (np.searchsorted(quote, at) + inside) % 2 == 1
        at = at[~within]
        inside = bool((len(quote) + inside) % 2)
    return at, np.where(data[at] == _OPEN, 1, -1), inside


def _joined(rows: pa.RecordBatch) -> bytes:
    return b"".join(x.as_buffer().to_pybytes() + b"}" for x in rows.column("value"))


def _summary(string_aware: bool):
    """Per split: its bytes, whether it turns strings inside out, and its change of depth from either state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        for split, begins, rows in _by_split(batches):
            if begins:
                first = rows.slice(0, 1).to_pylist()[0]
                done.append({k: first[k] for k in ("split", "file", "block", "file_size")}
                            | {"n_bytes": 0, "flips": False, "from_outside": 0, "from_inside": 0})
            got, raw = done[-1], _joined(rows)
            data = np.frombuffer(raw, np.uint8)
            flips = got["flips"]
            for name, state in (("from_outside", flips), ("from_inside", not flips)):
                _, step, after = brace_places(data, state, string_aware)
                got[name] += int(step.sum())
                if name == "from_outside":
                    got["flips"] = after
            got["n_bytes"] += len(raw)
        yield pa.RecordBatch.from_pylist(done, pa.schema([
            ("split", pa.int64()), ("file", pa.string()), ("block", pa.int64()), ("file_size", pa.int64()), ("n_bytes", pa.int64()),
            ("flips", pa.bool_()), ("from_outside", pa.int64()), ("from_inside", pa.int64())]))

    return run


def _scan_braces(string_aware: bool):
    def scan(rows: pa.RecordBatch, begins: bool, pieces: _Pieces) -> None:
        if begins:
            pieces.depth = rows.column("depth")[0].as_py()
            pieces.inside = rows.column("inside")[0].as_py()
        raw = _joined(rows)
        at, step, pieces.inside = brace_places(np.frombuffer(raw, np.uint8), pieces.inside, string_aware)
        depth = pieces.depth + np.cumsum(step)
        start = 0
        for i in at[(depth == 0) & (step < 0)].tolist():
            pieces.end(raw[start:i + 1])
            start = i + 1
        if start < len(raw):
            pieces.pending.append(raw[start:])
        if len(depth):
            pieces.depth = int(depth[-1])

    return scan


def _one_line(body: Column) -> Column:
    """Struct (ok, line): the object on one line if Python's parser takes it, else as it stands."""
    newlines = re.compile(r"[\r\n]+")

    @F.arrow_udf("struct<ok: boolean, line: string>")
    def lines(bodies: pa.Array) -> pa.Array:
        ok, out = [], []
        for b in bodies:
            text = b.as_buffer().to_pybytes().decode("utf-8", "replace")
            ok.append(_loads(text))
            out.append(newlines.sub(" ", text).strip(" ") if ok[-1] else text)
        return pa.StructArray.from_arrays([pa.array(ok, pa.bool_()), pa.array(out, pa.string())], ["ok", "line"])

    return lines.asNondeterministic()(body)


def rebuild_concatenated(spark: SparkSession, paths: str | list[str], string_aware: bool = False, keep_dropped: bool = False) -> DataFrame:
    """Character-level brace counting; like the reference's it takes no notice of strings, unless ``string_aware``.

    The file is read with ``}`` as the record separator, so rows stay small whatever the lines. Where the depth returns to
    zero at a ``}`` an object closes; the buffer is reset whether or not it parses. What follows the last ``}`` is never closed:
    a file whose rows have more bytes than the file had no ``}`` at its end, and its last row gives a ``}`` too many, which is
    taken off again. Returns ``file, obj_no, line`` for every object that parses strictly, as one line.

    ``string_aware``: a scanner with two states, in a string or not. A split's effect is a map of both states to
    (state, change of depth); the maps are composed along the file.

    ``keep_dropped`` returns what is dropped as well, as it stands, and a column ``status``: ``ok``, ``invalid`` or ``unclosed``
    (behind a file's last object).
    """
    pos = read_positioned(spark, paths, line_sep="}", by_size=True).withColumn("split", _split_id()).withColumn("value", F.col("value").cast("binary"))
    found = pos.select("split", "file", "block", "file_size", "value").mapInArrow(
        _summary(string_aware), "split long, file string, block long, file_size long, n_bytes long, flips boolean, from_outside long, from_inside long")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    inside = F.coalesce(F.sum(F.col("flips").cast("int")).over(before), F.lit(0)) % 2 == 1
    states = (materialize(found, "brace-splits").withColumn("inside", inside)
              .withColumn("delta", F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside")))
              .withColumn("depth", F.coalesce(F.sum("delta").over(before), F.lit(0)))
              # The last split of a file that doesn't end in "}".
              .withColumn("open_end", (F.sum("n_bytes").over(whole) > F.col("file_size")) & (F.lead("block").over(order).isNull())))
    splits = materialize(states.select("split", "file", "block", "depth", "inside", "open_end"), "brace-states")
    n_splits = splits.count()
    rows = _with_state(pos.select("split", "seq", "value"), splits.select("split", "depth", "inside"), n_splits)
    pieces = materialize(rows.select("split", "value", "depth", "inside").mapInArrow(_scan(_scan_braces(string_aware)), _PIECES), "brace-pieces")
    pieces = _without_false_end(pieces, splits, n_splits)
    objects = _stitched(pieces, splits, n_splits)
    lines = objects.select("file", F.col("no").alias("obj_no"), _one_line(F.col("body")).alias("got")).select(
        "file", "obj_no", "got.line", F.when(F.col("got.ok"), F.lit("ok")).otherwise(F.lit("invalid")).alias("status"))
    if not keep_dropped:
        return lines.where(F.col("status") == "ok").drop("status")
    left = _unclosed(pieces, splits, n_splits).select("file", F.col("no").alias("obj_no"), F.col("body").cast("string").alias("line"), F.lit("unclosed").alias("status"))
    return lines.unionByName(left)


def _without_false_end(pieces: DataFrame, splits: DataFrame, n_splits: int) -> DataFrame:
    """The pieces without the ``}`` that was added at the end of files that don't end in one.

    If it closed an object, that is the last of its split and the split's tail is empty: it becomes a fragment again. If not, it is the
    last byte of the tail.
    """
    ends = splits.where("open_end").select("split", F.lit(True).alias("open"))
    last = pieces.join(_small(ends, n_splits), "split").groupBy("split").agg(
        F.coalesce(F.max(F.when(F.col("kind").isin("head", "whole"), F.col("nth"))), F.lit(-1)).alias("last"),
        F.max(F.when(F.col("kind").isin("tail", "middle"), F.octet_length("body"))).alias("left"))
    marked = pieces.join(_small(last, n_splits), "split", "left")
    object_end = F.col("kind").isin("head", "whole")
    false = F.when(F.col("left") == 0, object_end & (F.col("nth") == F.col("last"))).otherwise(~object_end & F.col("left").isNotNull())
    false = F.coalesce(false, F.lit(False))
    kind = F.when(false & object_end, F.when(F.col("kind") == "head", F.lit("middle")).otherwise(F.lit("tail"))).otherwise(F.col("kind"))
    body = F.when(false, F.substring(F.col("body"), F.lit(1), F.octet_length("body") - 1)).otherwise(F.col("body"))
    return marked.select("split", kind.alias("kind"), "nth", body.alias("body"))

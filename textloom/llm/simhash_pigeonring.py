"""SimHash near-duplicates with pigeonring filtering.

A 64-bit fingerprint is cut into ``distance + 1`` segments that stand in a ring. If two fingerprints differ in
at most ``distance`` bits, some chain of segments starts with an equal one, and all its first l segments
together differ in at most l * distance / (distance + 1) bits (the strong form of the pigeonring principle; Qin
and Xiao, "Pigeonring: A Principle for Faster Thresholded Similarity Search"). So fingerprints are dealt by (start, first
segment); inside a bucket the second segment must be within one bit, found by probing; every longer chain is
checked against its budget before the full distance.

Only distinct fingerprints are dealt: exact copies meet in a group count before. A bucket links its members to
one representative per connected part instead of listing pairs, and pairs already connected aren't
compared. Buckets of more than ``HOT`` fingerprints are dealt again by the second segment with each of its bits
masked in turn, which loses no pair within one bit.

Defined results: texts without words (null ones too) have fingerprint zero and are linked like any other;
repeated rows are rows of one class; a null doc_id takes part but is never a component's id (null if it has no other).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from textloom.llm.components import components
from textloom.llm.staging import kept_rows, only, stage, text_digest
from textloom.llm.word_ids import give_back

#: Fixed values of the contract: shingle length, hash seed, most differing bits.
SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Buckets with more distinct fingerprints are dealt again.
HOT = 100_000
#: Bucket rows handled together on average.
ROWS = 50_000
#: Pairs compared at a time, and group sizes from which pivots are tried first.
BLOCK = 1 << 20
DENSE = 512
PIVOTS = 64


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned fingerprint of one text."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    else:
        size = np.fromiter(map(len, words), np.int64, n) + 1
        end = np.cumsum(size)
        start = (end - size)[:n - shingle + 1].tolist()
        stop = (end - 1)[shingle - 1:].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[i:j], seed) for i, j in zip(start, stop, strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """Fingerprint of a text column, as a long with the same bits."""

    @arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        out = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle, seed) for t in texts), np.uint64, len(texts))
        give_back()
        return pa.array(out.view(np.int64))

    return prints(text)


def segments(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of the ring's segments: one more than the distance, as even as they can be."""
    n = distance + 1
    widths = [64 // n + (i < 64 % n) for i in range(n)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


class _Links:
    """Connected parts of a bucket's members, as union by least index."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            ra, rb = root[a], root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:  # point every member straight at its root
                up = root[root]
                if np.array_equal(up, root):
                    break
                np.copyto(root, up)


def _chain_ok(diff: np.ndarray, start: int, ring: list[tuple[int, int]], distance: int) -> np.ndarray:
    """Whether each prefix of the chain from ``start`` keeps within its proportional budget."""
    n = len(ring)
    spent = np.zeros(len(diff), np.int64)
    alive = np.ones(len(diff), bool)
    for length in range(1, n + 1):
        shift, width = ring[(start + length - 1) % n]
        part = (diff >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        spent += np.bitwise_count(part)
        alive &= spent <= length * distance // n
    return alive


def _compare(fp: np.ndarray, a: np.ndarray, b: np.ndarray, start: int, ring: list, distance: int, links: _Links) -> None:
    """Link all pairs of a x b within the distance that aren't connected yet, a block at a time."""
    step = max(1, BLOCK // max(len(b), 1))
    for at in range(0, len(a), step):
        left = a[at:at + step]
        parts = links.root[b]
        if len(b) > DENSE and (links.root[left] == parts[0]).all() and (parts == parts[0]).all():
            continue
        i, j = np.nonzero(links.root[left][:, None] != parts[None, :])
        x, y = left[i], b[j]
        ok = _chain_ok(fp[x] ^ fp[y], start, ring, distance)
        links.join(x[ok], y[ok])


def _expand(first: np.ndarray, count: np.ndarray, a: np.ndarray, b: np.ndarray):
    """All pairs of members of the groups a and b, some million at a time."""
    size = count[a] * count[b]
    ends = np.cumsum(size)
    at = 0
    while at < len(a):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, "right")))
        n = size[at:stop]
        of = np.repeat(np.arange(at, stop), n)
        within = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        yield first[a[of]] + within // count[b[of]], first[b[of]] + within % count[b[of]]
        at = stop


def _connect(fp: np.ndarray, bucket: np.ndarray, start: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (u, v) that connect the near fingerprints of each bucket; all buckets share the segment at ``start``."""
    ring = segments(distance)
    shift, width = ring[(start + 1) % len(ring)]
    second = ((fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
    full = bucket << width | second
    order = np.lexsort((fp, full))
    fp, full = fp[order], full[order]
    links = _Links(len(fp))
    values, first, count = np.unique(full, return_index=True, return_counts=True)
    group = lambda k: np.arange(first[k], first[k] + count[k])
    alone = np.flatnonzero(count > 1)
    pairs = [(alone, alone)]
    for bit in range(width):
        partner = np.minimum(np.searchsorted(values, values ^ (1 << bit)), len(values) - 1)
        found = np.flatnonzero((values[partner] == values ^ (1 << bit)) & (values < values ^ (1 << bit)))
        pairs.append((found, partner[found]))
    for a, b in pairs:
        small = count[a] * count[b] <= DENSE * DENSE
        for i, j in _expand(first, count, a[small], b[small]):
            ok = (i != j) & _chain_ok(fp[i] ^ fp[j], start, ring, distance)
            links.join(i[ok], j[ok])
        for k, m in zip(a[~small].tolist(), b[~small].tolist(), strict=True):
            if k == m:  # a dense group mostly hangs together: a few pivots connect it without pairs
                _pivots(fp, group(k), distance, links)
            _compare(fp, group(k), group(m), start, ring, distance, links)
    linked = np.flatnonzero(links.root != np.arange(len(fp)))
    return fp[linked], fp[links.root[linked]]


def _pivots(fp: np.ndarray, members: np.ndarray, distance: int, links: _Links) -> None:
    """Link members to pivots of still small parts, as long as there are several parts."""
    for _ in range(PIVOTS):
        parts, n = np.unique(links.root[members], return_counts=True)
        if len(parts) == 1:
            return
        pivot = parts[np.argmin(n)]
        near = members[np.bitwise_count(fp[members] ^ fp[pivot]) <= distance]
        links.join(near, np.full(len(near), pivot))


def near_edges(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints (column fp) within ``distance``, one per member and bucket at most."""
    ring = segments(distance)
    if distance < 1:
        return prints.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    field = lambda i: F.shiftrightunsigned("fp", ring[i][0]).bitwiseAND((1 << ring[i][1]) - 1).cast("int")
    n = len(ring)
    dealt = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("start"), field(i).alias("first"), field((i + 1) % n).alias("second"), F.lit(ring[(i + 1) % n][1]).alias("width"))
        for i in range(n)])).alias("k")).select("fp", "k.*")
    hot = dealt.groupBy("start", "first").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > HOT).select("start", "first", F.lit(True).alias("hot"))
    marked = dealt.join(hot, ["start", "first"], "left")
    masks = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda b: F.struct(
        b.alias("bit"), F.col("second").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1), b))).alias("rest")))
    again = F.when(F.col("hot"), masks).otherwise(F.array(F.struct(F.lit(-1).alias("bit"), F.lit(0).alias("rest"))))
    bucketed = marked.select("fp", "start", "first", F.explode(again).alias("m")).select("fp", "start", "first", "m.bit", "m.rest")

    # Buckets are small as a rule, so some hundreds of them go to Python together.
    deals = max(1, n * prints.count() // ROWS)
    whole = F.xxhash64("start", "first", "bit", "rest")

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        u, v = [], []
        for start, part in rows.groupby("start"):
            _, bucket = np.unique(part[["first", "bit", "rest"]].to_numpy(np.int64) @ np.array([1 << 32, 1 << 20, 1]), return_inverse=True)
            a, b = _connect(part["fp"].to_numpy(np.int64).view(np.uint64), bucket, int(start), distance)
            u.append(a.view(np.int64))
            v.append(b.view(np.int64))
        return pd.DataFrame({"u": np.concatenate(u), "v": np.concatenate(v)})

    return bucketed.groupBy(F.pmod(whole, F.lit(deals)).alias("deal")).applyInPandas(link, "u long, v long")


def _roots(classes: DataFrame, distance: int) -> DataFrame:
    """(fp, root) of every fingerprint that is linked to another one, the roots themselves included."""
    linked = components(near_edges(classes.select("fp"), distance))
    return linked.select(F.col("u").alias("fp"), "root").union(linked.select(F.col("root").alias("fp"), "root").distinct())


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every document."""
    rows = only(documents, "doc_id", "text")
    rows = stage(rows.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    # Members of linked classes, roots included, with the least doc_id of their component.
    named = stage(_roots(classes, distance).join(classes, "fp"), "members")
    best = named.groupBy("root").agg(F.min("least").alias("component"))
    of = named.select("fp", "root").join(best, "root").select("fp", "component")
    component = classes.join(of.withColumn("linked", F.lit(True)), "fp", "left").select(
        "fp", F.when(F.col("linked"), F.col("component")).otherwise(F.col("least")).alias("component_id"))
    return (rows.join(component, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def deduplicate(documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component; every column stays.

    It is the row with the least (doc_id, digest of the text), a null doc_id after all others; so rows are told apart by id and
    text, and repeated or missing ids neither lose a document nor save a copy. Of rows that agree in both, one stays.
    """
    rows = only(documents, "doc_id", "text")
    rows = stage(rows.select("doc_id", text_digest(F.col("text")).alias("digest"), fingerprint_column(F.col("text"), shingle).alias("fp")), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest"))
    classes = stage(rows.groupBy("fp").agg(first.alias("first")), "classes")
    component = F.coalesce("root", "fp")
    found = classes.join(_roots(classes, distance), "fp", "left").groupBy(component.alias("component")).agg(F.min("first").alias("first"))
    keep = stage(found.select("first.doc_id", "first.digest", F.lit(True).alias("chosen")), "kept-ids")
    copies = rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    same = copies["doc_id"].eqNullSafe(keep["doc_id"]) & (copies["digest"] == keep["digest"])
    decided = copies.join(keep, same, "left").select(copies["doc_id"], copies["digest"], "n", "chosen")
    # A chosen row that occurs several times is kept once.
    once = F.array(F.lit(True), F.lit(False))
    per_row = F.when(F.col("chosen").isNull(), F.array(F.lit(False))).when(F.col("n") > 1, once).otherwise(F.array(F.lit(True)))
    return kept_rows(documents, decided.select("doc_id", "digest", F.explode(per_row).alias("kept")))

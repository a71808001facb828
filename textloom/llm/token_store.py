"""Token-id store: raw id payloads in shard files, and a minimal perfect hash index over the document keys.

Payload files. Documents are range-dealt by key into shards, in ascending key order inside and across them. A key
with the rows of several shards (repeated ids, null ids) is dealt over as many. A
shard file holds the raw little-endian ids of its documents, each closed by the end id, and then one record
per document: key (8 bytes; null flag in the next byte), number of ids (8 bytes). Spark's text writer writes
the files (its line separator is the end id's bytes), so its commit protocol covers lost tasks, and any file
system Spark reaches will do.

Index. Keys go to buckets by hash; each bucket gets a minimal perfect hash by compress, hash and displace: a
key's group gives a seed, the seeded hash gives its slot, no two keys share a slot and none is free. A slot
holds a 32-bit fingerprint of its key, the shard, the offset in the file and the number of ids. A lookup
costs one hash, one seed and one slot; a key that isn't in the store is refused by its fingerprint (a foreign
key passes with a chance of 2**-32).

Reading. ``read`` gives the ids of the keys asked for: the index names shard file, offset and number of ids, and a task
reads those byte ranges alone, neighbours in one go. So the bytes read follow the keys asked, not the store. The
store's folder must be on a file system that pyarrow opens too (a local or mounted folder, HDFS, S3, GCS, Azure).

Defined results: null text is the empty document (the end id alone); documents with equal keys are kept in
file order, shard by shard, and copy c of a key is found under (key, c); a null key is a key of its own, below all others; an
empty table gives an empty store; a key asked twice is answered twice, a key that isn't there not at all; a payload that
is shorter than the index says is an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.staging import only
from textloom.llm.word_ids import encoder, give_back, slices
from textloom.session import fresh_path

#: Keys per index bucket on average (a bucket is built and probed in one task), and per seed group.
BUCKET_KEYS = 20_000
GROUP_KEYS = 4
#: Ids of a shard file that one task reads together, so that a file of one very frequent key is read by several tasks.
BLOCK_IDS = 1 << 24
#: Ids handled at a time in a reading task; a longer document is handled alone.
READ_IDS = 1 << 21
RECORD = np.dtype([("key", "<i8"), ("null", "u1"), ("n", "<i8")])


def _mix(x: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """A 64-bit finaliser over key hashes, by seed."""
    with np.errstate(over="ignore"):
        x = x ^ (np.asarray(seed, np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build_mph(hashes: np.ndarray) -> np.ndarray:
    """Seeds by group of a minimal perfect hash over distinct 64-bit hashes (compress, hash, displace)."""
    n = len(hashes)
    groups = max(1, -(-n // GROUP_KEYS))
    group = (_mix(hashes, 0) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=groups)
    starts = np.cumsum(sizes) - sizes
    seeds, taken = np.zeros(groups, np.uint32), np.zeros(n, bool)
    tries = np.arange(1, 257, dtype=np.uint64)
    for g in np.argsort(-sizes, kind="stable"):  # crowded groups first, while slots are free
        k = int(sizes[g])
        if not k:
            break
        keys = hashes[order[starts[g]:starts[g] + k]]
        base = np.uint64(0)
        while True:
            slots = (_mix(keys[None, :], (tries + base)[:, None]) % np.uint64(n)).astype(np.int64)
            ok = ~taken[slots].any(axis=1)
            if k > 1 and ok.any():
                s = np.sort(slots, axis=1)
                ok &= (s[:, 1:] != s[:, :-1]).all(axis=1)
            if ok.any():
                at = int(np.argmax(ok))
                seeds[g] = int(tries[at] + base)
                taken[slots[at]] = True
                break
            base += np.uint64(256)
    return seeds


def mph_slots(hashes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    """Slot of each hash: two hash evaluations, whatever the number of keys."""
    group = (_mix(hashes, 0) % np.uint64(len(seeds))).astype(np.int64)
    return (_mix(hashes, seeds[group]) % np.uint64(n)).astype(np.int64)


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (_mix(hashes, 0xFFFFFFFF) >> np.uint64(32)).astype(np.uint32)


def key_hash(key: Column, copy: Column) -> Column:
    return F.xxhash64(F.coalesce(key, F.lit(0)), key.isNull(), copy.cast("long"))


def _bounds(documents: DataFrame, per_shard: int) -> tuple[np.ndarray, int]:
    """(lowest keys of the shards that follow the first with a key, number of shards of null keys only); one or two scans of the key column.

    A key of which there are several shards' rows is there as often.
    """
    rows, nulls = documents.agg(F.count("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    shards = max(1, -(-rows // per_shard))
    if shards == 1:
        return np.zeros(0, np.int64), nulls // per_shard
    cuts = [i / shards for i in range(1, shards)]
    got = documents.agg(F.percentile_approx("doc_id", cuts, max(10_000, 10 * shards))).first()[0]
    return np.array(got, np.int64), nulls // per_shard


def _shards(key: np.ndarray, null: np.ndarray, row: np.ndarray, bounds: np.ndarray, null_shards: int) -> np.ndarray:
    """Shard of each row: that of its key; rows of a key with several shards take turns by their number ``row``."""
    low, high = np.searchsorted(bounds, key, "left"), np.searchsorted(bounds, key, "right")
    own = null_shards + low + np.where(high > low, 1 + row % np.maximum(high - low, 1), 0)
    return np.where(null, row % (null_shards + 1), own).astype(np.int32)


def write_store(documents: DataFrame, path: str, tokenizer: str, end_id: int = 2, width: int = 2, per_shard: int = 2048) -> None:
    """Write ``path/ids`` (payload files by shard), ``path/keys`` (their records), ``path/shards`` (totals) and ``path/index``.

    ``width`` is the bytes of an id in the files: 2 for vocabularies up to 65,536, else 4.
    """
    spark = documents.sparkSession
    rows = only(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bounds, null_shards = _bounds(rows, per_shard)
    hot = sorted({int(k) for k in bounds[1:][bounds[1:] == bounds[:-1]]})  # keys of several shards: fewer than shards
    dtype = f"<u{width}"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        done = TaskContext.get().partitionId()  # a task that runs again sees the same rows in the same order
        for b in batches:
            for first, texts in slices(b.column("text")):
                ids, at = enc.encode(texts)
                raw = ids.astype(dtype).tobytes()
                at = (at * width).tolist()
                keys = b.column("doc_id").slice(first, len(texts))
                null = keys.is_null().to_numpy(zero_copy_only=False)
                key = keys.fill_null(0).to_numpy()
                shard = _shards(key, null, np.arange(done, done + len(key)), bounds, null_shards)
                done += len(key)
                record = np.zeros(len(key), RECORD)
                record["key"], record["null"], record["n"] = key, null, np.diff(at) // width + 1
                tail = record.tobytes()
                size = RECORD.itemsize
                n = len(key)
                values = [raw[at[i]:at[i + 1]] for i in range(n)] + [tail[i * size:(i + 1) * size] for i in range(n)]
                place = pa.array(np.arange(2 * n) % n)
                # Equal keys: ordered by content, the same in payload and records.
                tie = [zlib.crc32(v) for v in values[:n]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard).take(place), pa.array(np.repeat([0, 1], n).astype(np.int8)), keys.take(place),
                     pa.array(tie, pa.int64()).take(place), pa.array(np.diff(at) // width).cast(pa.int64()).take(place),
                     pa.array(values, pa.binary())],
                    ["shard", "kind", "doc_id", "tie", "size", "value"])
        give_back()

    coded = rows.mapInArrow(encode, "shard int, kind byte, doc_id long, tie long, size long, value binary")
    (coded.repartition(len(bounds) + null_shards + 1, "shard")
     .sortWithinPartitions("shard", "kind", F.col("doc_id").asc_nulls_first(), "tie", "size")
     .select("shard", F.col("value").cast("string").alias("value"))
     .write.partitionBy("shard").option("lineSep", end_id.to_bytes(width, "little").decode("latin-1")).text(f"{path}/ids"))

    records = _scan(spark, path, width)
    if hot or null_shards:  # copies of a key are numbered on from shard to shard
        spread = F.col("doc_id").isin(hot) if hot else F.lit(False)
        spread = F.coalesce(spread, F.lit(False)) | (F.col("doc_id").isNull() & F.lit(null_shards > 0))
        parts = records.where(spread).groupBy("doc_id", "shard").agg(F.count(F.lit(1)).alias("rows"))
        earlier = Window.partitionBy("doc_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select(F.col("doc_id").alias("k"), F.col("shard").alias("s"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
        records = (records.join(parts, F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("shard") == F.col("s")), "left")
                   .select("shard", "offset", "n", "doc_id", (F.col("copy") + F.coalesce("before", F.lit(0))).alias("copy")))
    records.write.parquet(f"{path}/keys")
    keys = spark.read.parquet(f"{path}/keys")
    totals = keys.groupBy("shard").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    names = _files(spark, path).select("shard", F.regexp_extract("path", "/ids/(.*)$", 1).alias("file"))
    (totals.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
     .join(names, "shard").write.parquet(f"{path}/shards"))

    n_docs = spark.read.parquet(f"{path}/shards").agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    buckets = max(1, -(-n_docs // BUCKET_KEYS))
    hashed = keys.withColumn("hash", key_hash(F.col("doc_id"), F.col("copy")))
    (hashed.withColumn("bucket", F.pmod(F.col("hash"), F.lit(buckets)).cast("int"))
     .select("bucket", "hash", "shard", "offset", "n")
     .groupBy("bucket").applyInPandas(_index_bucket, "bucket int, n long, seeds binary, prints binary, shards binary, offsets binary, sizes binary")
     .withColumn("buckets", F.lit(buckets)).write.parquet(f"{path}/index"))


def _index_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    hashes = rows["hash"].to_numpy(np.int64).view(np.uint64)
    seeds = build_mph(hashes)
    slot = mph_slots(hashes, seeds, len(hashes))
    order = np.argsort(slot)
    column = lambda name, kind: rows[name].to_numpy()[order].astype(kind).tobytes()
    return pd.DataFrame({"bucket": [int(rows["bucket"].iloc[0])], "n": [len(rows)], "seeds": [seeds.tobytes()],
                         "prints": [_fingerprints(hashes)[order].tobytes()], "shards": [column("shard", "<i4")],
                         "offsets": [column("offset", "<i8")], "sizes": [column("n", "<i8")]})


def _records(content: bytes, width: int) -> np.ndarray:
    """The document records at a shard file's end: as many as account for all ids before them."""
    step = RECORD.itemsize + width
    most = len(content) // step
    wide = np.dtype([("record", RECORD), ("sep", f"V{width}")])
    size = 256
    while True:
        size = min(size * 8, most)
        tail = np.frombuffer(content, wide, size, len(content) - size * step)["record"]
        with np.errstate(over="ignore"):
            covered = np.cumsum(tail["n"][::-1] * width + step)
        hit = np.flatnonzero(covered == len(content))
        if len(hit):
            return tail[len(tail) - int(hit[0]) - 1:]
        if size == most:
            raise ValueError("damaged shard file: its records don't account for its ids")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """The payload files with their shard; it is taken from the path, as an empty store has no partition folders to infer it from."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/ids")
            .withColumn("shard", F.regexp_extract("path", "/shard=([0-9]+)/", 1).try_cast("int")).where("shard IS NOT NULL"))


def _scan(spark: SparkSession, path: str, width: int) -> DataFrame:
    """A row per document of every shard file, from the records at its end: shard, offset (in ids), n, doc_id, copy."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, content in zip(b.column("shard").to_pylist(), b.column("content"), strict=True):
                raw = content.as_buffer()
                if raw is None or not raw.size:
                    continue
                rec = _records(memoryview(raw), width)
                n = rec["n"].astype(np.int64)
                key = pd.Series(rec["key"].astype(np.int64))
                null = rec["null"].astype(bool)
                copy = pd.DataFrame({"k": key, "z": null}).groupby(["k", "z"]).cumcount().to_numpy(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), shard, np.int32)), pa.array(np.cumsum(n) - n), pa.array(n),
                     pa.array(key.to_numpy(), mask=null), pa.array(copy)], ["shard", "offset", "n", "doc_id", "copy"])
        give_back()

    return _files(spark, path).select("shard", "content").mapInArrow(scan, "shard int, offset long, n long, doc_id long, copy long")


def stored_keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys of the store (doc_id, copy), as read from the files' records."""
    return spark.read.parquet(f"{path}/keys").select("doc_id", "copy")


def lookup(keys: DataFrame, path: str) -> DataFrame:
    """Shard, offset and number of ids of every key (doc_id, copy) the store holds, by the index alone."""
    spark = keys.sparkSession
    index = spark.read.parquet(f"{path}/index")
    head = index.select("buckets").first()
    buckets = head[0] if head else 1
    asked = keys.select("doc_id", "copy", key_hash(F.col("doc_id"), F.col("copy")).alias("hash")).withColumn(
        "bucket", F.pmod(F.col("hash"), F.lit(buckets)).cast("int"))

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(right) or not len(left):
            return pd.DataFrame({c: [] for c in ("doc_id", "copy", "shard", "offset", "n")})
        row = right.iloc[0]
        hashes = left["hash"].to_numpy(np.int64).view(np.uint64)
        slot = mph_slots(hashes, np.frombuffer(row["seeds"], np.uint32), int(row["n"]))
        here = np.frombuffer(row["prints"], np.uint32)[slot] == _fingerprints(hashes)
        slot, found = slot[here], left[here]
        return pd.DataFrame({"doc_id": found["doc_id"].astype("Int64").to_numpy(), "copy": found["copy"].to_numpy(),
                             "shard": np.frombuffer(row["shards"], "<i4")[slot], "offset": np.frombuffer(row["offsets"], "<i8")[slot],
                             "n": np.frombuffer(row["sizes"], "<i8")[slot]})

    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(
        probe, "doc_id long, copy long, shard int, offset long, n long")


def _ranges(offset: np.ndarray, n: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of the stretches of rows (by ascending offset) whose places touch or overlap, ``most`` ids each or one more row."""
    end = np.maximum.accumulate(offset + n)
    first = 0
    for i in range(1, len(offset) + 1):
        if i == len(offset) or offset[i] > end[i - 1] or end[i] - offset[first] > most:
            yield first, i
            first = i


def _payloads(places: DataFrame, path: str, width: int, digest: bool) -> DataFrame:
    """doc_id, copy, start, n and the ids (or their crc32) of each place (doc_id, copy, shard, offset, n); only its bytes are read."""
    shards = places.sparkSession.read.parquet(f"{path}/shards").select("shard", "first_id", "file")
    dtype, most = f"<u{width}", READ_IDS

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(path)
        name, source = None, None
        for b in batches:
            file = b.column("file").to_numpy(zero_copy_only=False)
            offset, n = b.column("offset").to_numpy(), b.column("n").to_numpy()
            cuts = [0, *(np.flatnonzero(file[1:] != file[:-1]) + 1).tolist(), len(file)]
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                if start == stop:
                    continue
                if file[start] != name:
                    if source is not None:
                        source.close()
                    name = file[start]
                    source = store.open_input_file(f"{base}/ids/{name}")
                for i, j in _ranges(offset[start:stop], n[start:stop], most):
                    at, size = offset[start + i:start + j], n[start + i:start + j]
                    lowest = int(at[0])
                    wanted = int((at + size).max()) - lowest
                    raw = source.read_at(wanted * width, lowest * width)
                    if len(raw) != wanted * width:
                        raise ValueError(f"damaged shard file {name}: ids {lowest} to {lowest + wanted} aren't all there")
                    ids = np.frombuffer(raw, dtype)
                    parts = [ids[o:o + k] for o, k in zip((at - lowest).tolist(), size.tolist(), strict=True)]
                    if digest:
                        value = pa.array([zlib.crc32(part.astype("<u4")) for part in parts], pa.int64())
                    else:
                        bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                        value = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(parts).astype(np.int32)))
                    rows = b.slice(start + i, j - i)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("doc_id"), rows.column("copy"), rows.column("start"), rows.column("n"), value],
                        ["doc_id", "copy", "start", "n", "value"])
        if source is not None:
            source.close()
        give_back()

    located = (places.join(shards, "shard").withColumn("start", F.col("first_id") + F.col("offset"))
               .repartition("shard", F.floor(F.col("offset") / BLOCK_IDS)).sortWithinPartitions("shard", "offset", "n")
               .select("doc_id", "copy", "start", "n", "offset", "file"))
    return located.mapInArrow(fetch, f"doc_id long, copy long, start long, n long, value {'long' if digest else 'array<int>'}")


def read(keys: DataFrame, path: str, width: int = 2) -> DataFrame:
    """doc_id, copy, start among all ids, and the ids (end id included) of every key (doc_id, copy) the store holds."""
    return _payloads(lookup(keys, path), path, width, digest=False).select("doc_id", "copy", "start", F.col("value").alias("ids"))


def read_documents(keys: DataFrame, path: str, width: int = 2) -> DataFrame:
    """For every key: start among all ids, n_tokens and ids_crc32 of the payload at the place the index gives."""
    return _payloads(lookup(keys, path), path, width, digest=True).select(
        "doc_id", "start", F.col("n").alias("n_tokens"), F.col("value").alias("ids_crc32"))


def store_documents(documents: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write a documents table as a token store, then read every document back through the index."""
    spark = documents.sparkSession
    path = fresh_path(spark, "tokens")
    write_store(documents, path, tokenizer, end_id)
    return read_documents(stored_keys(spark, path), path)

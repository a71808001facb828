"""Exact deduplication: counting quotient filters find repeated fingerprints, bytes decide.

1. One scan of the texts writes a narrow table: doc_id, a fingerprint of ``bits`` bits, a SHA-256 digest and a row number.
2. Each partition builds a counting quotient filter per block of fingerprints (a block is a range of leading bits); a hot
   text is one entry with a count. The filters of a block merge without loss (``quotient_filter``).
3. Only texts whose fingerprint counts more than one move: they are grouped by their bytes, and every distinct text of
   a map task crosses the shuffle once, however many copies there are. Different texts that share a fingerprint part here.
4. Rows find their verified class by (fingerprint, digest). Two texts of one fingerprint and one digest would be a
   collision of SHA-256; the verified classes are checked for it and the job fails rather than joining them.

Fingerprints with a thousandth of all rows and more are at most a thousand, known by their counts: they are
broadcast, so no hot key takes part in a shuffle. The others are broadcast below ``BROADCAST_ROWS`` and shuffled beyond.

Defined results: null and empty texts are equal; of equal texts the row with the largest doc_id stays, and of repeated rows with
that doc_id exactly one; a null doc_id is smaller than any other (keep_id is null only where no copy has an id); an empty table gives an
empty result; other columns, whatever their names, are ignored by the report and kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.quotient_filter import build, entries, merge, summed
from textloom.llm.staging import kept_rows, only, stage, text_digest

#: Bits of a fingerprint; 2**-16 of 5e10 texts then share one by chance, and are told apart by their bytes.
BITS = 48
#: Expected fingerprints of a block at most, and fingerprints a task holds before it gives its filters out.
BLOCK_ROWS = 4_000_000
#: Repeated fingerprints up to which they are broadcast (two longs each).
BROADCAST_ROWS = 1_000_000
#: A fingerprint with one in so many rows is hot.
HOT_SHARE = 1_000


def _text(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def _print(text: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 64 - bits)


def block_bits(rows: int, tasks: int, bits: int) -> int:
    """Leading bits that name a block: as many blocks as tasks, more if they would hold over BLOCK_ROWS."""
    return min(bits - 1, max(0, (max(tasks, -(-rows // BLOCK_ROWS)) - 1).bit_length()))


def count_filters(prints: DataFrame, rows: int, bits: int = BITS) -> DataFrame:
    """(block, filter) of all fingerprints in column fp: built per partition, merged per block, written."""
    spark = prints.sparkSession
    lead = block_bits(rows, int(spark.conf.get("spark.sql.shuffle.partitions")), bits)
    rest = bits - lead

    def give(prints: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        block = (prints >> np.uint64(rest)).astype(np.int64)
        cut = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block))
        low = prints & np.uint64((1 << rest) - 1)
        return pa.RecordBatch.from_arrays([
            pa.array(block[cut[:-1]]),
            pa.array([build(low[a:b], counts[a:b], rest) for a, b in zip(cut[:-1], cut[1:])], pa.binary())], ["block", "filter"])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for b in batches:
            held.append(np.unique(b.column(0).to_numpy().view(np.uint64), return_counts=True))
            size += len(held[-1][0])
            if size > BLOCK_ROWS:
                yield give(*summed(*map(np.concatenate, zip(*held))))
                held, size = [], 0
        if size:
            yield give(*summed(*map(np.concatenate, zip(*held))))

    def together(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [key[0]], "filter": [merge(group["filter"], rest)]})

    built = prints.select("fp").mapInArrow(local, "block long, filter binary")
    return stage(built.groupBy("block").applyInPandas(together, "block long, filter binary"), "quotient-filters")


def repeated_prints(filters: DataFrame) -> DataFrame:
    """(fp, n) of the fingerprints that the filters count more than once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, data in zip(b.column("block").to_pylist(), b.column("filter")):
                data = data.as_py()
                prints, counts = entries(data)
                many = counts > 1
                fp = (np.uint64(block) << np.uint64(data[0])) | prints[many]
                yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(counts[many])], ["fp", "n"])

    return stage(filters.mapInArrow(read, "fp long, n long"), "repeated-prints")


def _routed(texts: DataFrame, repeated: DataFrame, rows: int) -> DataFrame:
    """The rows whose fingerprint is repeated."""
    if repeated.count() <= BROADCAST_ROWS:
        return texts.join(F.broadcast(repeated.select("fp")), "fp", "left_semi")
    hot = F.broadcast(repeated.where(F.col("n") * HOT_SHARE >= rows).select("fp"))
    cold = repeated.where(F.col("n") * HOT_SHARE < rows).select("fp")
    return (texts.join(hot, "fp", "left_semi")
            .union(texts.join(hot, "fp", "left_anti").join(cold, "fp", "left_semi")))


def verified_classes(documents: DataFrame, repeated: DataFrame, rows: int, bits: int = BITS) -> DataFrame:
    """(fp, digest, n) of the texts that occur more than once, equal byte by byte."""
    texts = documents.select(_text().alias("text")).withColumn("fp", _print(F.col("text"), bits)).select("fp", "text")
    same = _routed(texts, repeated, rows).groupBy("fp", "text").agg(F.count(F.lit(1)).alias("n"))
    classes = stage(same.select("fp", text_digest(F.col("text")).alias("digest"), "n"), "verified-classes")
    if classes.groupBy("fp", "digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").take(1):
        raise ValueError("two different texts have the same SHA-256 digest")
    return classes.where("n > 1")


def _in_classes(rows: DataFrame, classes: DataFrame, n_rows: int, how: str) -> DataFrame:
    """``rows`` joined with their classes; hot classes by a broadcast of a thousand rows at most."""
    keys = ["fp", "digest"]
    hot = F.broadcast(classes.where(F.col("n") * HOT_SHARE >= n_rows))
    cold = classes.where(F.col("n") * HOT_SHARE < n_rows)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys, how), allowMissingColumns=True)


def _judged(documents: DataFrame, bits: int) -> DataFrame:
    """doc_id, digest, keep_id, n (null: no copy) and kept of every row."""
    docs = only(documents, "doc_id", "text")
    rows = stage(docs.select("doc_id", _print(_text(), bits).alias("fp"), text_digest(F.col("text")).alias("digest"),
                             F.monotonically_increasing_id().alias("row")), "prints")
    n_rows = rows.count()
    repeated = repeated_prints(count_filters(rows, n_rows, bits))
    classes = verified_classes(docs, repeated, n_rows, bits)
    best = F.max(F.struct("doc_id", "row")).alias("best")
    kept = stage(_in_classes(rows, classes, n_rows, "inner").groupBy("fp", "digest").agg(best, F.first("n").alias("n"))
                 .select("fp", "digest", "n", F.col("best.doc_id").alias("keep"), F.col("best.row").alias("keep_row")), "kept-rows")
    return _in_classes(rows, kept, n_rows, "left").select(
        "doc_id", "digest", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"), "n",
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"))


def duplicate_report(documents: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document."""
    return _judged(documents, bits).select("doc_id", "keep_id", F.coalesce("n", F.lit(1).cast("long")).alias("group_size"), "kept",
                                           F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(documents: DataFrame, bits: int = BITS) -> DataFrame:
    """The documents that stay, with all their columns."""
    return kept_rows(documents, _judged(documents, bits))


#: The same rows in DuckDB SQL.
ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

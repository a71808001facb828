"""File-order positions and running sums for line- or segment-based scans.

Rows of a text scan carry (file, block start, monotonically increasing id) taken in
the scan's own projection: a split is read by one task in file order, so these three
give the exact order inside a file, whatever the split packing.  Running sums per
file are computed in two levels so that no single task ever sees a whole file:
a window per (file, block) -- bounded by the split size -- plus per-block offsets
from a table with one row per split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Names of files that the text reader decompresses; their size on disk isn't that of their text.
_COMPRESSED = r"\.(gz|gzip|bz2|zst|zstd|lz4|snappy|deflate|xz)$"


def read_positioned(spark: SparkSession, paths: str | list[str], line_sep: str | None = None,
                    by_size: bool = False, extra: list[str] | None = None) -> DataFrame:
    """Text scan -> ``(file, block, seq, file_size, value)``; ``line_sep`` None = \\n, \\r\\n or \\r.

    ``extra``: partition columns to keep. ``by_size``: the caller compares text with ``file_size``; a compressed file is then an error.
    """
    reader = spark.read.format("text")
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    df = reader.load(paths)
    file = F.col("_metadata.file_path")
    if by_size:
        file = F.when(file.rlike(_COMPRESSED), F.raise_error(F.concat(
            F.lit("decompress this file first, its text is compared with its size: "), file))).otherwise(file)
    return df.select(
        file.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("value"),
        *(extra or []),
    )


def running_sums(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Adds, for each ``name -> expr``, the column ``name``, its inclusive running sum
    ``name_cum`` over file order, and its sum over the file, ``name_tot``."""
    names = list(exprs)
    base = df.select("*", *[e.alias(n) for n, e in exprs.items()])
    per_block = base.groupBy("file", "block").agg(*[F.sum(n).alias(n) for n in names])
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select("file", "block", *[
        c for n in names for c in (F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_off"),
                                   F.sum(n).over(Window.partitionBy("file")).alias(f"{n}_tot"))])
    within = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    local = base.select("*", *[F.sum(n).over(within).alias(f"{n}_run") for n in names])
    out = local.join(offsets, ["file", "block"])
    return out.select(*base.columns, *[c for n in names for c in (
        (F.col(f"{n}_run") + F.col(f"{n}_off")).alias(f"{n}_cum"), F.col(f"{n}_tot"))])

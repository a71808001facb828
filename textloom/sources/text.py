"""Plain-text scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.positions import read_positioned


def text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per line (``\\n``, ``\\r\\n`` and ``\\r`` all end a line, like Python text mode)."""
    return spark.read.text(paths).select(F.col("value").alias("line"))


def training_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines as a vocabulary trainer reads a text file: each line keeps its line ending.

    Records are split on ``\n`` only (a ``\r`` stays in the line), and ``\n`` is put
    back, except on the last line of a file that does not end in a newline.  That
    line is found from one row per file (total bytes vs. file size, last position),
    joined back on the file: no window, no sort.
    """
    pos = read_positioned(spark, paths, line_sep="\n", by_size=True)
    per_file = pos.groupBy("file").agg(
        F.sum(F.octet_length("value") + 1).alias("bytes"), F.max("file_size").alias("size"),
        F.max(F.struct("block", "seq")).alias("last"))
    unterminated = per_file.where(F.col("bytes") == F.col("size") + 1).select(
        "file", F.col("last.block").alias("block"), F.col("last.seq").alias("seq"), F.lit(True).alias("open"))
    marked = pos.join(unterminated, ["file", "block", "seq"], "left")
    return marked.select(F.when(F.col("open"), F.col("value"))
                         .otherwise(F.concat(F.col("value"), F.lit("\n"))).alias("text"))

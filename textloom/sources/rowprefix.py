"""Prefixes in dataset order (S7): the first N rows of a Parquet dataset as its files hold them.

The order of a dataset without an id column is that of its files by name and of the rows in each. Row counts come from a scan
without columns, which reads file footers only, and only of the files up to the end of the prefix: they are counted in
doubling steps. The prefix itself is ``file <= last file`` and ``row index < rest``, so files beyond it aren't opened.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files whose offsets are broadcast (a path and a number each); beyond, the numbers are joined by a shuffle.
BROADCAST_FILES = 500_000

_FILE = "_metadata.file_path"
_ROW = "_metadata.row_index"


def file_rows(df: DataFrame, n: int | None = None) -> list[tuple[str, int]]:
    """(file, rows) of a dataset's files by name, as far as they are needed for ``n`` rows (None: all)."""
    # Without a host, a file's metadata has one slash after the scheme where the list of input files has three.
    files = sorted({re.sub("^([a-z0-9]+):///", r"\1:/", f) for f in df.inputFiles()})
    counted: list[tuple[str, int]] = []
    total = 0
    while len(counted) < len(files) and (n is None or total < n):
        step = files[len(counted):len(counted) + (len(files) if n is None else max(1, len(counted)))]
        inside = F.col(_FILE).between(step[0], step[-1])
        found = dict(tuple(r) for r in df.where(inside).groupBy(F.col(_FILE).alias("file")).count().collect())
        counted += [(f, found.get(f, 0)) for f in step]
        total += sum(found.values())
    return counted


def rows_in_order(spark: SparkSession, path: str | list[str], n: int | None = None, name: str = "row_no") -> DataFrame:
    """The first ``n`` rows (None: all) of a Parquet dataset in dataset order, with their 0-based place in ``name``.

    An empty dataset gives an empty result; columns named like a file's metadata stay as they are.
    """
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    counted = file_rows(df, n)
    starts, at = [], 0
    for file, rows in counted:
        starts.append((file, at))
        at += rows
    table = spark.createDataFrame(starts, "_file string, _start long")
    if n is not None:
        if not counted or n <= 0:
            return df.withColumn(name, F.lit(0).cast("long")).limit(0)
        df = df.where(F.col(_FILE) <= F.lit(counted[-1][0]))
    placed = df.select("*", F.col(_FILE).alias("_file"), F.col(_ROW).alias("_row"))
    joined = placed.join(F.broadcast(table) if len(starts) <= BROADCAST_FILES else table, "_file")
    numbered = joined.withColumn(name, F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")
    return numbered if n is None else numbered.where(F.col(name) < n)

"""JSONL sinks (K1, K2, K5) and the vocabulary export (K3, K4 in operators.bpe).

Lines are built with ``to_json`` (one object per line, nulls kept) and written as
text.  Shuffled sets are written range-partitioned and sorted on the shuffle key,
so the part files, in name order, hold the rows in shuffle order.  An output that
exists already is an error: nothing is overwritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from textloom.sources.positions import read_positioned, running_sums


def jsonl_line(cols: list[str], ensure_ascii: bool = False) -> Column:
    """K1 (UTF-8 kept) or K2 (non-ASCII as ``\\uXXXX`` escapes, surrogate pairs above the BMP)."""
    opts = {"ignoreNullFields": "false"}
    if ensure_ascii:
        opts["writeNonAsciiCharacterAsCodePoint"] = "true"
    return F.to_json(F.struct(*[F.col(c) for c in cols]), opts)


def counted(df: DataFrame, by: str | None = None, values: list[str] | None = None) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` and a function that gives, after an action on it, its rows ("rows") and those with each value of ``by``.

    The numbers are observed on the way, in the tasks of the action itself: no second scan.
    """
    seen = Observation(f"counts-{uuid.uuid4().hex}")
    each = [F.count(F.when(F.col(by) == v, F.lit(1))).alias(f"n_{i}") for i, v in enumerate(values or [])]
    watched = df.observe(seen, F.count(F.lit(1)).alias("n"), *each)

    def get() -> dict[str, int]:
        got = seen.get
        return {"rows": got["n"]} | {v: got[f"n_{i}"] for i, v in enumerate(values or [])}

    return watched, get


def write_jsonl(df: DataFrame, path: str, cols: list[str], ensure_ascii: bool = False) -> None:
    df.select(jsonl_line(cols, ensure_ascii).alias("value")).write.text(path)


def write_splits(df: DataFrame, path: str, cols: list[str], n_valid: int, ensure_ascii: bool = False,
                 always_write_valid: bool = True) -> dict[str, int]:
    """K5: ``{path}/split=train`` and ``{path}/split=valid`` in one pass over ``df``; the rows of each, counted on the way (A4).

    ``df`` must carry ``split`` and be range-ordered on the key with ``lead=("split",)``.
    The CLI variant skips an empty validation set; the pipeline always writes it
    (an empty directory when there is no validation row).
    """
    out, counts = counted(df.select("split", jsonl_line(cols, ensure_ascii).alias("value")), "split", ["train", "valid"])
    out.write.partitionBy("split").text(path)
    if always_write_valid and n_valid == 0:
        spark = df.sparkSession
        spark.createDataFrame([], "value string").write.mode("overwrite").text(f"{path.rstrip('/')}/split=valid")
    got = counts()
    return {"train": got["train"], "valid": got["valid"]}


def write_text_file(spark, path: str, text: str) -> None:
    """One plain file with ``text`` (a vocabulary or a config: bounded), on any file system Spark reaches."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def written_order(spark, path: str, by: list[str] | None = None) -> DataFrame:
    """Lines of a written set with ``row_no`` (1-based): their place in file-name order, per value of ``by``."""
    group = by or []
    pos = read_positioned(spark, path, extra=group)
    sums = running_sums(pos, {"one": F.lit(1)})
    name = F.substring_index("file", "/", -1)
    totals = sums.groupBy("file", *group).agg(F.count(F.lit(1)).alias("n")).withColumn("name", name)
    before = Window.partitionBy(*group).orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    return sums.join(offsets, "file").select(*group, (F.col("off") + F.col("one_cum")).cast("long").alias("row_no"), "value")

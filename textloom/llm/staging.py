"""Shared staging and ranking helpers of the training-data operators."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.session import fresh_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts lineage with a written table: a lost executor costs a re-read, never a rerun of
    what came before, and later passes see the same rows in the same order.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a stage of ours that nothing reads any more (works for any Hadoop file system)."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hadoop_path, True)


def release(spark: SparkSession) -> None:
    """Let the driver notice which shuffles and broadcasts nothing refers to any more, so that their files go now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def only(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns, found exactly even if ``df`` has others that differ only in case."""
    by_name = {c: i for i, c in enumerate(df.columns)}
    if len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select(*cols)
    renamed = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return renamed.select(*[F.col(f"_c{by_name[c]}").alias(c) for c in cols])


def group_ranks(staged: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Add a gapless 0-based rank of each row within its ``cols`` group, without one task per group.

    ``staged`` must be read straight from a written table: file name and row index give each row
    a fixed place. Ranks count inside (group, file) and are shifted by the group's rows in earlier
    files, so a group that holds a third of all rows is spread over all its files, and equal rows
    get different ranks. Group columns must not be null.
    """
    at = staged.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    keys = [*cols, "_file"]
    before = Window.partitionBy(*cols).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (at.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
               .select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    local = at.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy("_row")) - 1)
    return (local.join(offsets, keys)
            .withColumn(name, (F.col("_off") + F.col("_rn")).cast("long"))
            .drop("_file", "_row", "_rn", "_off"))


#: Rows of (doc_id, digest) decisions that are broadcast (about 50 bytes each); beyond, rows find theirs by a shuffle.
BROADCAST_DECISIONS = 1_000_000


def text_digest(text: Column) -> Column:
    """SHA-256 of a text (null: empty), 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _decided(documents: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """``documents`` joined with decisions on (doc_id, digest); a null doc_id meets null."""
    rows = documents.withColumn("__digest", text_digest(documents["text"]))
    marks = marks.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__mark"), *[c for c in marks.columns if c not in ("doc_id", "digest")])
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_DECISIONS else marks
    return rows.join(marks, documents["doc_id"].eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__mark")), how)


def without_rows(documents: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose (doc_id, digest of the text) isn't in ``dropped``; every column stays."""
    return _decided(documents, stage(dropped.select("doc_id", "digest").distinct(), "dropped"), "left_anti").drop("__digest")


def kept_rows(documents: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``documents`` that ``decided`` (doc_id, digest, kept; a row each) keeps; every column stays.

    Rows that agree in doc_id and text can't be told apart; where some of them are kept and some not, one stays.
    """
    marks = stage(decided.groupBy("doc_id", "digest").agg(F.bool_or("kept").alias("__one"), F.bool_and("kept").alias("__all"))
                  .where("NOT __all").select("doc_id", "digest", "__one"), "decisions")
    joined = _decided(documents, marks, "left")
    kept = joined.where(F.col("__one").isNull())
    if marks.where("__one").take(1):
        kept = kept.unionByName(joined.where("__one").dropDuplicates(["__id", "__digest"]))
    return kept.drop("__digest", "__id", "__mark", "__one")

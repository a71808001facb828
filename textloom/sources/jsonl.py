"""JSONL scans: strict (S1), lenient (S2), format sniff and dispatch (S3), quarantine.

Every scan returns one row per input line (or rebuilt object) with
``status`` (ok / blank / invalid / not_object / no_key / null_text / non_string),
``key``, ``text`` and the parsed ``obj`` VARIANT, so jobs can keep the good rows
and count the quarantined ones in the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions.json import (TEXT_KEYS, _reread_line, first_present_key, is_object, key_value,
                                     reread, strict_value, text_status, variant_string)
from textloom.session import fresh_path
from textloom.sources.positions import read_positioned

SNIFF_LINES = 10  # fixed value: lines tested to decide the format of a file
BROADCAST_FILES = 500_000  # files whose modes are broadcast (a path each)


def extract_text(df: DataFrame, line_col: str = "value", keys: list[str] = TEXT_KEYS) -> DataFrame:
    """P1 + F5 + F6 on a column of JSON strings: adds obj, key, status, text."""
    parsed = df.withColumn("obj", strict_value(F.col(line_col)))
    keyed = parsed.withColumn("key", F.when(is_object(F.col("obj")), first_present_key(F.col("obj"), keys)))
    picked = keyed.withColumn("_picked", key_value(F.col("obj"), F.col("key"), keys))
    status = picked.withColumn("status", text_status(F.col(line_col), F.col("obj"), F.col("key"), F.col("_picked")))
    # Duplicate keys and NaN: only lines rejected so far are read again, by Python's own parser.
    again = status.withColumn("_again", reread(F.when(F.col("status") == "invalid", F.col(line_col)), keys))
    text = F.when(F.col("status") == "ok", variant_string(F.col("_picked"))).otherwise(F.col("_again.text"))
    return (again.withColumn("text", text)
            .withColumn("key", F.coalesce("key", "_again.key"))
            .withColumn("status", F.coalesce("_again.status", "status")).drop("_picked", "_again"))


def lenient_jsonl(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every line of the files with its extraction status (blank lines are status 'blank')."""
    return extract_text(spark.read.text(paths))


def strict_jsonl(spark: SparkSession, paths: str | list[str], key: str = "text") -> DataFrame:
    """One strict ``json.loads`` per line; the first bad line fails the job.

    Keeps ``text`` only where the key is present (F7).  A blank line is a bad line
    here, as in the reference's plain ``for line in f: json.loads(line)``.
    """
    rows = extract_text(spark.read.text(paths), keys=[key])
    fault = (F.when(F.col("status").isin("blank", "invalid", "not_object"), F.concat(
                F.lit("invalid JSON line: "), F.substring("value", 1, 200)))
             .when(F.col("status").isin("null_text", "non_string"), F.lit(f"'{key}' is not a string")))
    checked = rows.select("obj", "status", F.when(fault.isNotNull(), F.raise_error(fault)).otherwise(F.col("text")).alias("text"))
    return checked.where(F.col("status") != "no_key").select("obj", "text")


def _sniff(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, nth, ok) of the first lines of a split; returns, and with it ends the scan, after ``SNIFF_LINES``."""
    nth = 0
    for b in batches:
        file, block, ok = [], [], []
        for row in b.slice(0, SNIFF_LINES - nth).to_pylist():
            file.append(row["file"])
            block.append(row["block"])
            ok.append(not row["value"].strip() or _reread_line(row["value"], [])[0] != "invalid")
        yield pa.RecordBatch.from_arrays([pa.array(file, pa.string()), pa.array(block, pa.int64()),
                                          pa.array(range(nth, nth + len(ok)), pa.int64()), pa.array(ok, pa.bool_())], ["file", "block", "nth", "ok"])
        nth += len(ok)
        if nth >= SNIFF_LINES:
            return


def sniff_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """S3: per file, ``jsonl`` if every non-blank line among the first 10 parses, else ``multiline``.

    Each split is a task of its own that reads at most ten lines in small batches and ends, so what is read follows the
    number of splits and no line is shuffled. A split with fewer lines than ten has given all it has; the file's next
    split goes on counting. The result is a written table with one row per file.
    """
    own = spark.newSession()  # its settings are its own: a split per task, batches of ten lines
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(SNIFF_LINES))
    lines = read_positioned(own, paths).select("file", "block", "value").mapInArrow(_sniff, "file string, block long, nth long, ok boolean")
    before = Window.partitionBy("file").orderBy("block", "nth")
    first = lines.withColumn("place", F.row_number().over(before)).where(F.col("place") <= SNIFF_LINES)
    modes = first.groupBy("file").agg(F.when(F.bool_and("ok"), F.lit("jsonl")).otherwise(F.lit("multiline")).alias("mode"))
    path = fresh_path(spark, "file-modes")
    modes.write.parquet(path)
    return spark.read.parquet(path)


def extract_text_auto(spark: SparkSession, paths: str | list[str], on_error: str = "stop", keep_dropped: bool = False) -> DataFrame:
    """S3 dispatch: each file is read line by line (S2) or rebuilt from multi-line objects.

    File modes are a small written table (one row per file); lines find their extractor by joining it, broadcast up
    to ``BROADCAST_FILES`` files. Returns ``file, mode, status, key, text, obj, line``; ``keep_dropped``: with the chunks that the
    rebuild drops.
    """
    from textloom.sources.jsonscan import rebuild_multiline

    pos = read_positioned(spark, paths)
    modes = sniff_files(spark, paths)
    few = modes.count() <= BROADCAST_FILES

    def of(mode: str) -> DataFrame:
        files = modes.where(F.col("mode") == mode).select("file")
        if few:  # the scan's own order stays
            return pos.join(F.broadcast(files), "file", "left_semi")
        return pos.join(files, "file", "left_semi").repartition("file", "block").sortWithinPartitions("file", "block", "seq")

    line_rows = extract_text(of("jsonl")).select("file", F.lit("jsonl").alias("mode"), "status", "key", "text", "obj", F.col("value").alias("line"))
    rebuilt = rebuild_multiline(spark, of("multiline"), on_error, keep_dropped).select(
        "file", F.lit("multiline").alias("mode"), "status", "key", "text", "obj", F.col("chunk").alias("line"))
    return line_rows.unionByName(rebuilt)

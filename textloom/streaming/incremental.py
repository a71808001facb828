"""Incremental lenient JSONL extraction over a directory that receives new files.

The extraction (F5, F6, P1) is stateless, so it runs unchanged on a streaming
frame: each micro-batch's new files are parsed and the good texts appended to a
Parquet sink with exactly-once file tracking in the checkpoint location.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.sources.jsonl import extract_text


def start_text_extraction(spark: SparkSession, input_dir: str, output_dir: str, checkpoint: str,
                          available_now: bool = True) -> StreamingQuery:
    lines = spark.readStream.format("text").load(input_dir)
    texts = extract_text(lines).where(F.col("status") == "ok").select("key", "text")
    writer = (texts.writeStream.format("parquet").option("path", output_dir)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()

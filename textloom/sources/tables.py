"""Parquet sources: dataset prefix scans, full scans and the tolerant wrapper.

A source is a named loader ``load(n) -> DataFrame`` that returns the first ``n``
items (``train[:n]``; ``None`` = all) in the shape the reference's datasets have:

* web / text-only items: ``(id BIGINT, text STRING)``
* ShareGPT chat items:   ``(id, conversations ARRAY<STRUCT<from, value>>)``
* role/content chat:     ``(id, conversation ARRAY<STRUCT<role, content>>)``

The prefix is cut by id *before* any filter (L2) and is pushed into the scan.
The stand-ins over the driver tables are documented in README.md.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.chat import group_turns
from textloom.operators.order import first_n_ids, first_n_rows
from textloom.sources.rowprefix import rows_in_order

log = logging.getLogger(__name__)

WEB_SCHEMA = "id BIGINT, text STRING"
SHAREGPT_SCHEMA = "id BIGINT, conversations ARRAY<STRUCT<from: STRING, value: STRING>>"
ROLE_CHAT_SCHEMA = "id BIGINT, conversation ARRAY<STRUCT<role: STRING, content: STRING>>"

# ShareGPT spellings of the canonical roles (public dataset convention).
SHAREGPT_ROLE_NAMES = {"user": "human", "assistant": "gpt", "system": "system"}


@dataclass(frozen=True)
class Source:
    name: str                      # the source tag written to the ``source`` column
    kind: str                      # "web" | "chat" | "text"
    load: Callable[[int | None], DataFrame]
    schema: str                    # schema of ``load`` output, used for an empty stand-in
    turns_field: str | None = None  # the list the reference reads for chat items


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def web_source(spark: SparkSession, path: str, name: str = "fineweb") -> Source:
    """Web documents by ``doc_id``; only ``text`` is kept (``documents.source`` is dropped)."""
    def load(n):
        df = spark.read.parquet(path).select(F.col("doc_id").alias("id"), "text")
        return first_n_rows(df, n)
    return Source(name, "web", load, WEB_SCHEMA)


def text_source(spark: SparkSession, path: str, name: str = "textset") -> Source:
    """Text-only items by ``item_id`` (S8: whole split, no tolerance wrapper in the reference)."""
    def load(n):
        df = spark.read.parquet(path).select(F.col("item_id").alias("id"), "text")
        return first_n_rows(df, n)
    return Source(name, "text", load, WEB_SCHEMA)


def _flat_turns(spark: SparkSession, path: str, first_chat: bool) -> DataFrame:
    df = spark.read.parquet(path)
    # Two chat sources from one turn table: conv_id % 10 < 7 and the rest (together: all rows).
    part = (F.col("conv_id") % 10) < 7
    return df.where(part if first_chat else ~part)


def sharegpt_source(spark: SparkSession, path: str, name: str = "hermes") -> Source:
    """First chat source: ``conversations`` of ``{from, value}`` with ShareGPT role names."""
    def load(n):
        flat = first_n_ids(_flat_turns(spark, path, True), n, "conv_id")
        role = F.col("role")
        for canon, alias in SHAREGPT_ROLE_NAMES.items():
            role = F.when(F.col("role") == canon, F.lit(alias)).otherwise(role)
        flat = flat.withColumn("role", role)
        return group_turns(flat, {"from": "role", "value": "text"}, "conversations")
    return Source(name, "chat", load, SHAREGPT_SCHEMA, "conversations")


def role_chat_source(spark: SparkSession, path: str, name: str = "capybara") -> Source:
    """Second chat source: ``conversation`` of ``{role, content}``."""
    def load(n):
        flat = first_n_ids(_flat_turns(spark, path, False), n, "conv_id")
        return group_turns(flat, {"role": "role", "content": "text"}, "conversation")
    return Source(name, "chat", load, ROLE_CHAT_SCHEMA, "conversation")


def _items(spark: SparkSession, path: str, id_col: str | None, n: int | None) -> DataFrame:
    """The first ``n`` items with their ``id``: by ``id_col``, or in dataset order with their row number as id."""
    if id_col is None:
        return rows_in_order(spark, path, n, "_row_no").withColumn("id", F.col("_row_no")).drop("_row_no")
    return first_n_rows(spark.read.parquet(path).withColumn("id", F.col(id_col)), n)


def _needed(df: DataFrame, cols: list[str], given: str) -> None:
    """A column that the caller named wrongly is the caller's error, not a source without rows."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{given} has no column {', '.join(missing)} (it has {', '.join(df.columns)})")


def parquet_text_source(spark: SparkSession, path: str, name: str, id_col: str | None = None,
                        text_col: str = "text", kind: str = "web") -> Source:
    """A Parquet dataset of text items. Its order for ``train[:n]`` is that of ``id_col``, or of the files and their rows."""
    def load(n):
        _needed(spark.read.parquet(path), [c for c in (id_col, text_col) if c], path)
        return _items(spark, path, id_col, n).select("id", F.col(text_col).alias("text"))
    return Source(name, kind, load, WEB_SCHEMA)


def parquet_chat_source(spark: SparkSession, path: str, name: str, turns_field: str,
                        id_col: str | None = None) -> Source:
    """A Parquet dataset of chat items with a nested list of turns (struct or map turns), ordered as a text source is."""
    def load(n):
        df = spark.read.parquet(path)
        _needed(df, [id_col] if id_col else [], path)
        return _items(spark, path, id_col, n).select("id", *([turns_field] if turns_field in df.columns else []))
    schema = f"id BIGINT, {turns_field} ARRAY<STRUCT<role: STRING, content: STRING>>"
    return Source(name, "chat", load, schema, turns_field)


def standard_sources(spark: SparkSession, sf_dir: str) -> dict[str, Source]:
    conv = table_path(sf_dir, "conversations")
    return {
        "fineweb": web_source(spark, table_path(sf_dir, "documents")),
        "hermes": sharegpt_source(spark, conv),
        "capybara": role_chat_source(spark, conv),
        "textset": text_source(spark, table_path(sf_dir, "benchmark")),
    }


#: What a failed analysis or a failed scan raises (the latter may come unconverted from the JVM).
READ_ERRORS = (PySparkException, Py4JJavaError)
#: Error conditions that say that a source isn't there, isn't the expected shape, or can't be read.
SOURCE_FAULTS = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "FIELD_NOT_FOUND")


def is_source_fault(exc: BaseException) -> bool:
    """Whether an error is the source's own (S9); a lost executor or a fault in a job isn't."""
    condition = exc.getCondition() if isinstance(exc, PySparkException) else None
    said = f"{condition or ''} {exc}"
    return isinstance(exc, READ_ERRORS) and any(f in said for f in SOURCE_FAULTS)


def tolerant_load(spark: SparkSession, source: Source, n: int | None) -> DataFrame:
    """A source that is missing or unreadable yields zero rows and a warning; other errors pass.

    Analysis-time failures are caught here; jobs that write a stage per source also catch
    failures of the scan itself.
    """
    try:
        df = source.load(n)
        df.schema  # force analysis
        return df
    except READ_ERRORS as exc:
        if not is_source_fault(exc):
            raise
        log.warning("source %s failed to load: %s", source.name, str(exc).splitlines()[0])
        return spark.createDataFrame([], source.schema)

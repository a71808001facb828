"""Registered queries: JSONL scans, JSON repair scans, plain-text scan and JSONL sinks.

Each file-based query first writes a file derived from ``documents`` to a fresh
directory in the shared scratch space, then reads it back through the operator;
``documents`` itself is the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.json import TEXT_KEYS, first_present_key, key_value, strict_value, text_status, variant_string
from textloom.plans import fixtures
from textloom.plans.registry import query
from textloom.plans.sql_snippets import NL
from textloom.sources.jsonl import extract_text_auto, lenient_jsonl, strict_jsonl
from textloom.sources.jsonscan import rebuild_concatenated, rebuild_multiline
from textloom.sources.sinks import write_jsonl
from textloom.sources.tables import table_path
from textloom.session import fresh_path
from textloom.sources.text import text_lines


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "documents")).select("doc_id", "text", "lang")


def _doc_id(obj="obj"):
    return F.variant_get(F.col(obj), "$.doc_id", "bigint").alias("doc_id")


_KEY_SQL = ("CASE lang WHEN 'en' THEN 'text' WHEN 'fr' THEN 'content' WHEN 'de' THEN 'prompt' "
            "ELSE 'completion' END")


@query("jsonl_strict_text", "SELECT doc_id, text FROM documents")
def jsonl_strict_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + F7: strict line-by-line scan of a JSONL file, ``text`` kept where present."""
    path = fixtures.plain_jsonl(_docs(spark, sf_dir))
    return strict_jsonl(spark, path).select(_doc_id(), "text")


@query("jsonl_lenient_text", f"SELECT doc_id, {_KEY_SQL} AS key, text FROM documents")
def jsonl_lenient_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + P1 + F5 + F6: lenient scan; damaged, blank and key-less lines are dropped."""
    path = fixtures.lenient_jsonl(_docs(spark, sf_dir))
    return lenient_jsonl(spark, path).where(F.col("status") == "ok").select(_doc_id(), "key", "text")


@query("jsonl_invalid_count",
       "SELECT status, CAST(count(*) AS BIGINT) AS n FROM (SELECT 'ok' AS status FROM documents UNION ALL "
       "SELECT CASE lang WHEN 'en' THEN 'null_text' WHEN 'fr' THEN 'blank' WHEN 'de' THEN 'no_key' "
       "ELSE 'invalid' END FROM documents) s GROUP BY status")
def jsonl_invalid_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the quarantine report of the lenient scan, one count per status."""
    path = fixtures.lenient_jsonl(_docs(spark, sf_dir))
    return lenient_jsonl(spark, path).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("text_key_pick",
       "SELECT doc_id, CASE lang WHEN 'en' THEN 'text' WHEN 'fr' THEN 'content' WHEN 'de' THEN 'prompt' "
       "ELSE 'text' END AS key, CASE WHEN lang = 'es' THEN 'null_text' ELSE 'ok' END AS status, "
       "CASE WHEN lang = 'es' THEN NULL ELSE text END AS text FROM documents")
def text_key_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 on JSON strings: the first *present* key wins, even when its value is null."""
    docs = _docs(spark, sf_dir)
    j = lambda *cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    line = (F.when(F.col("lang") == "en", j(F.col("lang").alias("meta"), F.col("text")))
            .when(F.col("lang") == "fr", j(F.lit("c").alias("completion"), F.col("text").alias("content")))
            .when(F.col("lang") == "de", j(F.col("text").alias("prompt"), F.col("doc_id").alias("completion")))
            .otherwise(j(F.lit(None).cast("string").alias("text"), F.col("text").alias("content"))))
    obj = docs.select("doc_id", line.alias("line")).withColumn("obj", strict_value(F.col("line")))
    keyed = obj.withColumn("key", first_present_key(F.col("obj"), TEXT_KEYS))
    picked = keyed.withColumn("v", key_value(F.col("obj"), F.col("key"), TEXT_KEYS))
    status = text_status(F.col("line"), F.col("obj"), F.col("key"), F.col("v"))
    return picked.select("doc_id", "key", status.alias("status"),
                         F.when(status == "ok", variant_string(F.col("v"))).alias("text"))


@query("jsonl_sniff",
       "SELECT doc_id, CASE WHEN lang IN ('de', 'es') THEN 'multiline' ELSE 'jsonl' END AS mode, text "
       "FROM documents")
def jsonl_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: per-file format sniff on the first 10 lines, then S2 or S4 for that file."""
    path = fixtures.sniff_dirs(_docs(spark, sf_dir))
    out = extract_text_auto(spark, path)
    return out.where(F.col("status") == "ok").select(_doc_id(), "mode", "text")


@query("json_lines_rebuild", "SELECT doc_id, text FROM documents")
def json_lines_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + F8: pretty-printed objects (some followed by a comma) rebuilt line by line."""
    path = fixtures.multiline_json(_docs(spark, sf_dir))
    return rebuild_multiline(spark, path).where(F.col("status") == "ok").select(_doc_id(), "text")


def _concat_objects(spark, sf_dir):
    path = fixtures.concatenated_json(_docs(spark, sf_dir))
    return rebuild_concatenated(spark, path)


@query("json_concat_rebuild", "SELECT doc_id, text FROM documents")
def json_concat_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concatenated / pretty JSON objects rebuilt by brace counting, one line each."""
    objs = _concat_objects(spark, sf_dir).withColumn("obj", strict_value(F.col("line")))
    return objs.select(_doc_id(), variant_string(F.variant_get("obj", "$.text", "variant")).alias("text"))


@query("json_concat_strings", "SELECT doc_id, text || ' {' || lang || '} \"}' AS text FROM documents")
def json_concat_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5, string-aware: braces and quotes inside texts neither open nor close an object."""
    docs = _docs(spark, sf_dir)
    braced = docs.withColumn("text", F.concat("text", F.lit(" {"), "lang", F.lit('} "}')))
    objs = rebuild_concatenated(spark, fixtures.concatenated_json(braced, escape_braces=False), string_aware=True)
    objs = objs.withColumn("obj", strict_value(F.col("line")))
    return objs.select(_doc_id(), variant_string(F.variant_get("obj", "$.text", "variant")).alias("text"))


@query("json_recovered_count",
       "SELECT 'multiline' AS scan, CAST(count(*) AS BIGINT) AS n FROM documents UNION ALL "
       "SELECT 'concatenated', CAST(count(*) AS BIGINT) FROM documents")
def json_recovered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: objects recovered by S4 (with a text key) and by S5."""
    multi = rebuild_multiline(spark, fixtures.multiline_json(_docs(spark, sf_dir)))
    a = multi.where(F.col("status") == "ok").agg(F.lit("multiline").alias("scan"), F.count(F.lit(1)).alias("n"))
    b = _concat_objects(spark, sf_dir).agg(F.lit("concatenated").alias("scan"), F.count(F.lit(1)).alias("n"))
    return a.unionByName(b)


@query("text_scan", f"SELECT unnest(string_split(text, {NL})) AS line FROM documents")
def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain text file read line by line."""
    return text_lines(spark, fixtures.text_file(_docs(spark, sf_dir)))


def _sink_roundtrip(spark, sf_dir, ensure_ascii):
    docs = _docs(spark, sf_dir)
    path = fresh_path(spark, "jsonl_ascii" if ensure_ascii else "jsonl_utf8")
    write_jsonl(docs, path, ["doc_id", "text"], ensure_ascii=ensure_ascii)
    lines = spark.read.text(path)
    return lines.select(strict_value(F.col("value")).alias("obj"),
                        F.col("value").rlike("[^\\x00-\\x7F]").alias("raw_non_ascii"))


@query("jsonl_utf8", "SELECT doc_id, text, regexp_matches(text, '[^\\x00-\\x7F]') AS raw_non_ascii FROM documents")
def jsonl_utf8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: JSONL written with non-ASCII characters kept, read back strictly."""
    rt = _sink_roundtrip(spark, sf_dir, False)
    return rt.select(_doc_id(), variant_string(F.variant_get("obj", "$.text", "variant")).alias("text"),
                     "raw_non_ascii")


@query("jsonl_ascii", "SELECT doc_id, text, false AS raw_non_ascii FROM documents")
def jsonl_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: JSONL written with ``\\uXXXX`` escapes (pure ASCII lines), same values read back."""
    rt = _sink_roundtrip(spark, sf_dir, True)
    return rt.select(_doc_id(), variant_string(F.variant_get("obj", "$.text", "variant")).alias("text"),
                     "raw_non_ascii")

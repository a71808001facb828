"""Files derived from the driver tables, for the file-based scans.

Each writer takes ``documents`` and writes a directory under the shared scratch
space (fresh path per call); the source table is then the oracle.  Rows are dealt
to files by ``doc_id`` and sorted inside; the number of files follows the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import fresh_path

# Fixed mapping used by the fixtures: which key carries the text for each language.
KEY_BY_LANG = {"en": "text", "fr": "content", "de": "prompt", "es": "completion"}


def _json(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def json_string(c: Column) -> Column:
    wrapped = F.to_json(F.struct(c.alias("s")))
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - F.lit(6))


def _write_lines(df: DataFrame, value: Column, name: str, partition_by: str | None = None) -> str:
    path = fresh_path(df.sparkSession, name)
    out = df.repartition("doc_id").sortWithinPartitions("doc_id")
    cols = [value.alias("value")] + ([F.col(partition_by)] if partition_by else [])
    writer = out.select(*cols).write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.text(path)
    return path


def plain_jsonl(docs: DataFrame) -> str:
    """``{"doc_id": .., "text": ..}`` per line."""
    return _write_lines(docs, _json(F.col("doc_id"), F.col("text")), "jsonl_plain")


def lenient_jsonl(docs: DataFrame) -> str:
    """One good line per document whose text key depends on ``lang``, plus one damaged
    line per document: en ``{"text": null, ...}``, fr blank, de no text key, es cut off."""
    good = None
    for lang, key in KEY_BY_LANG.items():
        line = _json(F.col("doc_id"), F.col("text").alias(key))
        good = F.when(F.col("lang") == lang, line) if good is None else good.when(F.col("lang") == lang, line)
    plain = _json(F.col("doc_id"), F.col("text"))
    extra = (F.when(F.col("lang") == "en", _json(F.lit(None).cast("string").alias("text"), F.lit("c").alias("content")))
             .when(F.col("lang") == "fr", F.lit("   "))
             .when(F.col("lang") == "de", _json(F.col("doc_id"), F.lit("x").alias("body")))
             .otherwise(F.substring(plain, F.lit(1), F.length(plain) - F.lit(1))))
    lines = F.array(good, extra)
    rows = docs.select("doc_id", F.posexplode(lines).alias("k", "line"))
    path = fresh_path(docs.sparkSession, "jsonl_lenient")
    (rows.repartition("doc_id").sortWithinPartitions("doc_id", "k")
     .select(F.col("line").alias("value")).write.text(path))
    return path


def pretty_object(doc_id: Column, text: Column, trailing_comma: Column | None = None) -> Column:
    """A pretty-printed two-key object on four lines (optionally followed by a comma)."""
    obj = F.concat(F.lit('{\n  "doc_id": '), doc_id.cast("string"), F.lit(',\n  "text": '),
                   json_string(text), F.lit("\n}"))
    return obj if trailing_comma is None else F.when(trailing_comma, F.concat(obj, F.lit(","))).otherwise(obj)


def multiline_json(docs: DataFrame) -> str:
    """Pretty-printed objects, half of them followed by ``,`` (S4 input)."""
    return _write_lines(docs, pretty_object(F.col("doc_id"), F.col("text"), F.col("lang").isin("fr", "es")),
                        "json_multiline")


def sniff_dirs(docs: DataFrame) -> str:
    """One directory per language: en/fr as JSONL, de/es as pretty-printed objects (S3)."""
    pretty = pretty_object(F.col("doc_id"), F.col("text"))
    value = F.when(F.col("lang").isin("de", "es"), pretty).otherwise(_json(F.col("doc_id"), F.col("text")))
    return _write_lines(docs, value, "json_sniff", partition_by="lang")


def concatenated_json(docs: DataFrame, escape_braces: bool = True) -> str:
    """Objects one after another: pretty-printed for en/de, compact for fr/es.

    A scanner that takes no notice of strings needs the braces inside texts written as JSON escapes; a ``string_aware``
    one reads them as they are. All documents are written.
    """
    text = json_string(F.col("text"))
    if escape_braces:
        text = F.replace(F.replace(text, F.lit("{"), F.lit("\\u007b")), F.lit("}"), F.lit("\\u007d"))
    head = F.concat(F.lit('"doc_id":'), F.col("doc_id").cast("string"))
    compact = F.concat(F.lit("{"), head, F.lit(',"text":'), text, F.lit("}"))
    pretty = F.concat(F.lit("{\n  "), head, F.lit(',\n  "text": '), text, F.lit("\n}"))
    return _write_lines(docs, F.when(F.col("lang").isin("en", "de"), pretty).otherwise(compact), "json_concat")


def text_file(docs: DataFrame) -> str:
    """Each document's text as lines of a plain text file."""
    return _write_lines(docs, F.col("text"), "text_plain")

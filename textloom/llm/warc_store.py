"""Content-addressed WARC archive.

Two tables under one folder: ``payloads`` holds the bytes of every distinct payload once, addressed by
SHA-256 and verified by a second digest (SHA-1) and the length; ``records`` holds one row per captured
page with its exact header bytes and the payload's address. A record is rebuilt by joining the two:
header block, HTTP response head, payload, and the two line ends that close a WARC record. The block of a revisit is empty.

Of records with equal payloads the one with the largest page_id (ties: the largest url) is a
``response``; the others are ``revisit`` records that refer to it. A payload shorter than ``min_bytes``
is a response every time.

Defined results: null html is the empty payload; a null page_id sorts lowest and a null url is left out
of the headers; fully repeated rows are records of their own, one of them the response; an empty table
gives an empty archive. Line breaks in a url are percent-encoded, as a header can't hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.staging import only
from textloom.session import fresh_path

#: Fixed values of the WARC 1.1 format and of RFC 4648 base32.
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_END = "\r\n\r\n"


def base32_of_hex(hex_digest: Column) -> Column:
    """Upper-case base32 of a 40-digit hex SHA-1: five hex digits are four base32 characters."""
    chars = []
    for group in range(8):
        bits = F.conv(F.substring(hex_digest, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            index = F.shiftright(bits, shift).bitwiseAND(31) + 1
            chars.append(F.substring(F.lit(BASE32_ALPHABET), index, F.lit(1)))
    return F.concat(*chars)


def _payload_rows(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return (only(pages, "page_id", "url", "html")
            .select("page_id", "url", payload.alias("payload"))
            .withColumn("address", F.sha2("payload", 256)))


def _http_head(n_bytes: Column) -> Column:
    """The HTTP response head of a payload, as bytes."""
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), n_bytes.cast("string"),
                    F.lit("\r\n\r\n")).cast("binary")


def _record_id(page_id: Column, url: Column, copy: Column) -> Column:
    name = F.concat_ws("\x1f", F.coalesce(page_id.cast("string"), F.lit("")), F.coalesce(url, F.lit("")), F.col("address"), copy.cast("string"))
    uuid = F.regexp_replace(F.md5(name), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))


def _headers(date: str) -> Column:
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))

    def digest(sha1: Column) -> Column:
        return F.concat(F.lit("sha1:"), base32_of_hex(sha1))

    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.col("record_type") == "revisit"
    none = F.lit("")
    refers = F.concat(line("WARC-Refers-To", _record_id(F.col("first.page_id"), F.col("first.url"), F.lit(1))),
                      line("WARC-Profile", F.lit(REVISIT_PROFILE)), F.coalesce(line("X-Refers-To-Page-Id", F.col("refers_to")), none))
    block_bytes = F.octet_length(_http_head(F.col("n_bytes"))) + F.col("n_bytes")
    return F.concat(
        F.lit(f"{WARC_VERSION}\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("url"), F.col("copy"))),
        F.coalesce(line("WARC-Target-URI", url), none),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("X-Page-Id", F.col("page_id")), none),
        F.when(revisit, refers).otherwise(none),
        line("WARC-Payload-Digest", digest(F.col("sha1"))),
        line("WARC-Block-Digest", digest(F.when(revisit, F.sha1(F.lit(b""))).otherwise(F.col("block_sha1")))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.when(revisit, F.lit(0).cast("long")).otherwise(block_bytes)),
        F.lit("\r\n"))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write ``path/payloads`` and ``path/records``."""
    rows = _payload_rows(pages)
    # One row per distinct capture: only digests and keys are shuffled here, payloads stay out.
    # Repeated rows are counted before the shuffle and written out again after it.
    size = F.octet_length("payload").cast("long")
    keyed = (rows.select("page_id", "url", "address", F.sha1("payload").alias("sha1"), size.alias("n_bytes"),
                         F.sha1(F.concat(_http_head(size), F.col("payload"))).alias("block_sha1"))
             .groupBy("address", "sha1", "n_bytes", "block_sha1", "page_id", "url").agg(F.count(F.lit(1)).alias("n")))
    newest = F.max(F.struct(F.coalesce(F.col("page_id"), F.lit(-(1 << 63))).alias("id"), F.coalesce(F.col("url"), F.lit("")).alias("url"), "page_id"))
    first = keyed.groupBy("address").agg(newest.alias("first"))
    is_first = (F.coalesce(F.col("page_id"), F.lit(-(1 << 63))) == F.col("first.id")) & (F.coalesce(F.col("url"), F.lit("")) == F.col("first.url"))
    records = (keyed.join(first, "address")
               .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
               .withColumn("record_type", F.when((F.col("n_bytes") < min_bytes) | (is_first & (F.col("copy") == 1)), "response").otherwise("revisit"))
               .withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("first.page_id")))
               .withColumn("header", _headers(date).cast("binary")))
    records.select("page_id", "address", "header").write.parquet(f"{path}/records")

    # One payload per address. Equal addresses must agree in a second digest and the length.
    checked = rows.withColumn("check", F.concat_ws(":", F.sha1("payload"), F.octet_length("payload")))
    payloads = checked.groupBy("address").agg(F.first("payload").alias("payload"), F.min("check").alias("lo"), F.max("check").alias("hi"))
    verified = F.when(F.col("lo") == F.col("hi"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("two payloads share the address "), F.col("address"))))
    payloads.select("address", verified.alias("payload")).write.parquet(f"{path}/payloads")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Rebuild every record: (record, payload), the bytes of the record as an archive file holds them, and the captured payload,
    which a revisit record doesn't hold itself.

    The address of each stored payload is computed again; a damaged or a missing payload raises instead of passing.
    """
    stored = spark.read.parquet(f"{path}/payloads").select(F.col("address").alias("stored"), "payload")
    both = spark.read.parquet(f"{path}/records").join(stored, F.col("address") == F.col("stored"), "left")
    sound = (F.when(F.col("stored").isNull(), F.raise_error(F.concat(F.lit("no payload at "), F.col("address"))))
             .when(F.sha2("payload", 256) != F.col("address"), F.raise_error(F.concat(F.lit("damaged payload at "), F.col("address"))))
             .otherwise(F.col("payload")))
    block = F.when(_header(F.col("header").cast("string"), "WARC-Type") == "revisit", F.lit(b"")).otherwise(
        F.concat(_http_head(F.octet_length("payload")), F.col("payload")))
    return both.select("header", sound.alias("payload")).select(F.concat("header", block, F.lit(RECORD_END.encode())).alias("record"), "payload")


def _header(text: Column, name: str) -> Column:
    """Value of a header line, null if there is none."""
    value = F.regexp_extract(text, rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(value != "", value)


def _head_of(text: Column) -> Column:
    """What stands before the first empty line, with it."""
    return F.regexp_extract(text, r"(?s)^(.*?\r\n\r\n)", 1)


def parse_records(records: DataFrame) -> DataFrame:
    """Read record bytes (column ``record``): head (string) and the body of the HTTP response in its block (null for a revisit).

    A record whose lengths don't agree with its bytes raises.
    """
    text = F.col("record").cast("string")
    heads = records.withColumn("head", _head_of(text))
    size = F.octet_length("head")
    length = _header(F.col("head"), "Content-Length").cast("long")
    whole = F.octet_length("record") == size + length + len(RECORD_END)
    block = F.when(whole, F.substring("record", size + 1, length.cast("int"))).otherwise(
        F.raise_error(F.concat(F.lit("broken record: "), F.substring("head", 1, 200))))
    parts = heads.withColumn("block", block).withColumn("http", _head_of(F.col("block").cast("string")))
    rest = F.substring("block", F.octet_length("http") + 1, F.octet_length("block"))
    return parts.withColumn("body", F.when(_header(F.col("head"), "WARC-Type") != "revisit", rest)).drop("block", "http")


def write_warc_files(spark: SparkSession, path: str, out: str, files: int) -> None:
    """Export the rebuilt records as plain WARC files."""
    ending = F.octet_length("record") - len(RECORD_END)
    (read_records(spark, path).select(F.substring("record", F.lit(1), ending).cast("string").alias("value"))
     .repartition(files).write.option("lineSep", RECORD_END).text(out))


def page_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archive a pages table, rebuild its records, parse their bytes, and give the digest of each."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archive(pages, path, min_bytes)
    back = parse_records(read_records(spark, path)).withColumn("payload", F.coalesce("body", "payload"))
    head = F.col("head")
    return back.select(
        _header(head, "X-Page-Id").cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
        _header(head, "WARC-Type").alias("record_type"),
        _header(head, "X-Refers-To-Page-Id").cast("long").alias("refers_to"))


#: The same rows in DuckDB SQL, for a table of distinct page ids.
ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body)) AS n, sha1(body) AS h, max(page_id) OVER (PARTITION BY sha256(body)) AS top FROM p),
g AS (SELECT d.*, i, ('0x' || substr(h, 5 * i + 1, 5))::BIGINT AS v FROM d, range(8) r(i)),
c AS (SELECT page_id, n, top, string_agg(
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 15 & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 10 & 31) + 1, 1) ||
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 5 & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31) + 1, 1), '' ORDER BY i) AS b32
      FROM g GROUP BY page_id, n, top)
SELECT page_id, n::BIGINT AS payload_bytes, b32 AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM c
"""

"""Interaction audit of an ordered set of filters: what each order of them removes at each step.

A document's failures are a mask of five bits. Whatever the order, the document goes at the first of its failed filters, so
in the 120 orders, ranked as Lehmer codes rank them (lexicographically), it goes at step k in those that begin with k - 1 filters it
passes and then one it fails. All orders with a given beginning are one interval of ranks. So a mask's removals are
at most 65 intervals: its count is added where an interval starts and taken off where it ends, in one
difference array per part and step, and a running sum over the 120 ranks gives every total.

Documents are read once; after that there are at most 32 masks x 4 labels x parts rows. The orders, intervals and ranks are made
by rule, 840 intervals for all masks.

``E`` (identical to a smaller doc_id's text) goes by SHA-256 and length: the least doc_id of each text is a group minimum (combined before
the shuffle), and rows look up whether they hold it by (text, doc_id), so that copies of one text spread.

Defined results: a null text is empty (it fails A and no other rule but E); a null doc_id neither fails E nor makes others
fail it, and has no labels; repeated rows count each, and rows with the same doc_id don't fail E for each other; a doc_id's several
label rows count as one that says 1 where any does; a null label is 0; a null lang is the part ''; an empty table has no parts, so no rows;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from textloom.llm.staging import only, stage

FILTERS = "ABCDE"
#: Fixed values of the contract: least words, least share of distinct words, most share of capitals (percent), symbols.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
SYMBOLS = b"#$%&*|"

CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: Bytes of UTF-8 that don't begin a character.
FOLLOWING = bytes(range(0x80, 0xC0))
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}


def text_failures(text: bytes) -> int:
    """Mask of the filters A to D that a text fails."""
    words = text.split()  # of bytes: ASCII white space
    n = len(words)
    points = len(text.translate(None, FOLLOWING))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (BIT["A"] * (n < MIN_WORDS)
            | BIT["B"] * (100 * len(set(words)) < MIN_DISTINCT * n)
            | BIT["C"] * (100 * capitals > MAX_CAPITALS * points)
            | BIT["D"] * (len(text) != len(text.translate(None, SYMBOLS))))


def failures_column(text: Column) -> Column:
    @arrow_udf("int")
    def masks(texts: pa.Array) -> pa.Array:
        return pa.array((text_failures(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts), pa.int32(), size=len(texts))

    return masks(text)


def orders(filters: str = FILTERS) -> list[str]:
    """All orders by their Lehmer rank."""
    return ["".join(p) for p in permutations(filters)]


def lehmer_rank(beginning: str, filters: str = FILTERS) -> int:
    """Rank of the first order that begins so."""
    left, rank = list(filters), 0
    for f in beginning:
        rank += left.index(f) * factorial(len(left) - 1)
        left.remove(f)
    return rank


def removal_intervals(mask: int, filters: str = FILTERS) -> list[tuple[int, int, int]]:
    """(step, first rank, rank after the last) of the orders in which documents of this mask go at that step."""
    failed = [f for i, f in enumerate(filters) if mask >> i & 1]
    passed = [f for f in filters if f not in failed]
    found = []
    for k in range(len(passed) + 1):
        for before in permutations(passed, k):
            for f in failed:
                start = lehmer_rank("".join(before) + f, filters)
                found.append((k + 1, start, start + factorial(len(filters) - k - 1)))
    return found


def failure_counts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, docs, good, toxic): the documents of each failure mask, those labelled good and toxic among them."""
    docs = only(documents, "doc_id", "text", "lang")
    text = F.coalesce("text", F.lit(""))
    rows = stage(docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), failures_column(F.col("text")).alias("mask"),
                             F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).alias("size")), "failures")
    known = rows.where(F.col("doc_id").isNotNull())
    least = known.groupBy("digest", "size").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = (only(labels, "doc_id", "quality", "toxic").where(F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    copies = F.when(F.col("first"), F.lit(0)).otherwise(BIT["E"])
    judged = (known.join(least, ["digest", "size", "doc_id"], "left").join(marks, "doc_id", "left")
              .select("part", F.col("mask").bitwiseOR(copies).alias("mask"), "good", "toxic"))
    unknown = rows.where(F.col("doc_id").isNull()).select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return judged.union(unknown).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))


def _interval_ends(spark: SparkSession, filters: str = FILTERS) -> DataFrame:
    """(mask, step, rank, sign): the difference-array entries of one document of each mask."""
    rows = [(mask, step, rank, sign) for mask in range(1 << len(filters)) for step, start, stop in removal_intervals(mask, filters)
            for rank, sign in ((start, 1), (stop, -1)) if rank < factorial(len(filters))]
    return spark.createDataFrame(rows, "mask int, step int, rank int, sign int")


def order_totals(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from the counts of ``failure_counts``."""
    spark = counts.sparkSession
    counts = stage(counts, "mask-counts")
    kinds = ("docs", "good", "toxic")
    ends = (counts.join(F.broadcast(_interval_ends(spark, filters)), "mask").groupBy("part", "step", "rank")
            .agg(*[F.sum(F.col(k) * F.col("sign")).alias(k) for k in kinds]))
    letters = F.array(*[F.lit(f) for f in filters])
    by_filter = [F.struct(F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("docs")).otherwise(0)).alias("fails"),
                          F.sum(F.when(F.col("mask") == 1 << i, F.col("docs")).otherwise(0)).alias("alone")) for i in range(len(filters))]
    parts = counts.groupBy("part").agg(F.sum("docs").alias("total"), F.array(*by_filter).alias("per_filter"))
    ranks = Window.partitionBy("part", "step").orderBy("rank")
    every = F.posexplode(F.array(*[F.lit(o) for o in orders(filters)])).alias("rank", "filter_order")
    grid = parts.select("*", every).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
    filled = grid.join(ends, ["part", "step", "rank"], "left")
    summed = filled.select("part", "total", "per_filter", "rank", "filter_order", "step",
                           *[F.sum(F.coalesce(k, F.lit(0))).over(ranks).alias(k) for k in kinds])
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    so_far = Window.partitionBy("part", "rank").orderBy("step")
    own = F.get("per_filter", F.array_position(letters, F.col("letter")).cast("int") - 1)
    return (summed.withColumn("letter", letter)
            .select("part", "filter_order", "step", (F.col("total") - F.sum("docs").over(so_far)).alias("kept"), F.col("docs").alias("removed"),
                    (own["fails"] - F.col("docs")).alias("redundant"), own["alone"].alias("unique_fails"),
                    F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
                    F.sum("docs").over(Window.partitionBy("part", "letter")).alias("shapley")))


def audit_filters(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of a documents table, 600 rows per part."""
    return order_totals(failure_counts(documents, labels))


#: The same rows in DuckDB SQL, by walking every order for every mask.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
w AS (SELECT doc_id, text, part, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
f AS (SELECT part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d, doc_id > least AS e,
             coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
      FROM w LEFT JOIN labels l USING (doc_id)),
m AS (SELECT part, (CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
             || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END) AS mask,
             count(*) AS docs, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM x p, x q, x r, x s, x t
      WHERE p.x <> q.x AND p.x <> r.x AND p.x <> s.x AND p.x <> t.x AND q.x <> r.x AND q.x <> s.x AND q.x <> t.x AND r.x <> s.x AND r.x <> t.x AND s.x <> t.x),
st AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before FROM o, range(1, 6) g(step)),
g AS (SELECT part, filter_order, step, letter, docs, good, toxic, strpos(mask, letter) > 0 AS fails, mask = letter AS alone,
             translate(mask, before, '') = mask AS stays FROM m, st),
t AS (SELECT part, filter_order, step, letter, sum(CASE WHEN stays AND NOT fails THEN docs ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN stays AND fails THEN docs ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN fails AND NOT stays THEN docs ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN alone THEN docs ELSE 0 END)::BIGINT AS unique_fails, sum(CASE WHEN stays AND fails THEN good ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN stays AND fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost FROM g GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley FROM t
"""

"""Budgets, source loading, union and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.operators.chat import nonempty_text, render_chat
from textloom.sources.tables import Source, tolerant_load

MIX_SCHEMA = "source STRING, id BIGINT, text STRING"


def two_way_budget(total: int, ratio: float) -> tuple[int, int]:
    """L1: ``a = int(total * ratio)`` (a truncated double), ``b = total - a``."""
    a = int(total * ratio)
    return a, total - a


def pretrain_budgets(total: int = 500_000, web_ratio: float = 0.7, chat_ratio: float = 0.7) -> dict[str, int]:
    """Web share first, the rest split again between the two chat sources."""
    web, chat = two_way_budget(total, web_ratio)
    first_chat, second_chat = two_way_budget(chat, chat_ratio)
    return {"fineweb": web, "hermes": first_chat, "capybara": second_chat}


def chatml_budgets(total: int = 50_000, first_ratio: float = 0.7, first_only: bool = False,
                   second_only: bool = False) -> dict[str, int]:
    """L1 / L3: two-way split, or one source with the whole budget (first flag wins)."""
    if first_only:
        return {"hermes": total}
    if second_only:
        return {"capybara": total}
    a, b = two_way_budget(total, first_ratio)
    return {"hermes": a, "capybara": b}


def load_samples(spark: SparkSession, source: Source, budget: int | None, style: str, tolerant: bool = True) -> DataFrame:
    """Prefix cut (L2) -> render (P4/P5) or F1 -> source tag (P7): ``(source, id, text)``.

    ``tolerant=False`` leaves a source's faults to the caller.
    """
    items = tolerant_load(spark, source, budget) if tolerant else source.load(budget)
    if source.kind == "chat":
        texts = render_chat(items, source.turns_field, style)
    else:
        texts = nonempty_text(items.select("id", "text"))
    return texts.select(F.lit(source.name).alias("source"), "id", "text")


def mix_sources(spark: SparkSession, sources: dict[str, Source], budgets: dict[str, int],
                chat_style: str) -> DataFrame:
    """Union of the rendered sources in load order, duplicates kept."""
    parts = [load_samples(spark, sources[name], n, chat_style) for name, n in budgets.items()]
    if len({p.schema["id"].dataType.simpleString() for p in parts}) > 1:  # sources may number or name their items
        parts = [p.withColumn("id", F.col("id").cast("string")) for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def counts_by_source(df: DataFrame, sources: list[str], with_total: bool = True) -> DataFrame:
    """A1 / A2: rows per known source (0 when none loaded) and the total, in one pass."""
    spark = df.sparkSession
    names = spark.createDataFrame([(s, i) for i, s in enumerate(sources)], "source string, ord int")
    counts = df.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    per = names.join(counts, "source", "left").select(
        "source", "ord", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    if with_total:
        total = per.agg(F.lit("total").alias("source"), F.lit(len(sources)).alias("ord"),
                        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))
        per = per.unionByName(total)
    return per.select("source", "n")


def running_load_totals(df: DataFrame, sources: list[str]) -> DataFrame:
    """A3: rows loaded per source and the running total after each, in load order.

    The frame has one row per source, so the un-partitioned window is over a handful of rows.
    """
    spark = df.sparkSession
    names = spark.createDataFrame([(s, i) for i, s in enumerate(sources)], "source string, ord int")
    counts = df.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    per = names.join(counts, "source", "left").select(
        "source", "ord", F.coalesce("n", F.lit(0)).cast("long").alias("loaded"))
    w = Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    return per.select("source", F.col("ord").cast("long").alias("load_order"), "loaded",
                      F.sum("loaded").over(w).cast("long").alias("running_total"))

"""The corpus pipeline: five training-data operators, each over all its predecessor kept.

Toxic documents go; of near copies one stays; repeated passages are cut out; documents that hold a benchmark item go; what is
left is packed into sequences. A stage reads the table its predecessor wrote, so a lost executor never reruns more
than one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import best_fit_packing, compression_toxicity, decontaminate, simhash_pigeonring, suffix_family
from textloom.llm.queries import TOKENIZER
from textloom.llm.staging import stage
from textloom.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier doesn't call toxic."""
    ship_package(spark)
    model = compression_toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(compression_toxicity.score_column(model, F.col("text")) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship_package(spark)
    return simhash_pigeonring.deduplicate(docs, shingle=4, distance=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur twice."""
    ship_package(spark)
    return suffix_family.remove_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents with their places in sequences."""
    ship_package(spark)
    return best_fit_packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), capacity=2048, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: SQL has neither the compression nor the tokenizer of the stages; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the result of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Sharding by jump consistent hashing: a stable key decides the shard, with no ring table.

``jump_hash`` follows Lamping and Veach, "A Fast, Minimal Memory, Consistent Hash Algorithm": a
linear congruential generator seeded with the key jumps from bucket to bucket, and the last jump
below the shard count is the shard. Going from n to n + 1 shards moves 1 / (n + 1) of the keys,
all of them into the new shard.

Defined results: a null key is a key like any other; repeated rows get one slot each; an empty
table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from textloom.llm.staging import group_ranks, only, stage

#: Fixed values of the published algorithm: the generator's multiplier and its 31-bit scale.
JUMP_MULTIPLIER = 2862933555777941757
JUMP_SCALE = float(1 << 31)


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of every unsigned 64-bit key, all keys jumping together."""
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    shard = np.zeros(len(keys), np.int64)
    alive = np.arange(len(keys))
    state = keys.astype(np.uint64, copy=True)
    nxt = np.zeros(len(keys), np.int64)
    while len(alive):
        shard[alive] = nxt
        with np.errstate(over="ignore"):
            state = state * np.uint64(JUMP_MULTIPLIER) + np.uint64(1)
        nxt = ((nxt + 1) * (JUMP_SCALE / ((state >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        keep = nxt < n_shards
        alive, state, nxt = alive[keep], state[keep], nxt[keep]
    return shard


def stable_key(*cols: Column) -> Column:
    """64 bits of md5 over the key's text, as a long; the same in every engine and release."""
    text = F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in cols])
    digest = F.md5(text)
    # Two 32-bit halves: conv() of 16 digits would be unsigned and not fit a long.
    high = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    low = F.conv(F.substring(digest, 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def jump_shard(key: Column, n_shards: int) -> Column:
    """Shard number of a long key column (its bits read as unsigned)."""

    @pandas_udf("int")
    def shard_of(k: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(k.to_numpy(np.int64).view(np.uint64), n_shards).astype(np.int32))

    return shard_of(key)


def assign_shards(df: DataFrame, key_cols: list[str], n_shards: int) -> DataFrame:
    """Add ``shard`` and ``grown_shard`` (the shard if one more were appended); row-local, no shuffle."""
    key = stable_key(*[F.col(c) for c in key_cols])
    return (df.withColumn("_key", key)
            .withColumn("shard", jump_shard(F.col("_key"), n_shards))
            .withColumn("grown_shard", jump_shard(F.col("_key"), n_shards + 1))
            .drop("_key"))


def shard_slots(assigned: DataFrame) -> DataFrame:
    """Add ``slot``, gapless from 0 in every shard, over a written copy of the (narrow) rows."""
    return group_ranks(stage(assigned, "shard-rows"), ["shard"], "slot")


def write_shards(df: DataFrame, key_cols: list[str], n_shards: int, path: str, per_shard: int = 1) -> None:
    """Write all columns as Parquet under ``path/shard=N``; ``per_shard`` tasks share a shard's rows."""
    out = assign_shards(df, key_cols, n_shards).drop("grown_shard")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in key_cols]), F.lit(per_shard))
    out.repartition(n_shards * per_shard, "shard", salt).write.partitionBy("shard").parquet(path)


def document_shards(documents: DataFrame, n_shards: int = 40) -> DataFrame:
    """Digest rows of a documents table dealt into shards by ``doc_id``."""
    rows = only(documents, "doc_id", "text").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long").alias("text_crc32"))
    placed = shard_slots(assign_shards(rows, ["doc_id"], n_shards))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")

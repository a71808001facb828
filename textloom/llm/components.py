"""Connected components of an edge table, by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond". Every step is a group minimum (combined
before the shuffle) and a join on the node; a node with very many neighbours is a skewed join key, which
adaptive execution splits. Each round's edges are written to the shared folder, so a lost executor costs
a re-read; the driver sees a count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.staging import stage


def _relink(directed: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours v of each u to the least of u and its neighbours."""
    least = directed.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    linked = directed.join(least, "u")
    if larger_only:
        return linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (linked.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")))


def components(edges: DataFrame) -> DataFrame:
    """(u, root) of every node with an edge, except the roots themselves; root is the component's least node.

    ``edges`` has long columns u and v; direction, loops and repeats don't matter.
    """
    now = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(seen) == mark or not seen[0]:
            return now.select("u", F.col("v").alias("root"))
        mark = tuple(seen)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _relink(both, larger_only=True).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        now = stage(_relink(down, larger_only=False).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")

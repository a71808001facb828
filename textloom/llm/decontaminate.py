"""Benchmark decontamination by SimHash of item-sized windows, in DataFrame functions throughout.

Texts are lower-cased and cut into five-word shingles (fewer words: one shingle of all of them). For a benchmark item of
L shingles, a document's windows are its runs of L shingles that begin at one of the item's (moved left where the
document ends before; the whole document if it is shorter). A window whose similarity can reach the
threshold holds at least threshold * L of the item's shingles, so windows with fewer are never fingerprinted.

Every window left gets a 64-bit SimHash. Fingerprints are cut into ``radius + 1`` blocks: two that differ in at
most ``radius`` bits agree in one block at least, so a join on (item, block number, block value) finds, of the items that a window
was found by, all within the radius. Candidates are verified by the exact similarity, weighted by counts,

    sum over the item's shingles of min(count in item, count in window)
    / (sum over the item's shingles of max(...) + the window's shingles that the item hasn't got),

so an item's result doesn't depend on the other items. A document is contaminated by an item if one window reaches the
threshold.

Of two windows of m and n different shingles and similarity s, the cosine is s / (1 + s) * (m + n) / sqrt(m * n): at 0.8
at least 0.889, where fingerprints differ in 9.7 of 64 bits on average (deviation 2.9); the default radius of 20 lies 3.6
deviations above. Shingles that repeat inside a window can lower the cosine.

The benchmark's side is broadcast only below ``BROADCAST_ROWS`` rows; beyond it the joins shuffle.

Defined results: null and empty texts, of documents and items alike, match nothing; repeated documents are reported once for a
doc_id; repeated items count as one item with the least item_id of equal shingles each on its own; a null doc_id or
item_id is reported as null; empty tables give an empty result; other columns are ignored.

``ORACLE_SQL`` states the same rule, similarity by counts, without fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.staging import only, stage, text_digest, without_rows

WORDS = 5
THRESHOLD = 0.8
RADIUS = 20
#: Rows of the small side of a join up to which it is broadcast (under 100 bytes each).
BROADCAST_ROWS = 500_000


def shingle_hashes(words: Column) -> Column:
    """Hashes of the runs of ``WORDS`` words of an array of word hashes; one hash of all words if there are fewer."""
    def cut(w: Column) -> Column:
        several = F.transform(F.sequence(F.lit(0), F.size(w) - WORDS), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WORDS)]))
        few = F.when(F.size(w) > 0, F.array(F.xxhash64(F.lit("few"), w))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(w) >= WORDS, several).otherwise(few)

    # The words are bound to a variable, so that they are hashed once however often they are used.
    return F.get(F.transform(F.array(words), cut), 0)


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t-\r]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def simhash(hashes: Column) -> Column:
    """64-bit SimHash of an array of hashes, repeats counting each: a bit is set if it is in more than half."""
    def bits(h: Column) -> Column:
        def bit(b: Column) -> Column:
            ones = F.aggregate(h, F.lit(0), lambda acc, x: acc + F.call_function("shiftright", x, b).bitwiseAND(1).cast("int"))
            return F.when(2 * ones > F.size(h), F.lit(1)).otherwise(F.lit(0)).cast("long")

        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"),
                           lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", bit(b), b)))

    return F.get(F.transform(F.array(hashes), bits), 0)


def _blocks(fp: Column, radius: int) -> Column:
    """(number, value) of each of the ``radius + 1`` blocks of a fingerprint."""
    n = radius + 1
    widths = [64 // n + (i < 64 % n) for i in range(n)]
    starts = [sum(widths[:i]) for i in range(n)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, s).bitwiseAND((1 << w) - 1).alias("value"))
                     for i, (s, w) in enumerate(zip(starts, widths, strict=True))])


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def _matches(documents: DataFrame, benchmark: DataFrame, threshold: float, radius: int) -> DataFrame:
    """(doc_id, digest, item_id, similarity, first) of every window that reaches the threshold, by document row and item."""
    items = stage(only(benchmark, "item_id", "text").withColumn("words", word_hashes(F.col("text")))
                  .select("item_id", shingle_hashes(F.col("words")).alias("shingles")).where(F.size("shingles") > 0)
                  .withColumn("item", F.xxhash64("item_id", "shingles")), "items")
    shingles = stage(items.select("item", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")).groupBy("item", "n", "shingle")
                     .agg(F.count(F.lit(1)).alias("times")), "item-shingles")
    n_shingles = shingles.count()

    docs = only(documents, "doc_id", "text").where(F.octet_length("text") > 0)
    cut = (docs.select(_key(F.col("doc_id"), F.col("text")).alias("key"), word_hashes(F.col("text")).alias("words"))
           .select("key", shingle_hashes(F.col("words")).alias("shingles")))
    # The outer form drops nothing before the join, so the shingles aren't cut a second time by a filter on their number.
    places = cut.select("key", F.size("shingles").alias("have"), F.posexplode_outer("shingles").alias("pos", "shingle"))
    hits = places.join(_small(shingles.select("shingle", "item", "n"), n_shingles), "shingle").select("key", "have", "pos", "item", "n").distinct()
    # A window that begins at a hit holds enough of them if the hit that many places on still lies in it.
    need = F.ceil(F.lit(threshold) * F.least("n", "have"))
    order = Window.partitionBy("key", "item").orderBy("pos")
    ranked = hits.withColumn("rank", F.row_number().over(order)).withColumn("total", F.count(F.lit(1)).over(Window.partitionBy("key", "item")))
    ranked = ranked.where(F.col("total") >= need).withColumn("first", F.greatest(F.lit(0), F.least(F.col("pos"), F.col("have") - F.col("n"))))
    ahead = ranked.select("key", "item", F.col("rank").alias("rank_2"), F.col("pos").alias("pos_2"))
    begins = stage(
        ranked.withColumn("rank_2", F.col("rank") + need - 1).join(ahead, ["key", "item", "rank_2"])
        .where((F.col("pos_2") < F.col("pos") + F.col("n")))
        .select("key", "n", "first", "item")
        # Where the document ends before the window does, the window is moved left: it holds all hits to the end.
        .union(ranked.where((F.col("pos") > F.col("have") - F.col("n"))).select("key", "n", "first", "item"))
        .groupBy("key", "n", "first").agg(F.collect_set("item").alias("items")), "windows")
    n_begins = begins.count()

    asked = begins.groupBy("key").agg(F.collect_list(F.struct("n", "first", "items")).alias("windows"))
    found = (docs.withColumn("key", _key(F.col("doc_id"), F.col("text"))).join(_small(asked, n_begins), "key")
             .select("doc_id", text_digest(F.col("text")).alias("digest"), "windows", word_hashes(F.col("text")).alias("words"))
             .select("doc_id", "digest", "windows", shingle_hashes(F.col("words")).alias("shingles"))
             .select("doc_id", "digest", "shingles", F.explode("windows").alias("at"))
             .select("doc_id", "digest", "at.n", "at.first", "at.items", F.slice("shingles", F.col("at.first") + 1, F.col("at.n")).alias("window")).distinct())
    marked = stage(found.withColumn("fp", simhash(F.col("window"))), "window-prints")
    targets = items.select("item_id", "item", F.size("shingles").alias("n"), simhash(F.col("shingles")).alias("item_fp"))
    parts = stage(shingles.groupBy("item").agg(F.collect_list(F.struct("shingle", "times")).alias("parts")), "item-parts")
    targets = targets.join(parts, "item")

    # A window is compared with the items it was found by, not with all of its size: the join is as large as the hits.
    row = ["doc_id", "digest", "n", "first"]
    by_block = targets.select("item", "item_fp", F.explode(_blocks(F.col("item_fp"), radius)).alias("b")).select("item", "item_fp", "b.block", "b.value").distinct()
    near = (marked.select(*row, "fp", F.explode("items").alias("item"))
            .select(*row, "fp", "item", F.explode(_blocks(F.col("fp"), radius)).alias("b")).select(*row, "fp", "item", "b.block", "b.value")
            .join(_small(by_block, n_shingles * (radius + 1)), ["item", "block", "value"])
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
            .select(*row, "item").distinct())
    same = [near["doc_id"].eqNullSafe(marked["doc_id"]), near["digest"] == marked["digest"], near["n"] == marked["n"], near["first"] == marked["first"]]
    pairs = near.join(marked, same).select(near["doc_id"], near["digest"], near["first"], "item", "window")
    # The items' shingle lists are what the broadcast holds, so their total length decides.
    scored = pairs.join(_small(targets.select("item", "item_id", "parts"), n_shingles), "item").withColumn("similarity", _similarity())
    return scored.where(F.col("similarity") >= threshold).select("doc_id", "digest", "item_id", "similarity", "first")


def contaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity, first_shingle): the best window of every document and item that match."""
    best = F.max(F.struct(F.col("similarity"), (-F.col("first")).alias("back")))
    return (_matches(documents, benchmark, threshold, radius).groupBy("doc_id", "item_id").agg(best.alias("best"))
            .select("doc_id", "item_id", F.round("best.similarity", 6).alias("similarity"), (-F.col("best.back")).cast("long").alias("first_shingle")))


def _similarity() -> Column:
    """Similarity of columns window (hashes) and parts (shingle, times of the item)."""
    times = F.transform("parts", lambda p: F.struct(p["times"].alias("own"),
                                                  F.size(F.filter("window", lambda x: x == p["shingle"])).alias("here")))

    def total(of) -> Column:
        return F.aggregate(times, F.lit(0.0), lambda acc, t: acc + of(t["own"], t["here"]))

    inside = F.aggregate(times, F.lit(0), lambda acc, t: acc + t["here"])
    return total(F.least) / (total(F.greatest) + F.size("window") - inside)


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """The documents that no item contaminates; every column stays.

    Rows are told apart by doc_id and text: a contaminated row takes no other row of its id, or without an id, along.
    """
    return without_rows(documents, _matches(documents, benchmark, threshold, radius))


#: The same rows in DuckDB SQL, without fingerprints: every window that could reach the threshold is compared.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^ \\t-\\r]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^ \\t-\\r]+') AS ws FROM benchmark),
ds AS (SELECT doc_id, greatest(len(ws) - 4, 1) AS have, unnest(range(greatest(len(ws) - 4, 1))) AS pos, ws FROM d WHERE len(ws) > 0),
dsh AS (SELECT doc_id, have, pos, array_to_string(ws[pos + 1:CASE WHEN len(ws) < 5 THEN len(ws) ELSE pos + 5 END], ' ') || (len(ws) < 5)::VARCHAR AS sh FROM ds),
iss AS (SELECT item_id, greatest(len(ws) - 4, 1) AS n, unnest(range(greatest(len(ws) - 4, 1))) AS pos, ws FROM i WHERE len(ws) > 0),
ish AS (SELECT item_id, n, array_to_string(ws[pos + 1:CASE WHEN len(ws) < 5 THEN len(ws) ELSE pos + 5 END], ' ') || (len(ws) < 5)::VARCHAR AS sh FROM iss),
ic AS (SELECT item_id, n, sh, count(*) AS own FROM ish GROUP BY ALL),
hit AS (SELECT dsh.doc_id, item_id, n, have, pos, greatest(0, least(pos, have - n)) AS first FROM dsh JOIN ic USING (sh)),
win AS (SELECT DISTINCT doc_id, item_id, n, first FROM hit),
wc AS (SELECT win.doc_id, win.item_id, win.n, win.first, dsh.sh, count(*) AS here FROM win JOIN dsh ON dsh.doc_id = win.doc_id AND dsh.pos >= win.first AND dsh.pos < win.first + win.n GROUP BY ALL),
side AS (SELECT wc.doc_id, wc.item_id, wc.first, sum(here) AS size, sum(CASE WHEN own IS NOT NULL THEN here ELSE 0 END) AS inside,
                sum(CASE WHEN own IS NOT NULL THEN least(own, here) ELSE 0 END) AS lo, sum(CASE WHEN own IS NOT NULL THEN greatest(own, here) - own ELSE 0 END) AS over_own
         FROM wc LEFT JOIN ic ON ic.item_id = wc.item_id AND ic.sh = wc.sh GROUP BY ALL),
own AS (SELECT item_id, sum(own) AS total FROM ic GROUP BY item_id),
sim AS (SELECT doc_id, item_id, first, lo::DOUBLE / (over_own + total + size - inside) AS s FROM side JOIN own USING (item_id)),
best AS (SELECT doc_id, item_id, max(s) AS s FROM sim WHERE s >= 0.8 GROUP BY ALL)
SELECT best.doc_id, best.item_id, round(best.s, 6) AS similarity, min(first)::BIGINT AS first_shingle
FROM best JOIN sim ON sim.doc_id = best.doc_id AND sim.item_id = best.item_id AND abs(sim.s - best.s) < 1e-12 GROUP BY best.doc_id, best.item_id, best.s
"""

"""Seeded shuffle key, exact k-th cutoffs, prefix cuts and holdout splits.

A DataFrame has no order, so "shuffle then take the first k" becomes: give every
row a deterministic key (md5 of seed, source and id), find the k-th smallest key
exactly, and filter ``key <= cutoff``.  The cutoff is found from small histograms
(at most 65,536 buckets per pass) that are refined until a bucket has at most
``BUCKET_ROWS`` rows or a single key, so no step runs a global sort or a single-task
window, and the result does not depend on partitioning.  Nulls sort first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Histograms are refined down to buckets of at most this many rows; the driver sees no more of them.
BUCKET_ROWS = 4_096
# Values that a selection pass cuts its range at.
SPLITTERS = 48
# Rows per file of a written shuffled set.
ROWS_PER_FILE = 250_000
_HEX_STEP = 4  # hex digits per histogram level -> 65,536 buckets


def seeded_key(seed: int, source: Column | str, id_col: Column | str) -> Column:
    """L4: md5 hex of ``'{seed}:{source}:{id}'``; identical in Spark and DuckDB."""
    source = F.col(source) if isinstance(source, str) else source
    id_col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), source, F.lit(":"), F.coalesce(id_col.cast("string"), F.lit("None"))))


def with_shuffle_key(df: DataFrame, seed: int = 42, source: str = "source", id_col: str = "id",
                     key: str = "key") -> DataFrame:
    return df.withColumn(key, seeded_key(seed, source, id_col))


def _tuple_le(cols: list[str], values: tuple) -> Column:
    """Lexicographic ``(cols) <= values``, nulls first, as a plain boolean expression."""
    expr = None
    for c, v in reversed(list(zip(cols, values))):
        col, none = F.col(c), F.col(c).isNull()
        if v is None:
            expr = none if expr is None else none & expr
        elif expr is None:
            expr = none | (col <= F.lit(v))
        else:
            expr = none | (col < F.lit(v)) | ((col == F.lit(v)) & expr)
    return F.coalesce(expr, F.lit(False))


def kth_smallest_by_key(df: DataFrame, k: int, key: str = "key",
                        tiebreak: tuple[str, ...] = ("source", "id")) -> tuple | None:
    """The k-th smallest (key, *tiebreak) tuple (1-based), or None when k <= 0.

    ``key`` is a lowercase hex string (md5); rows are bucketed by hex prefix and the
    bucket holding rank k is refined; rows that agree in the whole tuple count as one entry with a number.
    """
    if k <= 0:
        return None
    cols = [key, *tiebreak]
    cond = F.lit(True)
    plen, rank = _HEX_STEP, k
    while True:
        b = F.substring(F.col(key), 1, plen)
        hist = sorted(tuple(r) for r in df.filter(cond).groupBy(b.alias("b")).count().collect())
        total = sum(n for _, n in hist)
        if rank > total:
            raise ValueError(f"rank {k} exceeds the {total} rows available")
        for bucket, n in hist:
            if rank <= n:
                break
            rank -= n
        cond = cond & (b == F.lit(bucket))
        if n <= BUCKET_ROWS or plen >= 32:
            entries = df.filter(cond).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).orderBy(*cols).collect()
            for row in entries:
                if rank <= row["_n"]:
                    return tuple(row)[:-1]
                rank -= row["_n"]
        plen += _HEX_STEP


def kth_smallest_id(df: DataFrame, k: int, id_col: str = "id", distinct: bool = True) -> int | None:
    """The k-th smallest integer id (1-based), counting ids or rows; None if k <= 0, max id if k exceeds them."""
    if k <= 0:
        return None
    ids = df.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull())
    lo, hi, rows = ids.agg(F.min("id"), F.max("id"), F.count(F.lit(1))).first()
    if lo is None or rows <= k:  # rows >= distinct ids, so every id is within the first k
        return hi
    number = F.countDistinct("id") if distinct else F.count(F.lit(1))
    rank = k
    while True:
        width = max(1, -(-(hi - lo + 1) // 65_536))
        bucket = F.floor((F.col("id") - F.lit(lo)) / F.lit(width)).cast("long")
        part = ids.where((F.col("id") >= lo) & (F.col("id") <= hi))
        hist = sorted(tuple(r) for r in part.groupBy(bucket.alias("b")).agg(number.alias("n")).collect())
        for b, n in hist:
            if rank <= n:
                break
            rank -= n
        else:  # fewer than k: everything qualifies
            return hi
        lo, hi = lo + b * width, min(hi, lo + (b + 1) * width - 1)
        if lo == hi:
            return lo


def first_n_ids(df: DataFrame, n: int | None, id_col: str = "id") -> DataFrame:
    """L2 for tables with several rows per item (turns): all rows of the first ``n`` distinct integer ids.

    Becomes ``id <= cutoff``, which Catalyst pushes into the Parquet scan.
    """
    if n is None:
        return df
    if n <= 0:
        return df.limit(0)
    cutoff = kth_smallest_id(df, n, id_col)
    return df.limit(0) if cutoff is None else df.where(F.col(id_col) <= F.lit(cutoff))


def kth_smallest_value(df: DataFrame, k: int, col: str) -> tuple[object, int, int] | None:
    """(value, rows below it, rows that equal it) of the k-th smallest (1-based) non-null value of a column of any ordered type.

    Each pass draws ``SPLITTERS`` rows between the bounds found so far and counts the rows between and at their
    values, so the range shrinks by about that factor; a value that many rows share is drawn soon and then found at once. The driver sees the splitters and their counts, and at most ``BUCKET_ROWS`` rows of the last range. Nothing is
    sorted or written. None if there are fewer than k.
    """
    values = df.select(F.col(col).alias("v")).where(F.col("v").isNotNull())
    inside, skipped = F.lit(True), 0
    while True:
        part = values.where(inside)
        rows = part.count()
        if k - skipped > rows or k < 1:
            return None
        # Which rows are drawn has no influence on the result, only on the number of passes.
        drawn = part if rows <= BUCKET_ROWS else part.orderBy(F.rand(17)).limit(SPLITTERS)
        picked = [bytes(r["v"]) if isinstance(r["v"], bytearray) else r["v"] for r in drawn.collect()]
        cuts = sorted(set(picked))
        if rows <= BUCKET_ROWS:
            at = sorted(picked)[k - skipped - 1]
            return at, skipped + sum(v < at for v in picked), picked.count(at)
        table = F.array(*[F.lit(v) for v in cuts])
        below = F.size(F.filter(table, lambda x: x < F.col("v")))
        place = (2 * below + F.array_contains(table, F.col("v")).cast("int")).alias("place")
        for place_no, n in sorted(tuple(r) for r in part.groupBy(place).count().collect()):
            if k - skipped <= n:
                break
            skipped += n
        if place_no % 2:
            return cuts[place_no // 2], skipped, n
        if place_no:
            inside = inside & (F.col("v") > F.lit(cuts[place_no // 2 - 1]))
        if place_no // 2 < len(cuts):
            inside = inside & (F.col("v") < F.lit(cuts[place_no // 2]))


def first_n_rows(df: DataFrame, n: int | None, id_col: str = "id") -> DataFrame:
    """L2 for item tables: exactly the first ``n`` rows by id (``train[:n]``), or all if there are fewer.

    Rows without an id come last. Ids of any ordered type are cut by ``id <= cutoff`` in the scan; rows of the cutoff id are
    chosen by a hash of their content, so the same rows are taken however the table is partitioned.
    """
    if n is None:
        return df
    if n <= 0:
        return df.limit(0)
    col = F.col(id_col)
    if dict(df.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint"):
        cutoff = kth_smallest_id(df, n, id_col, distinct=False)
        if cutoff is None:  # no ids at all
            return _some_rows(df, n)
        le, eq, none = (col <= F.lit(cutoff)), (col == F.lit(cutoff)), col.isNull()
        have, at, nulls = df.agg(*[F.coalesce(F.sum(c.cast("long")), F.lit(0)) for c in (le, eq, none)]).first()
        before = have - at
    else:
        found = kth_smallest_value(df, n, id_col)
        if found is None:
            have, nulls = df.agg(F.count(col), F.count(F.lit(1)) - F.count(col)).first()
            le = col.isNotNull()
        else:
            cutoff, before, at = found
            have, nulls, le = before + at, 0, col <= F.lit(cutoff)
    if have == n:
        return df.where(le)
    if have < n:  # all ids, and some of the rows without one
        return df if have + nulls <= n else df.where(le).unionByName(_some_rows(df.where(col.isNull()), n - have))
    return df.where(col < F.lit(cutoff)).unionByName(_some_rows(df.where(col == F.lit(cutoff)), n - before))


def _some_rows(df: DataFrame, n: int) -> DataFrame:
    """``n`` rows, those of least content hash; rows of one hash are taken as they come."""
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    found = kth_smallest_value(hashed, n, "_hash")
    if found is None:
        return df
    cutoff, before, _ = found
    at = hashed.where(F.col("_hash") == F.lit(cutoff)).limit(n - before)
    return hashed.where(F.col("_hash") < F.lit(cutoff)).unionByName(at).drop("_hash")


def holdout_count(n: int, ratio: float = 0.05, at_least_one: bool = False) -> int:
    """``int(n*ratio)`` (truncated double) or ``max(1, ...)``, never more than n."""
    v = int(n * ratio)
    if at_least_one:
        v = max(1, v)
    return min(n, v)


def holdout_split(df: DataFrame, ratio: float = 0.05, at_least_one: bool = False,
                  key: str = "key", tiebreak: tuple[str, ...] = ("source", "id"),
                  split_col: str = "split", rows: int | None = None) -> tuple[DataFrame, int, int]:
    """Exact holdout: the ``holdout_count`` first rows in key order are 'valid', the rest 'train'.

    ``df`` should be a materialised stage (it is scanned a few times); ``rows`` is its number of rows if known.
    Returns (frame with split column, n_valid, n_total).
    """
    n = df.count() if rows is None else rows
    n_valid = holdout_count(n, ratio, at_least_one)
    cutoff = kth_smallest_by_key(df, n_valid, key, tiebreak)
    if cutoff is None:
        split = F.lit("train")
    else:
        split = F.when(_tuple_le([key, *tiebreak], cutoff), F.lit("valid")).otherwise(F.lit("train"))
    return df.withColumn(split_col, split), n_valid, n


def first_by_key(df: DataFrame, key: str = "key", tiebreak: tuple[str, ...] = ("source", "id")) -> DataFrame:
    """The first row in shuffle order (TakeOrdered with limit 1: no global sort)."""
    return df.orderBy(key, *tiebreak).limit(1)


def preview(df: DataFrame, text_col: str = "text", n_chars: int = 500) -> DataFrame:
    """First training row, first 500 characters plus '...'."""
    first = first_by_key(df.where(F.col("split") == "train"))
    return first.select(F.concat(F.substring(F.col(text_col), 1, n_chars), F.lit("...")).alias("preview"))


def counts_by_split(df: DataFrame, split_col: str = "split") -> DataFrame:
    """A4: rows per split; both splits always present (0 when empty)."""
    spark = df.sparkSession
    names = spark.createDataFrame([("train", 0), ("valid", 1)], "split string, ord int")
    counts = df.groupBy(F.col(split_col).alias("split")).agg(F.count(F.lit(1)).alias("n"))
    return (names.join(counts, "split", "left")
            .select("split", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def range_ordered(df: DataFrame, key: str = "key", tiebreak: tuple[str, ...] = ("source", "id"),
                  rows: int | None = None, lead: tuple[str, ...] = ()) -> DataFrame:
    """Physical layout for writing a shuffled set: range partitions on the key, sorted inside.

    Files part-00000, part-00001, ... then hold the rows in global key order. For a set that is written with
    ``partitionBy(lead)``, name those columns: the writer needs its rows sorted by them, and would put a sort of its own
    in place of this one. ``rows`` (counted if not given) sets the number of files.
    """
    n = df.count() if rows is None else rows
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS_PER_FILE))
    return df.repartitionByRange(parts, key, *tiebreak).sortWithinPartitions(*lead, key, *tiebreak)

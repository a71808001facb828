"""Ranked lexical search with bag deduplication: classes of equal term bags are scored once.

1. The items' terms are the vocabulary. One scan of the texts writes, for each document, its number of terms and its bag: the vocabulary
   terms it holds with their counts, in vocabulary order. Statistics (documents, terms, document frequencies) are summed
   from that table.
2. A document's score for any item depends on its bag and on m alone. Documents are brought together by a hash of both, and
   compared in bag and m themselves, so a hash that two bags share joins nothing. Of each class the ``top`` least
   doc_ids are kept; partial limits before the shuffle keep ``top`` rows of a hot class per task.
3. Every class is scored once against all items that share a term with it, in blocks of classes, by the items' postings. A task
   keeps, per item, the ``top`` best classes by (score, least doc_id): a document of any other class has ``top`` documents ahead of
   it. Their members are expanded by ascending doc_id, and the best ``top`` rows of all tasks are taken in two
   steps, first over groups of tasks.

The items are the stated query set. They are read in blocks of at most ``BLOCK_POSTINGS`` (term, item) pairs, which bounds what a task is
sent whatever the benchmark's size; each block scans the documents. Scores are sums of whole numbers in doubles, exact below
2**53, and taken as 64-bit integers beyond.

Defined results: null texts and texts without terms have no term and are never found, null items and those without terms find
nothing; each benchmark row is an item of its own, also where item_ids repeat or are null; each documents row is a
document of its own; equal scores go by ascending doc_id, null last; an empty table gives an empty result; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.staging import only, stage
from textloom.llm.word_ids import give_back

#: Fixed values of the contract: results per item, and the weights of its score.
TOP = 50
#: (term, item) pairs of the items sent to a task together (about 40 bytes each).
BLOCK_POSTINGS = 1_000_000
#: Contributions (class, term, item) and cells (class, item) scored at a time.
CONTRIBUTIONS = 1 << 21
#: Groups of tasks whose best rows are taken together before the last step.
GROUPS = 64
EXACT = float(1 << 53)

#: A-Z to a-z, digits and letters and all bytes of other characters to themselves, the rest to a space.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order."""
    return text.translate(FOLD).split()


@dataclass
class Items:
    """A block of items: their ids and, per vocabulary term, the items that hold it."""

    ids: list
    vocabulary: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[object, set[bytes]]]) -> Items:
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(held for _, held in rows))))}
        pairs = sorted((vocabulary[t], i) for i, (_, held) in enumerate(rows) for t in held)
        term = np.array([t for t, _ in pairs], np.int64)
        starts = np.searchsorted(term, np.arange(len(vocabulary) + 1))
        return cls([i for i, _ in rows], vocabulary, starts, np.array([i for _, i in pairs], np.int64))


def item_blocks(benchmark: DataFrame, postings: int = BLOCK_POSTINGS) -> Iterator[Items]:
    """The items, read in blocks of at most so many (term, item) pairs (one item at least)."""
    held: list[tuple[object, set[bytes]]] = []
    size = 0
    for row in only(benchmark, "item_id", "text").toLocalIterator():
        found = set(terms((row["text"] or "").encode()))
        if not found:
            continue
        if held and size + len(found) > postings:
            yield Items.of(held)
            held, size = [], 0
        held.append((row["item_id"], found))
        size += len(found)
    if held:
        yield Items.of(held)


def bags(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, bag): number of terms, and (term number, count) pairs as little-endian 32-bit integers."""
    docs = only(documents, "doc_id", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for b in batches:
            sizes, packed = [], []
            for t in b.column("text"):
                words = terms(t.as_buffer().to_pybytes()) if t.is_valid else []
                sizes.append(len(words))
                held = sorted((i, c) for w, c in Counter(words).items() if (i := number(w)) is not None)
                packed.append(np.array(held, "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())], ["doc_id", "n", "bag"])
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(cut, f"doc_id {kind}, n long, bag binary")


def document_frequencies(staged: DataFrame, size: int) -> np.ndarray:
    """Number of documents that hold each term of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            held = np.frombuffer(b"".join(x.as_py() for x in b.column("bag")), "<i4")[::2]
            total += np.bincount(held, minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], ["term", "n"])

    found = staged.select("bag").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("df")).collect()
    df = np.zeros(size, np.int64)
    for row in found:
        df[row["term"]] = row["df"]
    return df


def bag_classes(staged: DataFrame, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(m, bag, members): the classes of equal bag and m with their ``top`` least doc_ids, ascending."""
    m = F.expr(f"100 - 50 + (50 * n * {n_docs}L) div {n_terms}L")
    rows = staged.where(F.octet_length("bag") > 0).select("doc_id", m.alias("m"), "bag")
    rows = rows.withColumn("hash", F.xxhash64("bag", "m"))
    key = ["hash", "m", "bag"]
    order = F.asc_nulls_last("doc_id")
    few = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy(order))).where(F.col("nth") <= top)
    return few.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("nth", "doc_id"))).alias("members")).select(
        "m", "bag", F.col("members.doc_id").alias("members"))


def _contributions(items: Items, weight: np.ndarray, owner: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> Iterator[tuple]:
    """(class, item, contribution) of each (class, term), some million at a time."""
    value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[owner]))
    fan = items.starts[term + 1] - items.starts[term]
    ends = np.cumsum(fan)
    at = 0
    while at < len(term):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CONTRIBUTIONS, "right")))
        n = fan[at:stop]
        where = np.repeat(items.starts[term[at:stop]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        yield np.repeat(owner[at:stop], n), items.items[where], np.repeat(value[at:stop], n)
        at = stop


def class_scores(items: Items, weight: np.ndarray, bag_list: list[bytes], m: np.ndarray) -> np.ndarray:
    """Scores (classes x items) as 64-bit integers."""
    lengths = np.array([len(b) // 8 for b in bag_list], np.int64)
    flat = np.frombuffer(b"".join(bag_list), "<i4").reshape(-1, 2).astype(np.int64)
    owner = np.repeat(np.arange(len(bag_list)), lengths)
    cells = len(bag_list) * len(items.ids)
    # No term adds more than weight * 10**6, so their sum bounds every partial sum.
    exact = float(weight.sum()) * 1e6 < EXACT
    total = np.zeros(cells, np.float64 if exact else np.int64)
    for who, item, value in _contributions(items, weight, owner, flat[:, 0], flat[:, 1], m):
        cell = who * len(items.ids) + item
        if exact:
            total += np.bincount(cell, weights=value, minlength=cells)
        else:
            np.add.at(total, cell, value)
    return total.astype(np.int64).reshape(len(bag_list), len(items.ids))


def _best(item: np.ndarray, score: np.ndarray, least: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` best rows of each item by score, then least id."""
    order = np.lexsort((least, -score, item))
    sorted_item = item[order]
    first = np.searchsorted(sorted_item, sorted_item)
    return order[np.arange(len(order)) - first < top]


def best_documents(classes: DataFrame, items: Items, weight: np.ndarray, top: int) -> DataFrame:
    """(item, doc_id, score): per task and item the ``top`` best documents."""
    doc_type = classes.schema["members"].dataType.elementType

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_items = len(items.ids)
        kept: tuple[np.ndarray, np.ndarray, list] = (np.zeros(0, np.int64), np.zeros(0, np.int64), [])
        floor = np.ones(n_items, np.int64)
        step = max(1, CONTRIBUTIONS // n_items)
        for batch in batches:
            for at in range(0, len(batch), step):
                b = batch.slice(at, step)
                scores = class_scores(items, weight, b.column("bag").to_pylist(), b.column("m").to_numpy())
                # Rows below what the item's last kept row has can't enter any more.
                who, item = np.nonzero(scores >= floor)
                if not len(who):
                    continue
                members = b.column("members")
                used, place = np.unique(who, return_inverse=True)
                lists = [members[int(i)].as_py() for i in used]
                all_item, all_score = np.concatenate([kept[0], item]), np.concatenate([kept[1], scores[who, item]])
                all_members = kept[2] + [lists[i] for i in place]
                # Ranks of the first members stand for the ids, which may be of any type.
                leasts = [x[0] for x in all_members]
                rank = {x: r for r, x in enumerate(sorted({x for x in leasts if x is not None}))}
                least = np.array([rank.get(x, len(rank)) for x in leasts], np.int64)
                stay = _best(all_item, all_score, least, top)
                kept = (all_item[stay], all_score[stay], [all_members[i] for i in stay])
                count = np.bincount(kept[0], minlength=n_items)
                full = count >= top
                lowest = np.full(n_items, np.iinfo(np.int64).max)
                np.minimum.at(lowest, kept[0], kept[1])
                floor = np.where(full, lowest, 1)
        give_back()
        out: list[tuple[int, object, int]] = []
        for i in range(n_items):
            mine = np.flatnonzero(kept[0] == i)
            docs = [(kept[1][j], d) for j in mine for d in kept[2][j]]
            docs.sort(key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))
            out += [(i, d, int(s)) for s, d in docs[:top]]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], arrow_type),
                                          pa.array([x[2] for x in out], pa.int64())], ["item", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_type = to_arrow_type(doc_type)
    return classes.select("m", "bag", "members").mapInArrow(score, f"item long, doc_id {doc_type.simpleString()}, score long")


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for f in df.tolist()], np.int64)


def search(documents: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's ``top`` highest-scoring documents."""
    spark = documents.sparkSession
    item_type = only(benchmark, "item_id", "text").schema["item_id"].dataType.simpleString()
    doc_type = only(documents, "doc_id", "text").schema["doc_id"].dataType.simpleString()
    found = None
    for items in item_blocks(benchmark):
        staged = stage(bags(documents, items.vocabulary), "term-bags")
        n_docs, n_terms = staged.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            break
        weight = term_weights(document_frequencies(staged, len(items.vocabulary)), n_docs)
        classes = stage(bag_classes(staged, n_docs, n_terms, top), "bag-classes")
        best = best_documents(classes, items, weight, top).withColumn("group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        for keys in (["item", "group"], ["item"]):
            best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(items.ids)), f"item long, item_id {item_type}")
        block = stage(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "search-block")
        found = block if found is None else found.union(block)
    if found is None:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {doc_type}, score long")
    return found


#: The same rows in DuckDB SQL.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
i AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))) AS term FROM benchmark),
st AS (SELECT count(*) AS n, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
v AS (SELECT DISTINCT term FROM i),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM d) u SEMI JOIN v USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * st.n + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM tf, st GROUP BY term, st.n),
m AS (SELECT doc_id, 100 - 50 + ((50 * len(ts) * st.n) // st.l) AS m FROM d, st),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM tf JOIN w USING (term) JOIN m USING (doc_id) JOIN i USING (term) GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50
"""

"""Exact deduplication, filter audit and ranked search against brute force on small tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.llm import exact_dedup, filter_audit, quotient_filter, ranked_search
from textloom.session import ship_package

DOCS = "doc_id long, text string, lang string, Text_ string, fp string, row string, hash string, n string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def docs(spark, rows):
    """rows of (doc_id, text) or (doc_id, text, lang), with extra columns named like the operators' own."""
    return spark.createDataFrame([(*r, *[None] * (3 - len(r)), "a", "b", "c", "d", "e") for r in rows], DOCS).repartition(5)


ODD = [(5, None), (None, ""), (7, " \n\t "), (8, "a"), (9, "ä Ö 日本 x\x1cy"), (10, "Word " * 4000), (11, "same text twice"), (11, "same text twice"),
       (12, "same text twice"), (None, "same text twice"), (13, ""), (None, "alone"), (None, "alone"), (14, "x" * 300_000), (15, "x" * 300_000)]


# ---- counting quotient filter


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 48).flatmap(lambda bits: st.tuples(st.just(bits), st.lists(st.dictionaries(
    st.integers(0, (1 << bits) - 1), st.one_of(st.integers(1, 3), st.integers(1, 1 << 40)), max_size=40), max_size=5))))
def test_filters_keep_entries_and_merge_without_loss(case):
    bits, parts = case
    built = []
    for part in parts:
        keys = sorted(part)
        f = quotient_filter.build(np.array(keys, np.uint64), np.array([part[k] for k in keys], np.int64), bits)
        prints, counts = quotient_filter.entries(f)
        assert dict(zip(prints.tolist(), counts.tolist())) == part and prints.tolist() == keys
        built.append(f)
    prints, counts = quotient_filter.entries(quotient_filter.merge(built, bits))
    whole = sum((Counter(p) for p in parts), Counter())
    assert list(zip(prints.tolist(), counts.tolist())) == sorted(whole.items())


def test_filter_is_compact():
    prints = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 100_000).astype(np.uint64))
    assert len(quotient_filter.build(prints, np.ones(len(prints), np.int64), 48)) < 8 * len(prints)


# ---- exact deduplication


def dedup_brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        kept_once = False
        for i in ids:
            stays = i == keep and not kept_once
            kept_once |= stays
            out[i, keep, len(ids), stays, sha] += 1
    return out


@pytest.mark.parametrize("bits", [48, 3])
def test_exact_dedup_matches_brute_force(spark, bits, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 10)
    random.seed(7)
    rows = ODD + [(100 + i, f"text {random.randint(0, 40)}") for i in range(120)] + [(1000 + i, "hot") for i in range(150)]
    for limit in (1_000_000, 0):  # repeated fingerprints broadcast, and shuffled
        monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", limit)
        got = Counter(tuple(r) for r in exact_dedup.duplicate_report(docs(spark, rows), bits).collect())
        assert got == dedup_brute(rows)


def test_exact_dedup_empty_and_many_blocks(spark, monkeypatch):
    empty = exact_dedup.duplicate_report(docs(spark, []))
    assert empty.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and empty.count() == 0
    monkeypatch.setattr(exact_dedup, "BLOCK_ROWS", 7)  # filters given out early, several of a block in one task
    rows = [(i, f"t{i % 60}") for i in range(200)]
    assert Counter(tuple(r) for r in exact_dedup.duplicate_report(docs(spark, rows)).collect()) == dedup_brute(rows)


def test_only_repeated_texts_are_verified(spark):
    frame = docs(spark, [(i, f"t{i}") for i in range(50)] + [(60, "t1"), (61, "t1")])
    rows = frame.select("doc_id", exact_dedup._print(F.col("text"), 48).alias("fp"))
    repeated = exact_dedup.repeated_prints(exact_dedup.count_filters(rows, 52))
    assert [r.n for r in repeated.collect()] == [3]
    classes = exact_dedup.verified_classes(frame, repeated, 52)
    assert [(r.n, bytes(r.digest).hex()) for r in classes.collect()] == [(3, hashlib.sha256(b"t1").hexdigest())]


# ---- filter audit


def audit_brute(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = defaultdict(list)
    for i, t, lang in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = {f for f, bad in (("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)),
                                   ("C", 100 * len(re.findall("[A-Z]", t)) > 10 * len(t)), ("D", bool(re.search(r"[#$%&*|]", t))),
                                   ("E", i is not None and i > least[t])) if bad}
        parts[lang or ""].append((failed, i in good, i in toxic))
    out = {}
    for part, found in parts.items():
        sums = Counter()
        for order in permutations("ABCDE"):
            left = found
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[0]]
                fails = sum(f in x[0] for x in found)
                left = [x for x in left if f not in x[0]]
                sums[f] += len(gone)
                out[part, "".join(order), k + 1] = [len(left), len(gone), fails - len(gone), sum(x[0] == {f} for x in found),
                                                    sum(x[1] for x in gone), sum(x[2] for x in gone)]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(sums[order[k - 1]])
    return {(*k, *v) for k, v in out.items()}


def test_filter_audit_matches_brute_force(spark):
    random.seed(5)
    words = [f"w{i}" for i in range(300)] + ["LOUD", "SHOUT", "a#b", "50%"]
    rows = [(i, t, random.choice(["en", None, ""])) for i, t in ODD]
    for i in range(150):
        few = random.sample(words, random.choice([5, 40, 300]))
        rows.append((200 + i, " ".join(random.choices(few, k=random.choice([20, 99, 100, 150]))), random.choice(["en", "de", None])))
    rows += [(random.randint(0, 400), rows[random.randrange(len(rows))][1], random.choice(["en", "de"])) for _ in range(60)]
    labels = [(i, random.choice([0, 1, None]), random.choice([0, 1])) for i in range(0, 400, 2)] + [(8, 0, 1), (8, 1, 0), (None, 1, 1)]
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    got = [tuple(r) for r in filter_audit.audit_filters(docs(spark, rows), marks).collect()]
    assert set(got) == audit_brute(rows, labels) and len(got) == 600 * 3


def test_filter_audit_empty_tables(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(docs(spark, []), marks).count() == 0
    got = filter_audit.audit_filters(docs(spark, [(1, "x", "en")]), marks).collect()
    assert len(got) == 600 and {r.toxic_lost for r in got} == {0} and sum(r.removed for r in got) == 120


def test_intervals_cover_each_order_once():
    ranked = filter_audit.orders()
    assert [filter_audit.lehmer_rank(o) for o in ranked] == list(range(120))
    for mask in range(32):
        steps = {}
        for step, start, stop in filter_audit.removal_intervals(mask):
            for rank in range(start, stop):
                assert rank not in steps
                steps[rank] = step
        for rank, order in enumerate(ranked):
            expected = next((k + 1 for k, f in enumerate(order) if mask & filter_audit.BIT[f]), None)
            assert steps.get(rank) == expected


# ---- ranked search


def search_brute(rows, items, top):
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = lambda t: re.findall(pattern, (t or "").translate(fold))
    found = [(i, Counter(cut(t))) for i, t in rows]
    n_docs = sum(bool(c) for _, c in found)
    n_terms = sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in found:
            m = 50 + (50 * c.total() * n_docs) // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(cut(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i, s))
        out += [(item, r + 1, x[3], x[4]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return Counter(out)


def search_tables(spark):
    random.seed(11)
    words = [f"w{i}" for i in range(60)] + ["Ärger", "日本", "İx", "A1"]
    rows = ODD + [(100 + i, " ".join(random.choices(words, k=random.randint(1, 30)))) for i in range(150)]
    rows += [(random.randint(0, 400), rows[random.randrange(15, 60)][1]) for _ in range(200)]
    rows += [(500 + i, "w1-w2,w3") for i in range(80)] + [(600 + i, "W3 w2 w1") for i in range(40)]
    items = [(i, " ".join(random.sample(words, 6))) for i in range(8)] + [(8, None), (9, "..."), (3, "w1 w2"), (None, "word SAME x w1 w1"), (10, "nowhere")]
    return rows, items


def test_ranked_search_matches_brute_force(spark, monkeypatch):
    rows, items = search_tables(spark)
    bench = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, doc_id string")
    expected = search_brute(rows, items, 50)
    assert Counter(tuple(r) for r in ranked_search.search(docs(spark, rows), bench).collect()) == expected
    monkeypatch.setattr(ranked_search, "BLOCK_POSTINGS", 15)  # items in several blocks
    monkeypatch.setattr(ranked_search, "CONTRIBUTIONS", 40)  # and classes in many
    monkeypatch.setattr(ranked_search, "EXACT", 0.0)  # sums in integers
    few = ranked_search.search(docs(spark, rows), bench, top=7)
    assert Counter(tuple(r) for r in few.collect()) == search_brute(rows, items, 7)


def test_ranked_search_scores_a_class_once(spark):
    staged = ranked_search.bags(docs(spark, [(i, "b a a zzz") for i in range(90)] + [(95, "a zzz b a")]), {b"a": 0, b"b": 1})
    got = ranked_search.bag_classes(staged, 91, 364, 50).collect()
    assert len(got) == 1 and list(got[0].members) == list(range(50)) and got[0].m == 100


def test_ranked_search_odd_tables(spark):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.search(docs(spark, []), bench).count() == 0
    assert ranked_search.search(docs(spark, [(1, None), (2, "--")]), bench).count() == 0
    empty = ranked_search.search(docs(spark, [(1, "a")]), bench.limit(0))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]
    texts = spark.createDataFrame([("k1", "a"), ("k0", "a"), (None, "a c")], "doc_id string, text string")
    assert [(r.rank, r.doc_id) for r in ranked_search.search(texts, bench).orderBy("rank").collect()] == [(1, "k0"), (2, "k1"), (3, None)]

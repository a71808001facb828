"""Filtering stages decide by row: with null and repeated ids each clean row stays and each copy goes."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from textloom.llm import decontaminate, exact_dedup, simhash_pigeonring, staging
from textloom.session import ship_package

SCHEMA = "doc_id long, text string, lang string, key string, kept string, digest string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def table(spark, rows):
    return spark.createDataFrame([(i, t, f"l{n}", "k", "x", "y") for n, (i, t) in enumerate(rows)], SCHEMA).repartition(4)


def words(rng, n):
    return " ".join(f"v{rng.randrange(5000)}" for _ in range(n))


def bench(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_decontamination_keeps_every_clean_row(spark, monkeypatch):
    rng = random.Random(2)
    items = [words(rng, 30) for _ in range(4)]
    clean = [words(rng, 40) for _ in range(12)]
    rows = [(None, clean[0] + " " + items[0]), (None, clean[1]), (1, clean[2]), (2, items[1] + " " + clean[3]), (2, clean[4]), (2, clean[4]),
            (None, None), (3, ""), (4, items[2]), (4, items[2]), (None, items[2]), (5, clean[5] + " " + " ".join(items[3].split()[:10]))]
    bad = {0, 3, 8, 9, 10}
    for limit in (1_000_000, 0):  # decisions broadcast, and shuffled
        monkeypatch.setattr(staging, "BROADCAST_DECISIONS", limit)
        got = decontaminate.remove_contaminated(table(spark, rows), bench(spark, items))
        assert got.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        assert sorted(int(r.lang[1:]) for r in got.collect()) == [n for n in range(len(rows)) if n not in bad]
    found = decontaminate.contaminated(table(spark, rows), bench(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(None, 0), (2, 1), (4, 2), (None, 2)}


def test_contamination_in_a_very_long_text_and_unrelated_items(spark):
    rng = random.Random(4)
    items = [words(rng, 40) for _ in range(60)]
    long = words(rng, 60_000) + " " + items[7] + " " + words(rng, 60_000)
    got = decontaminate.contaminated(table(spark, [(1, long), (2, words(rng, 500))]), bench(spark, items)).collect()
    assert [(r.doc_id, r.item_id, r.similarity) for r in got] == [(1, 7, 1.0)]


def near_brute(rows, distance=4):
    """Row numbers that may stay: one per component, of the least (id, text) there."""
    prints = [simhash_pigeonring.fingerprint((t or "").encode()) for _, t in rows]
    part = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance and part[a] != part[b]:
                part = [part[b] if p == part[a] else p for p in part]
    return [[n for n in range(len(rows)) if part[n] == p] for p in sorted(set(part))]


def test_near_copies_leave_one_row_of_each_group(spark, monkeypatch):
    rng = random.Random(6)
    a, b, c, d = (words(rng, 400) for _ in range(4))
    near_a = a.replace(a.split()[200], "changed", 1)
    rows = [(1, a), (2, a), (2, b), (None, b), (None, c), (None, d), (None, d), (7, c), (7, words(rng, 300)), (7, c), (None, near_a), (None, None), (9, ""),
            (8, words(rng, 50)), (8, words(rng, 50))]
    for limit in (1_000_000, 0):
        monkeypatch.setattr(staging, "BROADCAST_DECISIONS", limit)
        got = sorted(int(r.lang[1:]) for r in simhash_pigeonring.deduplicate(table(spark, rows)).collect())
        groups = near_brute(rows)
        assert len(got) == len(groups)
        for group in groups:
            stays = [n for n in got if n in group]
            assert len(stays) == 1
            assert rows[stays[0]][0] == min((rows[n][0] for n in group if rows[n][0] is not None), default=None)


def test_exact_copies_leave_the_largest_id(spark):
    rows = [(1, "a"), (1, "a"), (3, "a"), (3, "a"), (2, "b"), (None, "b"), (None, "c"), (None, "c"), (3, "c c"), (None, None), (None, "")]
    got = exact_dedup.deduplicate(table(spark, rows))
    assert Counter((r.doc_id, r.text or "") for r in got.collect()) == Counter([(3, "a"), (2, "b"), (None, "c"), (3, "c c"), (None, "")])
    assert got.columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_pipeline_stages_with_null_and_repeated_ids(spark, tmp_path):
    rng = random.Random(8)
    items = [words(rng, 40) for _ in range(3)]
    clean = [words(rng, 200) for _ in range(6)]
    rows = [(None, clean[0]), (None, clean[1]), (5, clean[2]), (5, clean[3]), (5, clean[3]), (6, clean[3]), (None, clean[4] + " " + items[0]),
            (5, clean[5] + " " + items[1])]
    bench(spark, items).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = table(spark, rows)
    stages = dict(corpus_pipeline.STAGES)
    for name in ("simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination"):
        docs = staging.stage(stages[name](spark, docs, str(tmp_path)), name)
    assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter([(None, clean[0]), (None, clean[1]), (5, clean[2]), (5, clean[3])])

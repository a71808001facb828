"""Budgets, prefix cuts, exact k-th cutoffs and splits (FIXTURES.md: Budgets, Splits)."""

import pytest
from pyspark.sql import functions as F

from textloom.operators import order
from textloom.operators.mix import pretrain_budgets, two_way_budget


def test_budgets():
    assert pretrain_budgets(500_000, 0.7) == {"fineweb": 350_000, "hermes": 105_000, "capybara": 45_000}
    assert two_way_budget(100, 0.29) == (28, 72)


@pytest.mark.parametrize("n,valid", [(0, 0), (19, 0), (20, 1), (1000, 50)])
def test_exact_holdout(n, valid):
    assert order.holdout_count(n, 0.05) == valid


@pytest.mark.parametrize("n,valid,train", [(0, 0, 0), (1, 1, 0), (19, 1, 18), (40, 2, 38)])
def test_at_least_one_holdout(spark, n, valid, train):
    df = spark.range(n).select(F.lit("s").alias("source"), "id")
    df = order.with_shuffle_key(df)
    split, nv, total = order.holdout_split(df, 0.05, at_least_one=True)
    counts = {r.split: r.n for r in order.counts_by_split(split).collect()}
    assert (nv, total) == (valid, n)
    assert counts == {"valid": valid, "train": train}


def test_split_matches_full_sort_and_ignores_partitioning(spark):
    df = order.with_shuffle_key(spark.range(5000).select(F.lit("web").alias("source"), "id"))
    expected = {r.id for r in df.orderBy("key", "source", "id").limit(250).collect()}
    for parts in (1, 3, 16):
        split, nv, _ = order.holdout_split(df.repartition(parts), 0.05)
        got = {r.id for r in split.where("split = 'valid'").collect()}
        assert nv == 250 and got == expected


def test_kth_key_refines_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(order, "BUCKET_ROWS", 3)
    df = order.with_shuffle_key(spark.range(3000).select(F.lit("x").alias("source"), "id"))
    ordered = df.orderBy("key", "source", "id").collect()
    for k in (1, 2, 777, 3000):
        assert order.kth_smallest_by_key(df, k) == tuple(ordered[k - 1][c] for c in ("key", "source", "id"))


def test_first_n_ids_sparse_and_duplicated(spark):
    ids = [i * i for i in range(400)] * 2  # sparse, each id twice (turn rows of one conversation)
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    for n in (1, 7, 123, 399, 400, 1000):
        got = sorted({r.id for r in order.first_n_ids(df, n).collect()})
        assert got == sorted(set(ids))[:n]
    assert order.first_n_ids(df, 0).count() == 0


def test_first_n_rows_are_n_rows(spark):
    repeated = spark.createDataFrame([(i % 5, f"t{i}") for i in range(20)], "id long, text string")
    assert order.first_n_rows(repeated, 4).count() == 4
    assert {r.id for r in order.first_n_rows(repeated, 4).collect()} == {0}
    assert sorted(r.id for r in order.first_n_rows(repeated, 6).collect()) == [0, 0, 0, 0, 1, 1]
    half_null = spark.createDataFrame([(i if i < 10 else None, f"t{i}") for i in range(20)], "id long, text string")
    assert order.first_n_rows(half_null, 100).count() == 20
    assert order.first_n_rows(half_null, 12).where("id is null").count() == 2
    assert order.first_n_rows(half_null.where("id is null"), 3).count() == 3
    named = spark.createDataFrame([(f"u{i:02d}", "t") for i in range(20)], "id string, text string")
    assert sorted(r.id for r in order.first_n_rows(named, 10).collect()) == [f"u{i:02d}" for i in range(10)]
    assert order.first_n_rows(named, None).count() == 20 and order.first_n_rows(named, 0).count() == 0


def test_split_with_null_ids(spark):
    df = spark.createDataFrame([("s", i if i % 3 else None, "t") for i in range(100)], "source string, id long, text string")
    split, n_valid, n = order.holdout_split(order.with_shuffle_key(df), 0.5)
    assert (n_valid, n) == (50, 100)
    assert split.where("split = 'valid'").count() in range(50, 85)  # rows that agree in key, source and id stay together


def test_written_splits_are_in_shuffle_order(spark, tmp_path):
    from textloom.sources.sinks import write_splits, written_order

    df = order.with_shuffle_key(spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), "id", F.col("id").cast("string").alias("text")))
    split, n_valid, _ = order.holdout_split(df, 0.05)
    write_splits(order.range_ordered(split, lead=("split",)), str(tmp_path / "out"), ["text"], n_valid)
    got = {}
    for r in written_order(spark, str(tmp_path / "out"), ["split"]).orderBy("split", "row_no").collect():
        got.setdefault(r.split, []).append(r.value)
    for part in ("train", "valid"):
        want = [f'{{"text":"{r.id}"}}' for r in split.where(F.col("split") == part).orderBy("key", "source", "id").collect()]
        assert got[part] == want


def test_selection_for_any_ordered_type_equals_a_full_sort(spark, monkeypatch):
    import datetime
    import random

    rng = random.Random(3)
    monkeypatch.setattr(order, "BUCKET_ROWS", 20)
    monkeypatch.setattr(order, "SPLITTERS", 5)
    start = datetime.datetime(2020, 1, 1)
    columns = {
        "string": ["é" + str(rng.randrange(300)) if rng.random() < 0.5 else f"u{rng.randrange(40)}" for _ in range(700)] + ["hot"] * 300,
        "timestamp": [start + datetime.timedelta(seconds=rng.randrange(10_000)) for _ in range(1000)],
        "double": [rng.choice([0.5, -1.25, 3e9, 7.0]) * rng.randrange(100) for _ in range(1000)],
        "binary": [bytes([rng.randrange(256) for _ in range(rng.randrange(3))]) for _ in range(1000)],
    }
    for kind, values in columns.items():
        df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 50, f"id {kind}").repartition(7)
        ordered = sorted(values)
        for k in (1, 17, 500, 1000):
            value, below, same = order.kth_smallest_value(df, k, "id")
            assert (value, below, same) == (ordered[k - 1], sum(v < ordered[k - 1] for v in values), values.count(ordered[k - 1]))
        assert order.kth_smallest_value(df, 1001, "id") is None
        for n in (3, 640, 1000, 1020, 2000):
            got = [r.id for r in order.first_n_rows(df, n).collect()]
            assert len(got) == min(n, 1050) and sorted(bytes(v) if kind == "binary" else v for v in got if v is not None) == ordered[:n]


def test_equal_ids_are_cut_by_content_whatever_the_partitioning(spark):
    rows = [("hot", f"t{i}") for i in range(500)] + [("a", "first")]
    taken = [sorted(r.text for r in order.first_n_rows(spark.createDataFrame(rows, "id string, text string").repartition(p), 101).collect()) for p in (1, 6)]
    assert taken[0] == taken[1] and len(taken[0]) == 101 and "first" in taken[0]


def test_prefix_in_dataset_order(spark, tmp_path):
    from textloom.sources import rowprefix
    from textloom.sources.tables import parquet_text_source

    path = str(tmp_path / "a set")  # a name that is escaped in file paths
    spark.range(1000).select((1000 - F.col("id")).alias("x"), F.concat(F.lit("t"), "id").alias("text")).repartitionByRange(9, F.desc("x")).sortWithinPartitions(F.desc("x")).write.parquet(path)
    for n in (0, 1, 99, 100, 640, 1000, 5000, None):
        got = sorted((r.row_no, r.text) for r in rowprefix.rows_in_order(spark, path, n).collect())
        assert got == [(i, f"t{i}") for i in range(1000)][:n]
    # Files beyond the prefix are neither counted nor read.
    df = spark.read.parquet(path)
    files = sorted(set(df.inputFiles()))
    assert len(rowprefix.file_rows(df, 5)) == 1 and len(rowprefix.file_rows(df, 1000)) == len(files)
    broken = files[-1].replace("file://", "").replace("%20", " ")
    with open(broken, "wb") as f:
        f.write(b"not a parquet file")
    assert rowprefix.rows_in_order(spark, path, 300).count() == 300
    source = parquet_text_source(spark, path, "web")
    assert [r.id for r in source.load(5).orderBy("id").collect()] == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="no column idd"):
        parquet_text_source(spark, path, "web", id_col="idd").load(5)
    spark.range(0).select("id", F.lit("t").alias("text")).write.parquet(str(tmp_path / "none"))
    assert rowprefix.rows_in_order(spark, str(tmp_path / "none"), 4).count() == 0

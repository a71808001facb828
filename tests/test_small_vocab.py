"""The vocabulary that SQL learns too: special tokens inside texts, unknown bytes, empty and null texts, ties."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

NAMES = ["bpe_merges_256", "vocab_table_256", "vocab_size_256", "encode_ids_256", "encode_pair_256", "context_windows_ids_256"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("small")
    docs = [(1, "abab abab aaaa aaa"), (2, "<s>the <code>the cat</code>sat</s> <unk"), (3, ""), (4, None), (5, "  two  spaces\n\nit's"),
            (6, "the cat " * 700), (7, "é è 1234")]
    turns = [(1, 1, "user", "the cat"), (1, 2, "assistant", "Ω unknown <s>bytes"), (1, 3, "user", None), (2, 1, "user", ""), (2, 2, "user", "abab")]
    spark.createDataFrame(docs, "doc_id long, text string").toPandas().to_parquet(f"{root}/documents.parquet")
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").toPandas().to_parquet(f"{root}/conversations.parquet")
    return str(root)


@pytest.mark.parametrize("name", NAMES)
def test_small_vocabulary(spark, tables, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], tables, duck(tables))
    assert r["spark_rows"] > 0 and r["schema_match"] and r["value_match"], r

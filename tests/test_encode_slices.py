"""Encoding in slices of a batch: every text in its place, the encoder run once under context windows."""

import numpy as np

from textloom.functions.bytelevel import byte_chars
from textloom.operators.bpe import SPECIALS_CLI, train_bpe
from textloom.operators.encode import encode, merge_token, slices
from textloom.operators.windows import context_windows


def test_slices_keep_a_text_together():
    assert list(slices(np.array([2, 3, 9, 0, 1, 4], np.int64), 5)) == [(0, 2), (2, 3), (3, 6)]
    assert list(slices(np.array([0, 0], np.int64), 5)) == [(0, 2)] and list(slices(np.zeros(0, np.int64), 5)) == []


def test_a_batch_of_many_slices(spark):
    v = train_bpe(spark.createDataFrame([("ab ab abc <s>",)], "text string"), 40, 2, SPECIALS_CLI)
    texts = ["ab " * 400_000, "", None, "abc<s>" + "ab" * 50, "b a " * 200_000] + ["ab c"] * 20  # 800,000 pre-tokens and more
    got = {r.id: list(r.ids) for r in encode(spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1), v).collect()}
    ids = v.token_ids()
    first = [ids.get(c, 0) for c in byte_chars()]
    ranks = {(a << 32) + b: (r, n) for r, (a, b, n) in enumerate(v.merges)}
    m = lambda t: merge_token(t, first, ranks)
    ab = m("ab") + m(" ab") * 399_999 + m(" ")
    assert got[0] == [1] + ab + [2] and got[1] == got[2] == [1, 2]
    assert got[3] == [1] + m("abc") + [1] + m("ab" * 50) + [2]
    assert got[4] == [1] + m("b") + m(" a") + (m(" b") + m(" a")) * 199_999 + m(" ") + [2]
    assert all(got[i] == [1] + m("ab") + m(" c") + [2] for i in range(5, 25))


def test_windows_run_the_encoder_once(spark):
    v = train_bpe(spark.createDataFrame([("ab ab abc",)], "text string"), 40, 2, SPECIALS_CLI)
    docs = spark.createDataFrame([(1, "ab " * 9), (2, ""), (3, None)], "id long, text string")
    wins = context_windows(encode(docs, v, add_special_tokens=False), "ids", 4, 1, ["id"])
    assert wins._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1  # was 2
    assert {r.id for r in wins.collect()} == {1}
    arrays = spark.createDataFrame([(1, [1, 2, 3]), (2, []), (3, None)], "id long, ids array<int>")
    assert [(r.id, r.window_no, list(r.window)) for r in context_windows(arrays, "ids", 2, 0, ["id"]).orderBy("window_no").collect()] == \
        [(1, 0, [1, 2]), (1, 1, [3])]

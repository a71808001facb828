"""Golden edge rows for turn fields, roles and renderers (FIXTURES.md section 4, Turns)."""

from pyspark.sql import functions as F

from textloom.operators.chat import render_chat, render_template

MAP_SCHEMA = "id long, turns array<map<string,string>>"


def _render(spark, rows, style="chatml", schema=MAP_SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return {r.id: r.text for r in render_chat(df, "turns", style).collect()}


def test_turn_key_variants_and_roles(spark):
    rows = [
        (1, [{"from": "human", "value": "a"}]),
        (2, [{"role": "bot", "content": "a"}]),
        (3, [{"from": "gpt", "role": "user", "value": "x"}]),          # from wins
        (4, [{"from": None, "role": "user", "value": "x"}]),            # present null from: dropped
        (5, [{"role": "User", "content": "x"}, {"role": "tool", "content": "y"}, {"role": "", "content": "z"},
             {"content": "w"}]),                                         # all unknown: conversation dropped
        (6, [{"role": "user", "content": None}]),                       # null content -> None
        (7, [{"role": "user"}]),                                        # missing content -> ''
        (8, []),
        (9, None),
        (10, [{"role": "system", "content": "s\n\n"}, {"role": "assistant", "content": "b"}]),
    ]
    out = _render(spark, rows)
    assert out[1] == "<|im_start|>user\na<|im_end|>"
    assert out[2] == "<|im_start|>assistant\na<|im_end|>"
    assert out[3] == "<|im_start|>assistant\nx<|im_end|>"
    assert 4 not in out and 5 not in out and 8 not in out and 9 not in out
    assert out[6] == "<|im_start|>user\nNone<|im_end|>"
    assert out[7] == "<|im_start|>user\n<|im_end|>"
    assert out[10] == "<|im_start|>system\ns\n\n<|im_end|>\n<|im_start|>assistant\nb<|im_end|>"


def test_raw_rendering(spark):
    rows = [(1, [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}, {"from": "system", "value": "s"}]),
            (2, [{"from": "tool", "value": "x"}])]
    out = _render(spark, rows, "raw")
    assert out == {1: "User: hi\n\nAssistant: yo\n\nSystem: s"}


def test_struct_turns_choose_field_by_schema(spark):
    schema = "id long, turns array<struct<role:string, content:string>>"
    df = spark.createDataFrame([(1, [("human", "a"), ("gpt", "b")])], schema)
    assert render_chat(df, "turns", "chatml").first().text == \
        "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>"
    assert render_chat(df, "missing_field").count() == 0


def test_chat_template_keeps_roles_verbatim(spark):
    df = spark.createDataFrame([(1, [("tool", "x"), ("User", "y")])],
                               "id long, messages array<struct<role:string, content:string>>")
    t = render_template(df, "messages", add_generation_prompt=True).first().text
    assert t == "<|im_start|>tool\nx<|im_end|>\n<|im_start|>User\ny<|im_end|>\n<|im_start|>assistant\n"
    assert render_template(df, "messages").first().text.endswith("<|im_end|>\n")


def test_template_keeps_null_content(spark):
    from textloom.functions.chat import chat_template_text

    df = spark.createDataFrame([([("user", None), ("assistant", "x")],)], "m array<struct<role: string, content: string>>")
    got = df.select(chat_template_text(F.col("m")).alias("t")).first().t
    assert got == "<|im_start|>user\nNone<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"

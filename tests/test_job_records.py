"""Counts taken while writing, kept bad lines, stage manifests, saved tokenizers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from textloom.operators.bpe import SPECIALS_CLI, Vocabulary, train_bpe
from textloom.plans import jobs, stages
from textloom.sources.jsonl import extract_text_auto
from textloom.sources.jsonscan import rebuild_concatenated
from textloom.sources.sinks import counted


def _lines(folder):
    out = []
    for root, _, files in os.walk(folder):
        for f in sorted(files):
            if f.startswith("part-"):
                out += [json.loads(x) for x in open(os.path.join(root, f), encoding="utf-8").read().splitlines()]
    return out


def test_counts_are_taken_by_the_write_itself(spark, tmp_path):
    df, counts = counted(spark.range(1000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("s")).repartition(5), "s", ["a", "b", "c"])
    df.write.parquet(str(tmp_path / "out"))
    assert counts() == {"rows": 1000, "a": 334, "b": 666, "c": 0}


def test_every_dropped_line_is_kept_with_its_reason(spark, tmp_path):
    data = tmp_path / "in.jsonl"
    data.mkdir()
    (data / "a.jsonl").write_text('{"text": "one"}\n   \n' + "\n".join(['{"text": "two two"}'] * 9) + '\nbad\n{"other": 1}\n[1]\n{"text": null}\n{"text": 5}\n', encoding="utf-8")
    (data / "b.jsonl").write_text('{\n"text": "three"\n}\n{\n oops\n}\n{\n"text": "late"\n}\n{\n"text": "open"\n', encoding="utf-8")
    res = jobs.train_tokenizer(spark, str(data), str(tmp_path / "tok"), 40)
    assert res.counts["texts"] == 11
    assert res.dropped == {"blank": 1, "invalid": 2, "no_key": 1, "not_object": 1, "null_text": 1, "non_string": 1, "after_invalid": 1, "unclosed": 1}
    kept = sorted((os.path.basename(x["file"]), x["status"], x["line"].strip()) for x in _lines(tmp_path / "tok" / "quarantine"))
    assert kept == sorted([("a.jsonl", "blank", ""), ("a.jsonl", "invalid", "bad"), ("a.jsonl", "no_key", '{"other": 1}'), ("a.jsonl", "not_object", "[1]"),
                           ("a.jsonl", "null_text", '{"text": null}'), ("a.jsonl", "non_string", '{"text": 5}'), ("b.jsonl", "invalid", "{\n oops\n}"),
                           ("b.jsonl", "after_invalid", '{\n"text": "late"\n}'), ("b.jsonl", "unclosed", '{\n"text": "open"')])
    ok = extract_text_auto(spark, str(data)).where("status = 'ok'")
    assert ok.count() == 11 and extract_text_auto(spark, str(data), keep_dropped=True).where("status = 'ok'").count() == 11


@pytest.mark.parametrize("size", ["134217728", "16"])
def test_repair_keeps_what_it_drops(spark, tmp_path, size):
    texts = {"a.json": '{"a": 1}{oops}{"b": 2', "b.json": '{"c": "}"} tail', "c.json": '{"d": 1}\n', "d.json": "never opened", "e.json": '{"x": {"y": 1}', "f.json": '{"z": 1}'}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        rows = rebuild_concatenated(spark, str(tmp_path), keep_dropped=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    pieces = {}
    for r in sorted(rows, key=lambda r: (r.file, r.obj_no, r.status == "unclosed")):
        pieces.setdefault(os.path.basename(r.file), []).append(r)
    assert {f: [r.line for r in p if r.status == "ok"] for f, p in pieces.items()} == {
        "a.json": ['{"a": 1}'], "b.json": [], "c.json": ['{"d": 1}'], "d.json": [], "e.json": [], "f.json": ['{"z": 1}']}
    # Nothing is lost: all pieces of a file, in order, are its text (but for blank ends).
    assert {f: "".join(r.line for r in p) for f, p in pieces.items()} == {f: t.rstrip("\n") for f, t in texts.items()}


def test_fix_jsonl_writes_a_quarantine(spark, tmp_path):
    p = tmp_path / "in.json"
    p.write_text('{"b": 2}{oops}\n{"a": "}"}{"c"', encoding="utf-8")
    res = jobs.fix_jsonl(spark, str(p), str(tmp_path / "plain"))
    assert res.counts == {"objects": 1} and res.dropped == {"invalid": 2, "unclosed": 1}
    aware = jobs.fix_jsonl(spark, str(p), str(tmp_path / "aware"), string_aware=True)
    assert _lines(tmp_path / "aware") == [{"b": 2}, {"a": "}"}] and aware.dropped == {"invalid": 1, "unclosed": 1}
    assert sorted(x["status"] for x in _lines(tmp_path / "aware.quarantine")) == ["invalid", "unclosed"]


def test_skipped_stages_must_match_their_manifest(spark, tmp_path):
    tables, out = tmp_path / "tables", str(tmp_path / "out")
    for name in ("documents", "conversations", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(60).coalesce(1).write.parquet(str(tables / f"{name}.parquet"))
    run = lambda **kw: jobs.run_all(spark, str(tables), out, vocab_size=300, pretrain_samples=40, chatml_samples=20, **kw)
    with pytest.raises(FileNotFoundError, match="pretrain was never finished"):
        run(skip={"pretrain"})
    first = run(skip={"chatml", "textset"})
    assert list(first) == ["pretrain", "tokenizer", "chatml", "textset"] and first["chatml"] is None and first["tokenizer"].counts["vocab_size"] == 300
    found = stages.read_manifest(spark, f"{out}/manifests/pretrain")
    assert found["counts"] == first["pretrain"].counts and found["parameters"] == {"samples": 40}
    again = run(skip={"pretrain", "tokenizer"})
    assert again["pretrain"] is None and again["tokenizer"] is None and again["textset"].counts["train"] > 0
    with pytest.raises(ValueError, match="pretrain was made from other parameters"):
        jobs.run_all(spark, str(tables), out, {"pretrain", "tokenizer", "chatml", "textset"}, 300, 41, 20)
    spark.range(1).write.mode("append").parquet(str(tables / "conversations.parquet" / "more"))
    with pytest.raises(ValueError, match="made from other inputs"):
        run(skip={"pretrain", "tokenizer", "chatml", "textset"})
    with pytest.raises(ValueError, match="no such stages"):
        run(skip={"pretrian"})


def test_saved_tokenizers_are_read_back(spark, tmp_path):
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers

    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(50).collect()]
    own = train_bpe(spark.createDataFrame([(t,) for t in texts], "text string"), 320, 2, SPECIALS_CLI)
    back = Vocabulary.from_tokenizer_json(own.tokenizer_json()[0])
    assert (back.tokens, back.kinds, back.merges, back.specials) == (own.tokens, own.kinds, own.merges, own.specials)
    tok = Tokenizer(models.BPE(unk_token="<unk>"))
    tok.pre_tokenizer, tok.decoder = pre_tokenizers.ByteLevel(add_prefix_space=False), decoders.ByteLevel()
    tok.train_from_iterator(texts, trainers.BpeTrainer(vocab_size=400, min_frequency=2, special_tokens=SPECIALS_CLI, show_progress=False))
    (tmp_path / "tok").mkdir()
    tok.save(str(tmp_path / "tok" / "tokenizer.json"))
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key long, text string").write.parquet(str(tmp_path / "texts"))
    from textloom import cli
    assert cli.main(["encode", "--data", str(tmp_path / "texts"), "--tokenizer", str(tmp_path / "tok"), "--output", str(tmp_path / "ids"), "--id-column", "key"]) == 0
    got = {r.id: list(r.ids) for r in spark.read.parquet(str(tmp_path / "ids")).collect()}
    assert {i: ids[1:-1] for i, ids in got.items()} == {i: tok.encode(t).ids for i, t in enumerate(texts)}
    res = jobs.encode_set(spark, str(tmp_path / "texts"), str(tmp_path / "tok" / "tokenizer.json"), str(tmp_path / "wins"), size=64, overlap=8)
    wins = spark.read.parquet(str(tmp_path / "wins")).collect()
    assert res.counts["rows"] == len(wins) == sum(-(-max(len(x) - 8, 1) // 56) for x in got.values()) and max(len(r.ids) for r in wins) == 64
    with pytest.raises(ValueError, match="not a byte-level BPE"):
        Vocabulary.from_tokenizer_json(json.dumps({"model": {"type": "WordPiece", "vocab": {}, "merges": []}}))

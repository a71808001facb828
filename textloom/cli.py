"""Command surface of the data jobs (J4), runnable with ``spark-submit`` or ``python -m textloom.cli``.

Sources are Parquet datasets (the reference downloads hub datasets; here their
copies are given as paths).  Flags and defaults follow the reference.

    prepare-chatml  --first PATH --second PATH [--samples 50000] [--output DIR] [--hermes-only]
                    [--capybara-only] [--hermes-ratio 0.7] [--seed 42] [--val-split 0.05]
    tokenizer       --data PATH --output DIR [--vocab-size 32000] [--min-frequency 2]
    fix-jsonl       INPUT [--output DIR] [--string-aware]
    encode          --data --tokenizer --output [--window N --overlap N]
    pretrain-mix    --web PATH --first PATH --second PATH --output DIR [--total 500000] [--web-ratio 0.7]
    chatml-set      --first PATH --second PATH --output DIR [--samples 100000] [--hermes-ratio 0.7]
    text-set        --items PATH --output DIR
    run-all         --tables DIR --output DIR [--skip pretrain,tokenizer,chatml,textset] [--vocab-size 32000]
                    [--pretrain-samples 500000] [--chatml-samples 100000]

Command, flag and short-option names and their defaults are fixed values: they are the interface.
"""

from __future__ import annotations

import argparse
import json
import sys

from textloom.plans import jobs
from textloom.session import build_session
from textloom.sources.tables import parquet_chat_source, parquet_text_source


def _chat_sources(spark, args) -> dict:
    return {"hermes": parquet_chat_source(spark, args.first, "hermes", "conversations", args.id_column),
            "capybara": parquet_chat_source(spark, args.second, "capybara", "conversation", args.id_column)}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="textloom")
    ap.add_argument("--master", default=None, help="Spark master (default: the one spark-submit gives)")
    ap.add_argument("--shuffle-partitions", default="200", help="spark.sql.shuffle.partitions (AQE coalesces)")
    sub = ap.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("prepare-chatml")
    c.add_argument("--first", required=True, help="Parquet dataset with `conversations` (from/value turns)")
    c.add_argument("--second", required=True, help="Parquet dataset with `conversation` (role/content turns)")
    c.add_argument("--id-column", default=None, help="order of the items (default: the order of the files and their rows)")
    c.add_argument("--samples", "-n", type=int, default=50_000)
    c.add_argument("--output", "-o", default="chatml_train")
    c.add_argument("--hermes-only", action="store_true")
    c.add_argument("--capybara-only", action="store_true")
    c.add_argument("--hermes-ratio", type=float, default=0.7)
    c.add_argument("--seed", type=int, default=42)
    c.add_argument("--val-split", type=float, default=0.05)

    t = sub.add_parser("tokenizer")
    t.add_argument("--data", "-d", required=True)
    t.add_argument("--output", "-o", default="tokenizer")
    t.add_argument("--vocab-size", "-v", type=int, default=32_000)
    t.add_argument("--min-frequency", "-m", type=int, default=2)
    t.add_argument("--variant", choices=["cli", "pipeline"], default="cli")

    f = sub.add_parser("fix-jsonl")
    f.add_argument("input")
    f.add_argument("--output", "-o", default=None)
    f.add_argument("--string-aware", action="store_true", help="braces inside strings don't count")

    e = sub.add_parser("encode")
    e.add_argument("--data", "-d", required=True, help="Parquet dataset of texts")
    e.add_argument("--tokenizer", "-t", required=True, help="tokenizer.json or the folder that holds it")
    e.add_argument("--output", "-o", required=True)
    e.add_argument("--id-column", default=None, help="id of the texts (default: their place in the dataset)")
    e.add_argument("--text-column", default="text")
    e.add_argument("--window", type=int, default=None, help="cut the ids into windows of this size")
    e.add_argument("--overlap", type=int, default=0)

    m = sub.add_parser("pretrain-mix")
    m.add_argument("--web", required=True)
    m.add_argument("--first", required=True)
    m.add_argument("--second", required=True)
    m.add_argument("--id-column", default=None, help="order of the items (default: the order of the files and their rows)")
    m.add_argument("--output", "-o", required=True)
    m.add_argument("--total", type=int, default=500_000)
    m.add_argument("--web-ratio", type=float, default=0.7)

    d = sub.add_parser("chatml-set")
    d.add_argument("--first", required=True)
    d.add_argument("--second", required=True)
    d.add_argument("--id-column", default=None, help="order of the items (default: the order of the files and their rows)")
    d.add_argument("--output", "-o", required=True)
    d.add_argument("--samples", "-n", type=int, default=100_000)
    d.add_argument("--hermes-ratio", type=float, default=0.7)

    x = sub.add_parser("text-set")
    x.add_argument("--items", required=True, help="Parquet dataset with a `text` column")
    x.add_argument("--id-column", default=None, help="order of the items (default: the order of the files and their rows)")
    x.add_argument("--output", "-o", required=True)

    r = sub.add_parser("run-all")
    r.add_argument("--tables", required=True, help="directory with documents/conversations/benchmark Parquet")
    r.add_argument("--output", "-o", required=True)
    r.add_argument("--skip", default="")
    r.add_argument("--vocab-size", type=int, default=32_000)
    r.add_argument("--pretrain-samples", type=int, default=500_000)
    r.add_argument("--chatml-samples", type=int, default=100_000)

    args = ap.parse_args(argv)
    spark = build_session(args.master, shuffle_partitions=int(args.shuffle_partitions))
    if args.cmd == "prepare-chatml":
        res = jobs.prepare_chatml_cli(spark, _chat_sources(spark, args), args.output, args.samples,
                                      args.hermes_only, args.capybara_only, args.hermes_ratio, args.seed,
                                      args.val_split)
    elif args.cmd == "tokenizer":
        res = jobs.train_tokenizer(spark, args.data, args.output, args.vocab_size, args.min_frequency, args.variant)
    elif args.cmd == "fix-jsonl":
        res = jobs.fix_jsonl(spark, args.input, args.output or args.input.rstrip("/") + ".fixed", args.string_aware)
    elif args.cmd == "encode":
        res = jobs.encode_set(spark, args.data, args.tokenizer, args.output, args.id_column, args.text_column, args.window, args.overlap)
    elif args.cmd == "pretrain-mix":
        src = _chat_sources(spark, args)
        src["fineweb"] = parquet_text_source(spark, args.web, "fineweb", args.id_column)
        res = jobs.prepare_pretrain_data(spark, src, args.output, args.total, args.web_ratio)
    elif args.cmd == "chatml-set":
        res = jobs.prepare_chatml_data(spark, _chat_sources(spark, args), args.output, args.samples, args.hermes_ratio)
    elif args.cmd == "text-set":
        res = jobs.prepare_textset(spark, parquet_text_source(spark, args.items, "textset", args.id_column, kind="text"), args.output)
    else:
        skip = {s for s in args.skip.split(",") if s}
        res = jobs.run_all(spark, args.tables, args.output, skip, args.vocab_size, args.pretrain_samples,
                           args.chatml_samples)
        res = {k: (v.counts if v else None) for k, v in res.items()}
        print(json.dumps(res))
        return 0
    print(json.dumps({"output": res.output, "counts": res.counts, "preview": res.preview, "failed": res.failed, "dropped": res.dropped}, ensure_ascii=False))
    return 0


if __name__ == "__main__":
    sys.exit(main())

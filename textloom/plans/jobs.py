"""Jobs (J1-J4): the reference's data steps as Spark jobs with the same parameters.

Every job reads its inputs through the operators, writes its outputs to directories
(never in place), and returns the small statistics the reference prints.
Stage outputs are written per source, so a source that fails while being read is
reported and contributes zero rows (S9) instead of failing the whole mix.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import order
from textloom.operators.bpe import SPECIALS_CLI, SPECIALS_PIPELINE, Vocabulary, train_bpe
from textloom.operators.chat import nonempty_text
from textloom.operators.encode import encode
from textloom.operators.mix import chatml_budgets, load_samples, pretrain_budgets
from textloom.operators.windows import context_windows
from textloom.plans.stages import check_manifest, manifest, read_manifest, write_manifest
from textloom.sources.jsonl import extract_text_auto, strict_jsonl
from textloom.sources.jsonscan import rebuild_concatenated
from textloom.sources.sinks import counted, write_jsonl, write_splits, write_text_file
from textloom.sources.tables import READ_ERRORS, Source, is_source_fault, parquet_text_source, standard_sources, table_path
from textloom.sources.text import training_lines
from textloom.session import fresh_path

log = logging.getLogger(__name__)

# Fixed value: the chat template of the pipeline's tokenizer config.
CHAT_TEMPLATE = ("{% for message in messages %}{{'<|im_start|>' + message['role'] + '\n' + message['content'] + "
                 "'<|im_end|>\n'}}{% endfor %}{% if add_generation_prompt %}{{ '<|im_start|>assistant\n' }}{% endif %}")

#: All that can become of a line or a rebuilt chunk.
LINE_STATUSES = ["ok", "blank", "invalid", "not_object", "no_key", "null_text", "non_string", "after_invalid", "unclosed"]


@dataclass
class JobResult:
    output: str
    counts: dict[str, int] = field(default_factory=dict)
    preview: str | None = None
    failed: list[str] = field(default_factory=list)  # sources that could not be read (S9)
    dropped: dict[str, int] = field(default_factory=dict)  # quarantined lines by reason (F6)


def _stage_sources(spark: SparkSession, sources: dict[str, Source], budgets: dict[str, int],
                   style: str, seed: int) -> tuple[DataFrame, dict[str, int], list[str]]:
    """Each source rendered, tagged, keyed and written as its own stage; the rows of each, counted on the way
    (A1-A3), and the sources that could not be read.

    Only a missing or unreadable source counts as zero rows; any other error fails the job.
    """
    parts, failed = [], []
    counts = dict.fromkeys(budgets, 0)
    for name, n in budgets.items():
        path = fresh_path(spark, f"source-{name}")
        try:
            samples = load_samples(spark, sources[name], n, style, tolerant=False)
            keyed, rows = counted(order.with_shuffle_key(samples, seed))
            keyed.write.parquet(path)
            parts.append(spark.read.parquet(path))
            counts[name] = rows()["rows"]
        except READ_ERRORS as exc:
            if not is_source_fault(exc):
                raise
            failed.append(name)
            log.warning("source %s failed while loading: %s", name, str(exc).splitlines()[0])
    if not parts:
        return spark.createDataFrame([], "source string, id long, text string, key string"), counts, failed
    if len({p.schema["id"].dataType.simpleString() for p in parts}) > 1:  # sources may number or name their items
        parts = [p.withColumn("id", F.col("id").cast("string")) for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, counts, failed


def prepare_pretrain_data(spark: SparkSession, sources: dict[str, Source], output: str,
                          total_samples: int = 500_000, web_ratio: float = 0.7, seed: int = 42) -> JobResult:
    """Pretraining mix: web 70 %, chat 30 % split 70/30, raw chat text, shuffled, UTF-8 JSONL."""
    mixed, counts, failed = _stage_sources(spark, sources, pretrain_budgets(total_samples, web_ratio), "raw", seed)
    total = sum(counts.values())
    write_jsonl(order.range_ordered(mixed, rows=total), output, ["text", "source"])
    return JobResult(output, counts | {"total": total}, failed=failed)


def prepare_chatml_cli(spark: SparkSession, sources: dict[str, Source], output: str, samples: int = 50_000,
                       first_only: bool = False, second_only: bool = False, first_ratio: float = 0.7,
                       seed: int = 42, val_split: float = 0.05) -> JobResult:
    """CLI ChatML set: ``text, source`` UTF-8; stops when nothing loaded; ``valid`` only when non-empty."""
    budgets = chatml_budgets(samples, first_ratio, first_only, second_only)
    staged, by_source, failed = _stage_sources(spark, sources, budgets, "chatml", seed)
    total = sum(by_source.values())
    if not total:
        raise RuntimeError("no source gave any sample; nothing is written")
    split, n_valid, n = order.holdout_split(staged, val_split, rows=total)
    counts = write_splits(order.range_ordered(split, rows=total, lead=("split",)), output, ["text", "source"], n_valid, always_write_valid=False)
    preview = order.preview(split).first()
    return JobResult(output, counts | {"hermes": 0, "capybara": 0} | by_source, preview[0] if preview else None, failed)


def prepare_chatml_data(spark: SparkSession, sources: dict[str, Source], output: str,
                        num_samples: int = 100_000, first_ratio: float = 0.7, seed: int = 42) -> JobResult:
    """Pipeline ChatML set: ``text`` only, ASCII-escaped, both splits always written."""
    staged, by_source, failed = _stage_sources(spark, sources, chatml_budgets(num_samples, first_ratio), "chatml", seed)
    total = sum(by_source.values())
    split, n_valid, _ = order.holdout_split(staged, 0.05, rows=total)
    counts = write_splits(order.range_ordered(split, rows=total, lead=("split",)), output, ["text"], n_valid, ensure_ascii=True)
    return JobResult(output, counts, failed=failed)


def prepare_textset(spark: SparkSession, source: Source, output: str, seed: int = 42) -> JobResult:
    """Text-only set: whole split, non-empty text, holdout of at least one row, ASCII-escaped."""
    items = nonempty_text(source.load(None)).select(F.lit(source.name).alias("source"), "id", "text")
    staged, counts = _write_stage(order.with_shuffle_key(items, seed), "textset")
    split, n_valid, n = order.holdout_split(staged, 0.05, at_least_one=True, rows=counts["rows"])
    counts = write_splits(order.range_ordered(split, rows=n, lead=("split",)), output, ["text"], n_valid, ensure_ascii=True)
    return JobResult(output, counts)


def _write_stage(df: DataFrame, name: str, by: str | None = None, values: list[str] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """``df`` written and read back, and its counts, observed on the way."""
    path = fresh_path(df.sparkSession, name)
    watched, counts = counted(df, by, values)
    (watched.write.partitionBy(by) if by else watched.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), counts()


def _write_quarantine(staged: DataFrame, counts: dict[str, int], kept: str, output: str) -> dict[str, int]:
    """the rows of a stage by ``status`` that aren't kept, as JSON lines by reason; how many there are of each."""
    dropped = {k: n for k, n in counts.items() if k not in (kept, "rows") and n}
    if dropped:
        write_jsonl(staged.where(F.col("status") != kept), output, ["file", "status", "line"])
    return dropped


def train_tokenizer(spark: SparkSession, data_path: str, output: str, vocab_size: int = 32_000,
                    min_frequency: int = 2, variant: str = "cli") -> JobResult:
    """Vocabulary job.  ``cli``: ``.jsonl`` -> sniff + lenient/multi-line extraction, other
    suffixes -> plain text lines, 14 specials, max length 1024.  ``pipeline``: strict JSONL
    with ``text``, 10 specials, chat template, max length 2048."""
    dropped: dict[str, int] = {}
    if variant == "pipeline":
        texts, counts = _write_stage(strict_jsonl(spark, data_path).select("text"), "training-texts")
        specials, max_len, template = SPECIALS_PIPELINE, 2048, CHAT_TEMPLATE
    elif data_path.endswith(".jsonl"):
        # One write by status: the texts for the trainer, and every other line with its reason.
        rows = extract_text_auto(spark, data_path, keep_dropped=True).select(
            "file", "text", F.when(F.col("status") != "ok", F.col("line")).alias("line"), "status")
        staged, counts = _write_stage(rows, "training-lines", "status", LINE_STATUSES)
        dropped = _write_quarantine(staged, counts, "ok", f"{output}/quarantine")
        texts, counts = staged.where(F.col("status") == "ok").select("text"), {"rows": counts["ok"]}
        specials, max_len, template = SPECIALS_CLI, 1024, None
    else:
        texts, counts = _write_stage(training_lines(spark, data_path), "training-texts")
        specials, max_len, template = SPECIALS_CLI, 1024, None
    vocab = train_bpe(texts, vocab_size, min_frequency, specials)
    vocab.save(spark, output)
    tok_json, config = vocab.tokenizer_json(max_len, template)
    write_text_file(spark, f"{output}/tokenizer.json", tok_json)
    write_text_file(spark, f"{output}/tokenizer_config.json", config)
    return JobResult(output, {"texts": counts["rows"], "vocab_size": vocab.size, "merges": len(vocab.merges)}, dropped=dropped)  # A6, A7


def load_tokenizer(spark: SparkSession, path: str) -> Vocabulary:
    """A vocabulary from a ``tokenizer.json``, or from a folder that holds one."""
    path = path if path.endswith(".json") else f"{path.rstrip('/')}/tokenizer.json"
    return Vocabulary.from_tokenizer_json(spark.read.text(path, wholetext=True).first()["value"])


def encode_set(spark: SparkSession, data_path: str, tokenizer: str, output: str, id_col: str | None = None,
               text_col: str = "text", size: int | None = None, overlap: int = 0) -> JobResult:
    """A Parquet dataset of texts encoded with a saved tokenizer: ``(id, ids)``, or windows of ``size`` ids."""
    vocab = load_tokenizer(spark, tokenizer)
    items = parquet_text_source(spark, data_path, "texts", id_col, text_col).load(None)
    rows = encode(items, vocab)
    if size is not None:
        rows = context_windows(rows, "ids", size, overlap, ["id"]).withColumnRenamed("window", "ids")
    watched, counts = counted(rows)
    watched.write.parquet(output)
    return JobResult(output, counts())


def fix_jsonl(spark: SparkSession, input_path: str, output: str, string_aware: bool = False) -> JobResult:
    """JSON repair: concatenated / pretty-printed objects -> one object per line (new directory).

    What isn't an object that parses goes to ``{output}.quarantine`` with its reason.
    """
    staged, counts = _write_stage(rebuild_concatenated(spark, input_path, string_aware, keep_dropped=True), "fix-jsonl", "status", ["ok", "invalid", "unclosed"])
    if not counts["ok"]:
        raise RuntimeError(f"{input_path} holds no JSON object that parses; nothing is written")
    staged.where(F.col("status") == "ok").orderBy("file", "obj_no").select(F.col("line").alias("value")).write.text(output)
    dropped = _write_quarantine(staged, counts, "ok", f"{output.rstrip('/')}.quarantine")
    return JobResult(output, {"objects": counts["ok"]}, dropped=dropped)


def run_all(spark: SparkSession, sf_dir: str, output: str, skip: set[str] | None = None,
            vocab_size: int = 32_000, pretrain_samples: int = 500_000,
            chatml_samples: int = 100_000) -> dict[str, JobResult | None]:
    """J1 + J2: mix -> vocabulary -> ChatML set -> text-only set; always one entry per stage, None for a skipped one.

    Each finished stage has a manifest of its inputs, parameters, code and counts under ``{output}/manifests``. A skipped
    stage keeps its earlier output: it must have a manifest, made from the same inputs, parameters and code.
    """
    skip = skip or set()
    src = standard_sources(spark, sf_dir)
    out = output.rstrip("/")
    table = lambda *names: [table_path(sf_dir, n) for n in names]
    stages: dict[str, tuple[list[str], dict, Callable[[], JobResult]]] = {
        "pretrain": (table("documents", "conversations"), {"samples": pretrain_samples},
                     lambda: prepare_pretrain_data(spark, src, f"{out}/pretrain_data", pretrain_samples)),
        "tokenizer": ([f"{out}/pretrain_data"], {"vocab_size": vocab_size},
                      lambda: train_tokenizer(spark, f"{out}/pretrain_data", f"{out}/tokenizer", vocab_size, variant="pipeline")),
        "chatml": (table("conversations"), {"samples": chatml_samples},
                   lambda: prepare_chatml_data(spark, src, f"{out}/finetune_chatml", chatml_samples)),
        "textset": (table("benchmark"), {}, lambda: prepare_textset(spark, src["textset"], f"{out}/finetune_text")),
    }
    if unknown := skip - set(stages):
        raise ValueError(f"no such stages: {', '.join(sorted(unknown))}")
    res: dict[str, JobResult | None] = {}
    for name, (inputs, parameters, run) in stages.items():
        path = f"{out}/manifests/{name}"
        if name == "tokenizer" and name not in skip and read_manifest(spark, f"{out}/manifests/pretrain") is None:
            raise FileNotFoundError(f"{out}/pretrain_data")  # J3
        if name in skip:
            # A stage that nothing else reads may be left out altogether; what is there must be whole and up to date.
            found = read_manifest(spark, path)
            if found is not None or name == "pretrain":
                check_manifest(found, manifest(spark, inputs, parameters), name)
            res[name] = None
            continue
        made_from = manifest(spark, inputs, parameters)
        res[name] = run()
        write_manifest(spark, path, made_from, res[name].counts)
    return res


__all__ = ["prepare_pretrain_data", "prepare_chatml_cli", "prepare_chatml_data", "prepare_textset",
           "train_tokenizer", "load_tokenizer", "encode_set", "fix_jsonl", "run_all"]

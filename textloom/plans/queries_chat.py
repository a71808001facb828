"""Registered queries: chat rendering, filters, mixes, budgets, shuffle and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.chat import canonical_role, nonempty_list, turn_content, turn_role
from textloom.operators import order
from textloom.operators.chat import group_turns, nonempty_text, render_template
from textloom.operators.mix import (chatml_budgets, counts_by_source, mix_sources, pretrain_budgets,
                                    running_load_totals)
from textloom.plans.registry import query
from textloom.plans.sql_snippets import KNOWN_ROLES, NL, chat_cte, holdout_sql, key_sql, web_cte
from textloom.session import fresh_path, materialize
from textloom.sources.rowprefix import rows_in_order
from textloom.sources.sinks import write_jsonl, write_splits, written_order
from textloom.sources.tables import role_chat_source, standard_sources, table_path, tolerant_load

# Reference defaults (job parameters, fixed values).
PRETRAIN_TOTAL, WEB_RATIO = 500_000, 0.7
CHATML_CLI_TOTAL, CHATML_PIPELINE_TOTAL, FIRST_RATIO = 50_000, 100_000, 0.7
VAL_RATIO, SEED = 0.05, 42
PRETRAIN_ORDER = ["fineweb", "hermes", "capybara"]
CHAT_ORDER = ["hermes", "capybara"]


# ---------------------------------------------------------------- renderers

def _both_chats(spark, sf_dir, style):
    src = standard_sources(spark, sf_dir)
    return mix_sources(spark, src, {"hermes": None, "capybara": None}, style)


@query("chatml_render", f"{chat_cte(True, None, 'chatml')} UNION ALL {chat_cte(False, None, 'chatml')}")
def chatml_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 over both chat sources (all conversations)."""
    return _both_chats(spark, sf_dir, "chatml")


@query("chat_raw_render", f"{chat_cte(True, None, 'raw')} UNION ALL {chat_cte(False, None, 'raw')}")
def chat_raw_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 over both chat sources (all conversations)."""
    return _both_chats(spark, sf_dir, "raw")


@query("chat_template_render",
       f"SELECT conv_id AS id, string_agg('<|im_start|>' || role || {NL} || text || '<|im_end|>' || {NL}, '' "
       f"ORDER BY turn) || '<|im_start|>assistant' || {NL} AS text FROM conversations GROUP BY conv_id")
def chat_template_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 with the generation prompt, over every conversation as ``messages``."""
    flat = spark.read.parquet(table_path(sf_dir, "conversations"))
    msgs = group_turns(flat, {"role": "role", "content": "text"}, "messages")
    return render_template(msgs, "messages", add_generation_prompt=True)


def _turn_rows(spark, sf_dir):
    src = standard_sources(spark, sf_dir)
    rows = []
    for name in CHAT_ORDER:
        s = src[name]
        items = s.load(None)
        t = items.schema[s.turns_field].dataType.elementType
        rows.append(items.select(F.lit(name).alias("source"), "id",
                                 F.posexplode(s.turns_field).alias("turn", "t"))
                    .select("source", "id", F.col("turn").cast("long").alias("turn"),
                            turn_role(F.col("t"), t).alias("role"), turn_content(F.col("t"), t).alias("content")))
    return rows[0].unionByName(rows[1])


_SHAREGPT_ROLE_SQL = ("CASE WHEN conv_id % 10 < 7 THEN (CASE role WHEN 'user' THEN 'human' "
                      "WHEN 'assistant' THEN 'gpt' ELSE role END) ELSE role END")
_SOURCE_SQL = "CASE WHEN conv_id % 10 < 7 THEN 'hermes' ELSE 'capybara' END"


@query("turn_fields",
       f"SELECT {_SOURCE_SQL} AS source, conv_id AS id, turn, {_SHAREGPT_ROLE_SQL} AS role, text AS content "
       f"FROM conversations")
def turn_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """role/content picked by key presence from {from, value} and {role, content} turns."""
    return _turn_rows(spark, sf_dir)


@query("role_canonical",
       f"SELECT {_SOURCE_SQL} AS source, conv_id AS id, turn, {_SHAREGPT_ROLE_SQL} AS raw_role, "
       f"CASE WHEN role IN {KNOWN_ROLES} THEN role END AS role FROM conversations")
def role_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ShareGPT and plain role names mapped to user / assistant / system."""
    rows = _turn_rows(spark, sf_dir)
    return rows.select("source", "id", "turn", F.col("role").alias("raw_role"),
                       canonical_role(F.col("role")).alias("role"))


@query("nonempty_conv",
       "SELECT conv_id AS id, count(*) AS n_system FROM conversations WHERE role = 'system' GROUP BY conv_id")
def nonempty_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 on the system-turn sublist of every conversation: empty lists are dropped."""
    flat = spark.read.parquet(table_path(sf_dir, "conversations"))
    conv = group_turns(flat, {"role": "role", "content": "text"}, "messages")
    system = conv.select("id", F.filter("messages", lambda m: m["role"] == "system").alias("sys"))
    return system.where(nonempty_list(F.col("sys"))).select("id", F.size("sys").cast("long").alias("n_system"))


@query("nonempty_text",
       f"SELECT doc_id, line_no, line FROM (SELECT doc_id, unnest(string_split(text, {NL})) AS line, "
       f"unnest(range(len(string_split(text, {NL})))) AS line_no FROM documents) WHERE length(line) > 0")
def nonempty_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 on every line of every document: empty lines dropped, whitespace-only kept."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text"))
    return nonempty_text(lines).select("doc_id", F.col("line_no").cast("long").alias("line_no"),
                                       F.col("text").alias("line"))


# ---------------------------------------------------------------- mixes

def _pretrain_mix(spark, sf_dir, sources=None):
    src = sources or standard_sources(spark, sf_dir)
    mix = mix_sources(spark, src, pretrain_budgets(PRETRAIN_TOTAL, WEB_RATIO), "raw")
    return order.with_shuffle_key(mix, SEED)


def _pretrain_sql(cols="source, id, key, text"):
    b = pretrain_budgets(PRETRAIN_TOTAL, WEB_RATIO)
    inner = (f"{web_cte(b['fineweb'])} UNION ALL {chat_cte(True, b['hermes'], 'raw')} "
             f"UNION ALL {chat_cte(False, b['capybara'], 'raw')}")
    return f"SELECT {cols} FROM (SELECT *, {key_sql()} AS key FROM ({inner}) u) m"


@query("mix_pretrain", _pretrain_sql())
def mix_pretrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 + L1b + L2 + P5 + P7 + L4: the pretraining mix with its shuffle key."""
    return _pretrain_mix(spark, sf_dir).select("source", "id", "key", "text")


@query("shuffle_seeded", _pretrain_sql("source, id, key"))
def shuffle_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: deterministic shuffle key of every mixed row (independent of partitioning)."""
    return _pretrain_mix(spark, sf_dir).select("source", "id", "key")


def _counts_sql(inner_sql: str, sources: list[str]) -> str:
    vals = ", ".join(f"('{s}', {i})" for i, s in enumerate(sources))
    return (f"WITH names(source, ord) AS (VALUES {vals}), m AS ({inner_sql}), "
            f"per AS (SELECT names.source, CAST(count(m.source) AS BIGINT) AS n FROM names "
            f"LEFT JOIN m ON m.source = names.source GROUP BY names.source) "
            f"SELECT source, n FROM per UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT) FROM per")


@query("counts_by_source", _counts_sql(_pretrain_sql("source"), PRETRAIN_ORDER))
def counts_by_source_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A2: rows per source (zeros shown) and the total of the pretraining mix."""
    return counts_by_source(_pretrain_mix(spark, sf_dir), PRETRAIN_ORDER)


@query("running_load_totals",
       "WITH names(source, ord) AS (VALUES ('fineweb', 0), ('hermes', 1), ('capybara', 2)), "
       f"m AS ({_pretrain_sql('source')}), per AS (SELECT names.source, names.ord, "
       "CAST(count(m.source) AS BIGINT) AS loaded FROM names LEFT JOIN m ON m.source = names.source "
       "GROUP BY names.source, names.ord) SELECT source, CAST(ord AS BIGINT) AS load_order, loaded, "
       "CAST(sum(loaded) OVER (ORDER BY ord) AS BIGINT) AS running_total FROM per")
def running_load_totals_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: size of the mix after each source is loaded."""
    return running_load_totals(_pretrain_mix(spark, sf_dir), PRETRAIN_ORDER)


def _budget_sql():
    b = pretrain_budgets(PRETRAIN_TOTAL, WEB_RATIO)
    vals = ", ".join(f"('{s}', {i}, {b[s]})" for i, s in enumerate(PRETRAIN_ORDER))
    return (f"WITH names(source, ord, budget) AS (VALUES {vals}), m AS ({_pretrain_sql('source')}) "
            f"SELECT names.source, CAST(names.budget AS BIGINT) AS budget, CAST(count(m.source) AS BIGINT) "
            f"AS loaded FROM names LEFT JOIN m ON m.source = names.source GROUP BY names.source, names.budget")


@query("mix_budget", _budget_sql())
def mix_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 + L1b: budget per source of the 500,000-sample mix and rows actually delivered."""
    b = pretrain_budgets(PRETRAIN_TOTAL, WEB_RATIO)
    budgets = spark.createDataFrame([(s, b[s]) for s in PRETRAIN_ORDER], "source string, budget long")
    counts = counts_by_source(_pretrain_mix(spark, sf_dir), PRETRAIN_ORDER, with_total=False)
    return budgets.join(counts, "source").select("source", "budget", F.col("n").alias("loaded"))


def _missing_sql():
    b = pretrain_budgets(PRETRAIN_TOTAL, WEB_RATIO)
    inner = f"{web_cte(b['fineweb'])} UNION ALL {chat_cte(True, b['hermes'], 'raw')}"
    return _counts_sql(f"SELECT source FROM ({inner}) u", PRETRAIN_ORDER)


@query("mix_missing_source", _missing_sql())
def mix_missing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second chat source points at a missing table: warning, zero rows, mix goes on."""
    src = standard_sources(spark, sf_dir)
    src["capybara"] = role_chat_source(spark, table_path(sf_dir, "conversations_missing"))
    return counts_by_source(_pretrain_mix(spark, sf_dir, src), PRETRAIN_ORDER)


@query("mix_single_source",
       f"SELECT source, id, {key_sql()} AS key, text FROM ({chat_cte(True, CHATML_CLI_TOTAL, 'chatml')}) s")
def mix_single_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: first-source-only ChatML set with the whole budget."""
    src = standard_sources(spark, sf_dir)
    mix = mix_sources(spark, src, chatml_budgets(CHATML_CLI_TOTAL, FIRST_RATIO, first_only=True), "chatml")
    return order.with_shuffle_key(mix, SEED).select("source", "id", "key", "text")


@query("prefix_n",
       "SELECT doc_id AS id, text FROM documents WHERE doc_id <= (SELECT max(doc_id) FROM "
       "(SELECT doc_id FROM documents ORDER BY doc_id LIMIT (SELECT count(*) // 2 FROM documents)))")
def prefix_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: first N documents by id, N = half the table (so the cut is exercised at any scale)."""
    docs = spark.read.parquet(table_path(sf_dir, "documents")).select(F.col("doc_id").alias("id"), "text")
    n = docs.count() // 2
    return order.first_n_rows(docs, n)


@query("prefix_n_text_id",
       "SELECT lang || '/' || doc_id AS id, text FROM documents ORDER BY lang || '/' || doc_id LIMIT (SELECT count(*) // 3 FROM documents)")
def prefix_n_text_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 over text ids: a third of the documents by ``lang/doc_id``, by selection of the cutoff."""
    docs = spark.read.parquet(table_path(sf_dir, "documents")).select(F.concat_ws("/", "lang", "doc_id").alias("id"), "text")
    return order.first_n_rows(docs, docs.count() // 3)


@query("prefix_dataset_order",
       "SELECT doc_id, text, row_no FROM (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS row_no FROM documents) t "
       "WHERE row_no < (SELECT count(*) // 2 FROM documents)")
def prefix_dataset_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of a dataset in the order of its files and rows, with no id to go by.

    The dataset is ``documents`` written range-sorted by doc_id over several files; doc_id isn't used by the prefix.
    """
    docs = spark.read.parquet(table_path(sf_dir, "documents")).select("doc_id", "text")
    path = fresh_path(spark, "ordered-dataset")
    docs.repartitionByRange(7, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    return rows_in_order(spark, path, docs.count() // 2).select("doc_id", "text", "row_no")


# ---------------------------------------------------------------- splits

def _chatml_cli(spark, sf_dir):
    """CLI ChatML set: 50,000 samples, 0.7 / 0.3, key, exact 5 % holdout (materialised stage)."""
    src = standard_sources(spark, sf_dir)
    mix = mix_sources(spark, src, chatml_budgets(CHATML_CLI_TOTAL, FIRST_RATIO), "chatml")
    staged = materialize(order.with_shuffle_key(mix, SEED), "chatml_cli")
    split, _, _ = order.holdout_split(staged, VAL_RATIO)
    return split


def _chatml_cli_sql(cols):
    a, b = chatml_budgets(CHATML_CLI_TOTAL, FIRST_RATIO).values()
    inner = f"{chat_cte(True, a, 'chatml')} UNION ALL {chat_cte(False, b, 'chatml')}"
    return holdout_sql(inner, VAL_RATIO, cols=cols)


@query("mix_chatml", _chatml_cli_sql("source, id, key, split, text"))
def mix_chatml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 + L1 + P4 + P7 + L4 + L5: the ChatML finetuning set with source tags and splits."""
    return _chatml_cli(spark, sf_dir).select("source", "id", "key", "split", "text")


_AS_WRITTEN = "row_number() OVER ({part}ORDER BY key, source, id) AS row_no"


@query("split_files_order",
       f"SELECT split, {_AS_WRITTEN.format(part='PARTITION BY split ')}, source, text FROM ({_chatml_cli_sql('*')}) t")
def split_files_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + L4: the written train and valid files, read back in file order."""
    path = fresh_path(spark, "chatml-files")
    split = _chatml_cli(spark, sf_dir)
    write_splits(order.range_ordered(split, lead=("split",)), path, ["text", "source"], 1)
    line = F.from_json("value", "text string, source string")
    return written_order(spark, path, ["split"]).select("split", "row_no", line["source"].alias("source"), line["text"].alias("text"))


@query("mix_files_order",
       f"SELECT {_AS_WRITTEN.format(part='')}, source, text FROM (SELECT *, {key_sql()} AS key FROM ({_pretrain_sql('source, id, text')}) m) k")
def mix_files_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + L4: the written pretraining mix, read back in file order."""
    path = fresh_path(spark, "mix-files")
    mix = materialize(order.with_shuffle_key(mix_sources(spark, standard_sources(spark, sf_dir), pretrain_budgets(), "raw"), SEED), "mix")
    write_jsonl(order.range_ordered(mix), path, ["text", "source"])
    line = F.from_json("value", "text string, source string")
    return written_order(spark, path).select("row_no", line["source"].alias("source"), line["text"].alias("text"))


@query("counts_by_split",
       f"WITH s AS ({_chatml_cli_sql('split')}), names(split) AS (VALUES ('train'), ('valid')) "
       "SELECT names.split, CAST(count(s.split) AS BIGINT) AS n FROM names LEFT JOIN s ON s.split = names.split "
       "GROUP BY names.split")
def counts_by_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: rows in train and valid of the ChatML set."""
    return order.counts_by_split(_chatml_cli(spark, sf_dir))


@query("preview_first",
       f"SELECT substring(text, 1, 500) || '...' AS preview FROM ({_chatml_cli_sql('*')}) t "
       "WHERE split = 'train' ORDER BY key, source, id LIMIT 1")
def preview_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First training row of the ChatML set, 500 characters and '...'."""
    return order.preview(_chatml_cli(spark, sf_dir))


def _split_pipeline_sql():
    a, b = chatml_budgets(CHATML_PIPELINE_TOTAL, FIRST_RATIO).values()
    inner = f"{chat_cte(True, a, 'chatml')} UNION ALL {chat_cte(False, b, 'chatml')}"
    return holdout_sql(inner, VAL_RATIO, cols="source, id, split")


@query("split_holdout", _split_pipeline_sql())
def split_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 (pipeline variant): 100,000-sample ChatML set, exact int(n*0.05) validation rows."""
    src = standard_sources(spark, sf_dir)
    mix = mix_sources(spark, src, chatml_budgets(CHATML_PIPELINE_TOTAL, FIRST_RATIO), "chatml")
    staged = materialize(order.with_shuffle_key(mix, SEED), "chatml_pipeline")
    split, _, _ = order.holdout_split(staged, VAL_RATIO)
    return split.select("source", "id", "split")


@query("textset_split",
       holdout_sql("SELECT 'textset' AS source, item_id AS id, text FROM benchmark WHERE length(text) > 0",
                   VAL_RATIO, at_least_one=True, cols="id, split, text"))
def textset_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 + P8 + S8: text-only set, holdout of at least one row."""
    src = standard_sources(spark, sf_dir)["textset"]
    items = nonempty_text(tolerant_load(spark, src, None))
    keyed = order.with_shuffle_key(items.select(F.lit("textset").alias("source"), "id", "text"), SEED)
    split, _, _ = order.holdout_split(materialize(keyed, "textset"), VAL_RATIO, at_least_one=True)
    return split.select("id", "split", "text")

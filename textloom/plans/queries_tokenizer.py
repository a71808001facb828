"""Registered queries: pre-tokens, counts, alphabet, merges, vocabulary, encode/decode, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions.bytelevel import byte_symbols, pretokens
from textloom.operators.bpe import SPECIALS_CLI, byte_alphabet, pretoken_counts
from textloom.operators.encode import decode, encode, encode_pair
from textloom.operators.windows import context_windows
from textloom.plans.registry import query
from textloom.plans.stages import vocabulary_stage
from textloom.sources.tables import table_path

# Parameters of the registered vocabulary: the jobs' own, over the whole corpus.
QUERY_VOCAB_SIZE, MIN_FREQUENCY = 32_000, 2
CONTEXT_SIZE, CHUNK_OVERLAP = 1024, 0  # fixed values from the model configs

# DuckDB restatement of the pre-token pattern: RE2 has no lookahead, so a \x01 marks the
# last whitespace character before a non-space and the look-ahead branch is dropped.
_DUCK_PRETOKENS = (
    "regexp_extract_all(regexp_replace(text, '(\\s)(\\S)', chr(1) || '\\1\\2', 'g'), "
    "'''s|''t|''re|''ve|''m|''ll|''d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}\\x01]+|\\s+')")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "documents")).select(F.col("doc_id").alias("id"), "text")


def _vocab(spark: SparkSession, sf_dir: str):
    return vocabulary_stage(spark, [table_path(sf_dir, "documents")], lambda: _docs(spark, sf_dir),
                            QUERY_VOCAB_SIZE, MIN_FREQUENCY, SPECIALS_CLI)


@query("pretokens",
       f"SELECT doc_id, pos, token FROM (SELECT doc_id, unnest(toks) AS token, unnest(range(len(toks))) AS pos "
       f"FROM (SELECT doc_id, {_DUCK_PRETOKENS} AS toks FROM documents) d) t")
def pretokens_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level pre-tokens of every document with their positions."""
    docs = spark.read.parquet(table_path(sf_dir, "documents")).select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(pretokens(F.col("text"))).alias("pos", "token")).select(
        "doc_id", F.col("pos").cast("long").alias("pos"), "token")


@query("pretoken_counts",
       f"SELECT token, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest({_DUCK_PRETOKENS}) AS token "
       f"FROM documents) t GROUP BY token")
def pretoken_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct pre-tokens and their counts over the corpus."""
    return pretoken_counts(_docs(spark, sf_dir))


_SPECIAL_VALUES = ", ".join(f"('{t}', {i})" for i, t in enumerate(SPECIALS_CLI))
_BYTE_CHAR_SQL = ("CASE WHEN b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b BETWEEN 174 AND 255 THEN chr(b) "
                  "WHEN b <= 32 THEN chr(256 + b) WHEN b BETWEEN 127 AND 160 THEN chr(256 + b - 94) "
                  "ELSE chr(323) END")


@query("byte_alphabet",
       f"WITH chars AS (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents), "
       f"bytes AS (SELECT DISTINCT CAST(('0x' || substr(h, 2 * i + 1, 2)) AS INTEGER) AS b FROM "
       f"(SELECT hex(encode(ch)) AS h FROM chars) c, range(0, 4) r(i) WHERE 2 * i < length(h)), "
       f"syms AS (SELECT {_BYTE_CHAR_SQL} AS token FROM bytes) "
       f"SELECT token, CAST({len(SPECIALS_CLI)} - 1 + row_number() OVER (ORDER BY unicode(token)) AS INTEGER) AS id, "
       f"'byte' AS kind FROM syms UNION ALL "
       f"SELECT token, CAST(id AS INTEGER), 'special' FROM (VALUES {_SPECIAL_VALUES}) s(token, id)")
def byte_alphabet_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 + T5: special tokens (ids 0..13), then the byte alphabet of the corpus by code point."""
    alphabet = byte_alphabet(pretoken_counts(_docs(spark, sf_dir)))
    rows = [(t, i, "special") for i, t in enumerate(SPECIALS_CLI)]
    rows += [(c, len(SPECIALS_CLI) + i, "byte") for i, c in enumerate(alphabet)]
    return spark.createDataFrame(rows, "token string, id int, kind string")


_PAIRS_SQL = (
    f"WITH toks AS (SELECT token, count(*) AS n FROM (SELECT unnest({_DUCK_PRETOKENS}) AS token FROM documents) t GROUP BY token), "
    f"bytes AS (SELECT n, token, i, CAST(('0x' || substr(hex(encode(token)), 2 * i + 1, 2)) AS INTEGER) AS b "
    f"FROM toks, range(0, 100000) r(i) WHERE i < octet_length(encode(token))), "
    f"syms AS (SELECT n, token, i, {_BYTE_CHAR_SQL} AS s FROM bytes) "
    f"SELECT a.s AS left_symbol, c.s AS right_symbol, CAST(sum(a.n) AS BIGINT) AS n FROM syms a JOIN syms c "
    f"ON a.token = c.token AND c.i = a.i + 1 GROUP BY a.s, c.s")


@query("pair_counts", _PAIRS_SQL)
def pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4, first round: how often each pair of byte symbols is adjacent, over all pre-tokens."""
    syms = pretoken_counts(_docs(spark, sf_dir)).select(byte_symbols(F.col("token")).alias("s"), "n").where(F.size("s") > 1)
    pairs = F.arrays_zip(F.slice("s", 1, F.size("s") - 1).alias("l"), F.slice("s", 2, F.size("s") - 1).alias("r"))
    return (syms.select(F.explode(pairs).alias("p"), "n")
            .groupBy(F.col("p.l").alias("left_symbol"), F.col("p.r").alias("right_symbol")).agg(F.sum("n").alias("n")))


@query("bpe_merges")
def bpe_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: learned merges ``(rank, left, right, new_id)``; checked against the public
    ``tokenizers`` trainer in the tests (not SQL-expressible)."""
    return _vocab(spark, sf_dir).merges_frame(spark)


@query("vocab_table")
def vocab_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the vocabulary ``(token, id, kind)``."""
    return _vocab(spark, sf_dir).vocab_frame(spark)


@query("vocab_size")
def vocab_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tokens in the learned vocabulary."""
    return _vocab(spark, sf_dir).vocab_frame(spark).agg(F.count(F.lit(1)).alias("vocab_size"))


@query("encode_ids")
def encode_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 + T7 + T8: every document encoded as ``<s> ... </s>`` ids."""
    enc = encode(_docs(spark, sf_dir), _vocab(spark, sf_dir))
    return enc.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_ids"), "ids")


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, a, b)``: every turn with the next one of its conversation (a window per conversation, no join)."""
    conv = spark.read.parquet(table_path(sf_dir, "conversations"))
    nxt = F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    return (conv.select(F.concat_ws(":", "conv_id", "turn").alias("id"), F.col("text").alias("a"), nxt.alias("b"))
            .where(F.col("b").isNotNull()))


@query("encode_pair")
def encode_pair_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn paired with the next turn of its conversation, encoded as
    ``<s> A </s> <s> B </s>``."""
    return encode_pair(turn_pairs(spark, sf_dir), _vocab(spark, sf_dir))


@query("decode_roundtrip", "SELECT doc_id, text FROM documents")
def decode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``decode(encode(text)) == text`` for every document (all bytes are in the alphabet)."""
    vocab = _vocab(spark, sf_dir)
    enc = encode(_docs(spark, sf_dir), vocab)
    return enc.select(F.col("id").alias("doc_id"), decode(enc, vocab).alias("text"))


@query("context_windows",
       f"SELECT doc_id, CAST(w AS BIGINT) AS window_no, CAST(len(list_slice(toks, w * {CONTEXT_SIZE} + 1, "
       f"(w + 1) * {CONTEXT_SIZE})) AS BIGINT) AS n_tokens, array_to_string(list_slice(toks, w * {CONTEXT_SIZE} + 1, "
       f"(w + 1) * {CONTEXT_SIZE}), '') AS text FROM (SELECT doc_id, {_DUCK_PRETOKENS} AS toks FROM documents) d, "
       f"range(0, CAST(ceil(len(toks) / {CONTEXT_SIZE}) AS BIGINT)) r(w) WHERE len(toks) > 0")
def context_windows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-token sequences cut into 1,024-token windows (overlap 0)."""
    docs = spark.read.parquet(table_path(sf_dir, "documents")).select("doc_id", "text")
    toks = docs.select("doc_id", pretokens(F.col("text")).alias("toks"))
    wins = context_windows(toks, "toks", CONTEXT_SIZE, CHUNK_OVERLAP, keep=["doc_id"])
    return wins.select("doc_id", F.col("window_no").cast("long").alias("window_no"),
                       F.size("window").cast("long").alias("n_tokens"), F.array_join("window", "").alias("text"))


#: Windows of encoded documents overlap by this much here, so that the overlap is exercised (the configs' own is 0).
ID_OVERLAP = 128


@query("context_windows_ids")
def context_windows_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 on ids: every document's ids, ``<s>`` and ``</s>`` included, cut into windows of 1,024 that overlap by 128."""
    wins = context_windows(encode(_docs(spark, sf_dir), _vocab(spark, sf_dir)), "ids", CONTEXT_SIZE, ID_OVERLAP, keep=["id"])
    return wins.select(F.col("id").alias("doc_id"), F.col("window_no").cast("long").alias("window_no"), F.col("window").alias("ids"))


@query("context_windows_text", "SELECT doc_id, text FROM documents WHERE length(text) > 0")
def context_windows_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 on ids, put back together: each window without its predecessor's share, joined and decoded, is the document."""
    vocab = _vocab(spark, sf_dir)
    wins = context_windows(encode(_docs(spark, sf_dir), vocab, add_special_tokens=False), "ids", CONTEXT_SIZE, ID_OVERLAP, keep=["id"])
    fresh = F.when(F.col("window_no") == 0, F.col("window")).otherwise(F.slice("window", F.lit(ID_OVERLAP + 1), F.lit(CONTEXT_SIZE)))
    parts = F.array_sort(F.collect_list(F.struct("window_no", fresh.alias("ids"))))
    whole = wins.groupBy("id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
    return whole.select(F.col("id").alias("doc_id"), decode(whole, vocab).alias("text"))

"""Registered queries on a vocabulary of 256 tokens, small enough for SQL to learn it as well.

The same code as for the full vocabulary, with one parameter changed. The SQL states the sequential algorithm: a recursion that
in each round takes the most frequent adjacent pair (ties: the smaller left id, then the smaller right id) and replaces it in
every pre-token. A pre-token is a string of ids with a chr(1) before and after each.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.bpe import SPECIALS_CLI, Vocabulary
from textloom.operators.encode import encode, encode_pair
from textloom.operators.windows import context_windows
from textloom.plans.queries_tokenizer import (
    _BYTE_CHAR_SQL,
    _DUCK_PRETOKENS,
    CONTEXT_SIZE,
    ID_OVERLAP,
    MIN_FREQUENCY,
    _docs,
    turn_pairs,
)
from textloom.plans.registry import query
from textloom.plans.stages import vocabulary_stage
from textloom.session import fresh_path
from textloom.sources.tables import table_path

SMALL_VOCAB_SIZE = 256


def _vocab(spark: SparkSession, sf_dir: str) -> Vocabulary:
    return vocabulary_stage(spark, [table_path(sf_dir, "documents")], lambda: _docs(spark, sf_dir),
                            SMALL_VOCAB_SIZE, MIN_FREQUENCY, SPECIALS_CLI)


def _byte_symbols_sql(relation: str) -> str:
    """Rows (token, i, s): symbol of each byte of the tokens of a relation; an empty token has none."""
    return (f"SELECT token, i, {_BYTE_CHAR_SQL} AS s FROM (SELECT token, i, "
            "CAST(('0x' || substr(hex(encode(token)), 2 * i + 1, 2)) AS INTEGER) AS b FROM "
            f"(SELECT token, unnest(range(octet_length(encode(token)))) AS i FROM {relation}) u) y")


_SPECIALS_SQL = "[" + ", ".join(f"'{t}'" for t in SPECIALS_CLI) + "]"
_PAIR_SQL = "chr(1) || b.l || chr(1) || chr(1) || b.r || chr(1)"

#: ``alphabet (s, id)`` and ``learn``: a row per round with the tokens so far and the round's merge, and the words of each round.
_LEARN_SQL = f"""WITH RECURSIVE
words AS (SELECT token, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest({_DUCK_PRETOKENS}) AS token FROM documents) t GROUP BY token),
syms AS ({_byte_symbols_sql("words")}),
alphabet AS (SELECT s, {len(SPECIALS_CLI)} - 1 + row_number() OVER (ORDER BY unicode(s)) AS id FROM (SELECT DISTINCT s FROM syms) a),
learn AS (
SELECT 0 AS round, any_value(n) AS n, string_agg(chr(1) || id || chr(1), '' ORDER BY i) AS w, CAST(NULL AS VARCHAR[]) AS toks,
  CAST(NULL AS BIGINT) AS l, CAST(NULL AS BIGINT) AS r, CAST(NULL AS BIGINT) AS made
FROM syms JOIN alphabet USING (s) JOIN words USING (token) GROUP BY token HAVING count(*) > 1
UNION ALL SELECT 0, NULL, NULL, {_SPECIALS_SQL} || (SELECT list(s ORDER BY id) FROM alphabet), NULL, NULL, NULL
UNION ALL
(WITH p AS (SELECT ids[j] AS l, ids[j + 1] AS r, sum(n) AS c FROM (
    SELECT ids, n, unnest(range(1, len(ids))) AS j FROM (
      SELECT string_split(trim(w, chr(1)), chr(1) || chr(1)) AS ids, n FROM learn WHERE toks IS NULL) s) q
    GROUP BY 1, 2 HAVING sum(n) >= {MIN_FREQUENCY} ORDER BY c DESC, CAST(l AS BIGINT), CAST(r AS BIGINT) LIMIT 1),
 b AS (SELECT CAST(p.l AS BIGINT) AS l, CAST(p.r AS BIGINT) AS r, h.toks[CAST(p.l AS BIGINT) + 1] || h.toks[CAST(p.r AS BIGINT) + 1] AS tok,
    coalesce(list_position(h.toks, tok) - 1, len(h.toks)) AS made
    FROM p, (SELECT toks FROM learn WHERE toks IS NOT NULL) h WHERE len(h.toks) < {SMALL_VOCAB_SIZE}),
 x AS (SELECT x.round + 1 AS round, x.n, replace(x.w, {_PAIR_SQL}, chr(1) || b.made || chr(1)) AS w,
    CASE WHEN x.toks IS NOT NULL AND b.made = len(x.toks) THEN list_append(x.toks, b.tok) ELSE x.toks END AS toks,
    CASE WHEN x.toks IS NOT NULL THEN b.l END AS l, CASE WHEN x.toks IS NOT NULL THEN b.r END AS r,
    CASE WHEN x.toks IS NOT NULL THEN b.made END AS made FROM learn x, b)
 SELECT round, CAST(sum(n) AS BIGINT), w, toks, l, r, made FROM x WHERE toks IS NOT NULL OR contains(w, chr(1) || chr(1)) GROUP BY ALL)),
final AS (SELECT toks FROM learn WHERE toks IS NOT NULL ORDER BY round DESC LIMIT 1)
"""

_VOCAB_SQL = _LEARN_SQL + f"""SELECT token, CAST(i - 1 AS INTEGER) AS id,
CASE WHEN i <= {len(SPECIALS_CLI)} THEN 'special' WHEN i <= {len(SPECIALS_CLI)} + (SELECT count(*) FROM alphabet) THEN 'byte' ELSE 'merge' END AS kind
FROM (SELECT unnest(toks) AS token, unnest(range(1, len(toks) + 1)) AS i FROM final) v"""

_SPECIAL_RE = "|".join(re.escape(t).replace("'", "''") for t in sorted(SPECIALS_CLI, key=len, reverse=True))


def _encoded_sql(source: str) -> str:
    """Relations down to ``coded (id, ids)``: the ids, without <s> and </s>, of a source's (id, text).

    Special tokens are cut out first; each other pre-token starts as its bytes' ids (unknown: 0) and takes the merges by rank.
    """
    return _LEARN_SQL + f""", src AS ({source}),
cut AS (SELECT id, string_split_regex(coalesce(text, ''), '{_SPECIAL_RE}') AS parts, regexp_extract_all(coalesce(text, ''), '{_SPECIAL_RE}') AS specials FROM src),
runs AS (SELECT id, k, parts[k] AS text, specials[k] AS special FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS k FROM cut) c),
pieces AS (SELECT id, k, {_DUCK_PRETOKENS} || CASE WHEN special IS NULL THEN CAST([] AS VARCHAR[]) ELSE [special] END AS toks FROM runs),
tokens AS (SELECT id, k, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM pieces),
steps AS (SELECT coalesce(list(chr(1) || l || chr(1) || chr(1) || r || chr(1) || chr(2) || chr(1) || made || chr(1) ORDER BY round), []) AS m
  FROM learn WHERE made IS NOT NULL),
known AS (SELECT DISTINCT token FROM tokens),
spelled AS (SELECT token, string_agg(chr(1) || coalesce(a.id, 0) || chr(1), '' ORDER BY i) AS w
  FROM ({_byte_symbols_sql("known")}) z LEFT JOIN alphabet a USING (s) GROUP BY token),
ids AS (SELECT token, CASE WHEN list_contains({_SPECIALS_SQL}, token) THEN [list_position({_SPECIALS_SQL}, token) - 1]
  ELSE CAST(string_split(trim(list_reduce(m, lambda w, x: replace(w, split_part(x, chr(2), 1), split_part(x, chr(2), 2)), w), chr(1)), chr(1) || chr(1)) AS INTEGER[])
  END AS one FROM spelled, steps),
coded AS (SELECT src.id, coalesce(e.ids, CAST([] AS INTEGER[])) AS ids FROM src LEFT JOIN
  (SELECT id, flatten(list(one ORDER BY k, pos)) AS ids FROM tokens JOIN ids USING (token) GROUP BY id) e ON src.id IS NOT DISTINCT FROM e.id)
"""


_DOCS_SQL = "SELECT doc_id AS id, text FROM documents"


@query("bpe_merges_256", _LEARN_SQL + "SELECT CAST(m.round - 1 AS INTEGER) AS rank, toks[l + 1] AS \"left\", toks[r + 1] AS \"right\", "
       "CAST(made AS INTEGER) AS new_id FROM learn m WHERE made IS NOT NULL")
def bpe_merges_256(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: merges of a vocabulary of 256 tokens over the whole corpus ``(rank, left, right, new_id)``."""
    return _vocab(spark, sf_dir).merges_frame(spark)


@query("vocab_table_256", _VOCAB_SQL)
def vocab_table_256(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, K4: the vocabulary ``(token, id, kind)``, written as ``tokenizer.json`` and read back from it."""
    path = fresh_path(spark, "tokenizer_json")
    content, _ = _vocab(spark, sf_dir).tokenizer_json()
    spark.createDataFrame([(content,)], "value string").coalesce(1).write.text(path)
    saved = spark.read.text(path, wholetext=True).first()["value"]
    return Vocabulary.from_tokenizer_json(saved).vocab_frame(spark)


@query("vocab_size_256", _LEARN_SQL + "SELECT CAST(len(toks) AS BIGINT) AS vocab_size FROM final")
def vocab_size_256(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tokens learned: 256, or fewer where no pair occurs twice any more."""
    return _vocab(spark, sf_dir).vocab_frame(spark).agg(F.count(F.lit(1)).alias("vocab_size"))


@query("encode_ids_256", _encoded_sql(_DOCS_SQL) + "SELECT id AS doc_id, CAST(len(ids) + 2 AS BIGINT) AS n_ids, "
       "list_concat([1], ids, [2]) AS ids FROM coded")
def encode_ids_256(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 + T7 + T8: every document encoded as ``<s> ... </s>`` ids of the vocabulary of 256 tokens."""
    enc = encode(_docs(spark, sf_dir), _vocab(spark, sf_dir))
    return enc.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_ids"), "ids")


@query("encode_pair_256", _encoded_sql("SELECT conv_id || ':' || turn AS id, text FROM conversations")
       + ", turns AS (SELECT conv_id || ':' || turn AS id, lead(conv_id || ':' || turn) OVER w AS next_id, lead(text) OVER w AS b "
       "FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) "
       "SELECT t.id, list_concat([1], x.ids, [2, 1], y.ids, [2]) AS ids FROM turns t JOIN coded x ON x.id = t.id "
       "JOIN coded y ON y.id = t.next_id WHERE t.b IS NOT NULL")
def encode_pair_256(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn and the next of its conversation as ``<s> A </s> <s> B </s>``."""
    return encode_pair(turn_pairs(spark, sf_dir), _vocab(spark, sf_dir))


_STEP = CONTEXT_SIZE - ID_OVERLAP


@query("context_windows_ids_256", _encoded_sql(_DOCS_SQL)
       + f", full_ids AS (SELECT id, list_concat([1], ids, [2]) AS ids FROM coded) "
       f"SELECT id AS doc_id, CAST(k AS BIGINT) AS window_no, ids[k * {_STEP} + 1 : k * {_STEP} + {CONTEXT_SIZE}] AS ids FROM "
       f"(SELECT id, ids, unnest(range(greatest(1, CAST(ceil((len(ids) - {ID_OVERLAP}) / {_STEP}) AS BIGINT)))) AS k FROM full_ids) f")
def context_windows_ids_256(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, ``<s>`` and ``</s>`` included, cut into windows of 1,024 that overlap by 128."""
    wins = context_windows(encode(_docs(spark, sf_dir), _vocab(spark, sf_dir)), "ids", CONTEXT_SIZE, ID_OVERLAP, keep=["id"])
    return wins.select(F.col("id").alias("doc_id"), F.col("window_no").cast("long").alias("window_no"), F.col("window").alias("ids"))

"""Stage reuse (J2): outputs written to the shared scratch space and found again by key, and stage manifests.

``materialize`` (in ``textloom.session``) writes a DataFrame as a Parquet stage and
reads it back; ``vocabulary_stage`` keeps a learned vocabulary so that the queries
that encode or decode with it do not learn it again.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from textloom.functions import bytelevel
from textloom.functions import chat as functions_chat
from textloom.functions import json as functions_json
from textloom.operators import bpe, chat, merges, mix, order
from textloom.operators.bpe import Vocabulary, train_bpe
from textloom.session import materialize, scratch_dir  # noqa: F401  (materialize is re-exported)
from textloom.sources import jsonl, jsonscan, rowprefix, sinks, tables


def input_state(spark, paths: list[str]) -> str:
    """Names, sizes and times of the files under ``paths``: changes when the data does."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    rows = files.select("path", "length", "modificationTime").groupBy().agg(
        F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    return "/".join(map(str, rows))


def code_state() -> str:
    """A digest of the code that stages are made by."""
    text = "".join(inspect.getsource(m) for m in (bpe, merges, chat, mix, order, functions_chat, functions_json, bytelevel, jsonl, jsonscan, rowprefix, sinks, tables))
    return hashlib.sha1(text.encode()).hexdigest()


def manifest(spark, inputs: list[str], parameters: dict) -> dict:
    """What a stage's output depends on: the state of its inputs, its parameters and the code."""
    return {"inputs": input_state(spark, inputs), "parameters": parameters, "code": code_state()}


def write_manifest(spark, path: str, made_from: dict, counts: dict[str, int]) -> None:
    """Written after the stage itself, so a stage without one wasn't finished."""
    row = json.dumps(made_from | {"counts": counts}, sort_keys=True)
    spark.createDataFrame([(row,)], "value string").coalesce(1).write.text(path)


def read_manifest(spark, path: str) -> dict | None:
    try:
        rows = spark.read.text(path).collect()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return json.loads(rows[0]["value"]) if len(rows) == 1 else None


def check_manifest(found: dict | None, made_from: dict, stage: str) -> dict:
    """The manifest of a finished stage that was made from the same inputs, parameters and code; else an error."""
    if found is None:
        raise FileNotFoundError(f"stage {stage} was never finished; it can't be skipped")
    changed = [k for k, v in made_from.items() if found.get(k) != v]
    if changed:
        raise ValueError(f"stage {stage} was made from other {' and '.join(changed)}; it can't be skipped")
    return found


def vocabulary_stage(spark, paths: list[str], texts_fn, vocab_size: int, min_frequency: int, specials: list[str],
                     skip_if_exists: bool = True) -> Vocabulary:
    """The vocabulary learned from ``texts_fn()`` over the files at ``paths``, reused while they stay as they are.

    The stage key covers the files' state, the parameters and the code. A vocabulary has a folder of its own, which its
    manifest, written last, names; so a run that broke off leaves nothing that is read or in the way.
    """
    made_from = manifest(spark, paths, {"vocab_size": vocab_size, "min_frequency": min_frequency, "specials": specials})
    key = hashlib.sha1(json.dumps(made_from, sort_keys=True).encode()).hexdigest()[:16]
    base = f"{scratch_dir(spark).rstrip('/')}/vocab-stages/{key}"
    done = read_manifest(spark, f"{base}/manifest") if skip_if_exists else None
    if done is not None:
        return Vocabulary.load(spark, f"{base}/{done['folder']}")
    vocab = train_bpe(texts_fn(), vocab_size, min_frequency, specials)
    folder = uuid.uuid4().hex
    vocab.save(spark, f"{base}/{folder}")
    if skip_if_exists:
        write_manifest(spark, f"{base}/manifest", made_from | {"folder": folder}, {"vocab_size": vocab.size})
    return vocab

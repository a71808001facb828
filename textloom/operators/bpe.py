"""Vocabulary learning: pre-token counts (T2), alphabet (T3), special tokens (T5) and the vocabulary tables (K3, K4,
A7). The merges (T4) are learned in ``textloom.operators.merges``.

The driver keeps only the merge list and token strings, bounded by ``vocab_size``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.bytelevel import byte_chars, char_bytes, pretokens
from textloom.operators.merges import learn_merges
from textloom.session import materialize, remove_stage

# Special tokens, in id order, of the two variants.
SPECIALS_CLI = ["<unk>", "<s>", "</s>", "<pad>", "<|im_start|>", "<|im_end|>", "<knowledge>", "</knowledge>",
                "<k_res>", "<k_end>", "<code>", "</code>", "<output>", "</output>"]
SPECIALS_PIPELINE = ["<unk>", "<s>", "</s>", "<pad>", "<|im_start|>", "<|im_end|>", "<knowledge>", "</knowledge>",
                     "<k_res>", "<k_end>"]
UNK, BOS, EOS, PAD = "<unk>", "<s>", "</s>", "<pad>"


def pretoken_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``(token, n)`` over all texts (raw, unmapped pre-tokens)."""
    toks = texts.select(F.explode(pretokens(F.col(text_col))).alias("token"))
    return toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all strings, where each begins and the last end)."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int32)
    column = column.cast(pa.string())
    at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def byte_alphabet(counts: DataFrame) -> list[str]:
    """Mapped byte characters seen in the corpus, by code point (at most 256)."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = np.zeros(256, bool)
        for b in batches:
            hit[_bytes(b.column("token"))[0]] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(hit).astype(np.int32))], ["b"])

    chars = byte_chars()
    found = counts.select("token").mapInArrow(seen, "b int").distinct()
    return sorted((chars[r["b"]] for r in found.collect()), key=ord)


def spelled(counts: DataFrame, alphabet: list[str], first: int) -> DataFrame:
    """``(ids ARRAY<INT>, n)``: pre-tokens of two bytes and more as ids, the alphabet's numbered from ``first``."""
    back = char_bytes()
    ids = np.zeros(256, np.int32)
    for i, c in enumerate(alphabet):
        ids[back[c]] = first + i

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = _bytes(b.column("token"))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(at), pa.array(ids[data])), b.column("n")], ["ids", "n"])

    return counts.where(F.octet_length("token") > 1).select("token", "n").mapInArrow(spell, "ids array<int>, n long")


@dataclass
class Vocabulary:
    tokens: list[str]                       # id -> token string
    kinds: list[str]                        # special / byte / merge
    merges: list[tuple[int, int, int]] = field(default_factory=list)  # (left id, right id, new id), by rank
    specials: list[str] = field(default_factory=list)

    @property
    def size(self) -> int:
        return len(self.tokens)

    def token_ids(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.tokens)}

    def vocab_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(t, i, k) for i, (t, k) in enumerate(zip(self.tokens, self.kinds))],
                                     "token string, id int, kind string")

    def merges_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(r, self.tokens[a], self.tokens[b], n) for r, (a, b, n) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string, new_id int")

    def save(self, spark: SparkSession, path: str) -> None:
        """K3: vocabulary and merges as Parquet tables under ``path``."""
        self.vocab_frame(spark).write.parquet(f"{path}/vocab")
        self.merges_frame(spark).write.parquet(f"{path}/merges")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Vocabulary":
        vocab = sorted(spark.read.parquet(f"{path}/vocab").collect(), key=lambda r: r["id"])
        tokens = [r["token"] for r in vocab]
        ids = {t: i for i, t in enumerate(tokens)}
        merges = sorted(spark.read.parquet(f"{path}/merges").collect(), key=lambda r: r["rank"])
        return cls(tokens, [r["kind"] for r in vocab],
                   [(ids[m["left"]], ids[m["right"]], m["new_id"]) for m in merges],
                   [r["token"] for r in vocab if r["kind"] == "special"])

    @classmethod
    def from_tokenizer_json(cls, text: str) -> "Vocabulary":
        """The vocabulary of a byte-level BPE ``tokenizer.json``, whoever wrote it (K3).

        Ids must run from 0 without gaps, as token strings are kept by id.
        """
        doc = json.loads(text)
        model, added = doc["model"], sorted(doc.get("added_tokens") or [], key=lambda t: t["id"])
        if model.get("type", "BPE") != "BPE" or (doc.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("not a byte-level BPE tokenizer")
        ids = dict(model["vocab"]) | {t["content"]: t["id"] for t in added}
        if sorted(ids.values()) != list(range(len(ids))):
            raise ValueError("token ids don't run from 0 without gaps")
        tokens = sorted(ids, key=ids.__getitem__)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        made, special = {n for _, _, n in merges}, {t["content"] for t in added if t.get("special", True)}
        kinds = ["special" if t in special else "merge" if i in made else "byte" for i, t in enumerate(tokens)]
        return cls(tokens, kinds, merges, [t["content"] for t in added if t["content"] in special])

    def tokenizer_json(self, max_length: int = 1024, chat_template: str | None = None) -> tuple[str, str]:
        """K4: (tokenizer.json, tokenizer_config.json) in the public ``tokenizers`` file format."""
        added = [{"id": i, "content": t, "single_word": False, "lstrip": False, "rstrip": False,
                  "normalized": False, "special": True} for i, t in enumerate(self.specials)]
        ids = self.token_ids()
        doc = {
            "version": "1.0", "truncation": None, "padding": None, "added_tokens": added, "normalizer": None,
            "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                              "use_regex": True},
            "post_processor": {
                "type": "TemplateProcessing",
                "single": [{"SpecialToken": {"id": BOS, "type_id": 0}}, {"Sequence": {"id": "A", "type_id": 0}},
                           {"SpecialToken": {"id": EOS, "type_id": 0}}],
                "pair": [{"SpecialToken": {"id": BOS, "type_id": 0}}, {"Sequence": {"id": "A", "type_id": 0}},
                         {"SpecialToken": {"id": EOS, "type_id": 0}}, {"SpecialToken": {"id": BOS, "type_id": 0}},
                         {"Sequence": {"id": "B", "type_id": 0}}, {"SpecialToken": {"id": EOS, "type_id": 0}}],
                "special_tokens": {t: {"id": t, "ids": [ids[t]], "tokens": [t]} for t in (BOS, EOS)},
            },
            "decoder": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True},
            "model": {"type": "BPE", "dropout": None, "unk_token": UNK, "continuing_subword_prefix": None,
                      "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False,
                      "ignore_merges": False, "vocab": ids,
                      "merges": [[self.tokens[a], self.tokens[b]] for a, b, _ in self.merges]},
        }
        config = {"tokenizer_class": "PreTrainedTokenizerFast", "bos_token": BOS, "eos_token": EOS,
                  "unk_token": UNK, "pad_token": PAD}
        if chat_template is not None:
            config["chat_template"] = chat_template
        config["model_max_length"] = max_length
        return json.dumps(doc, ensure_ascii=False), json.dumps(config, indent=2)


def initial_vocabulary(alphabet: list[str], specials: list[str]) -> Vocabulary:
    """T5 + T3: specials take ids 0.., then the alphabet by code point."""
    tokens = list(specials)
    kinds = ["special"] * len(specials)
    for c in alphabet:
        if c not in tokens:
            tokens.append(c)
            kinds.append("byte")
    return Vocabulary(tokens, kinds, [], list(specials))


def train_bpe(texts: DataFrame, vocab_size: int = 32_000, min_frequency: int = 2,
              specials: list[str] | None = None, text_col: str = "text", **kw) -> Vocabulary:
    """Learn a byte-level BPE vocabulary from a frame of texts."""
    specials = SPECIALS_CLI if specials is None else specials
    # The distinct pre-tokens are written once and read for the alphabet and for the ids.
    counts = materialize(pretoken_counts(texts, text_col), "bpe-pretokens")
    alphabet = byte_alphabet(counts)
    vocab = initial_vocabulary(alphabet, specials)
    vocab = learn_merges(spelled(counts, alphabet, len(specials)), vocab, vocab_size, min_frequency, **kw)
    remove_stage(counts)
    return vocab

"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary text, and one on the places of toxic text that
set it apart, put before a copy of the first. Every window of a text is compressed with both; what the
toxic dictionary saves, in bytes, is the window's gain. A window of ordinary text gains nothing, as both
dictionaries hold the same ordinary part; a window with toxic words does.

A document's score compares the gains of all its windows under two hypotheses: the ordinary distribution
of gains, and mixtures of it with the toxic one at several densities (so that a long text isn't cleared by
its clean windows). The log ratio is calibrated to a probability by logistic regression. Dictionaries come
from one part of the labelled sample and distributions and calibration from the other, so that no window
is judged by a dictionary that holds it.

The labelled sample is bounded: ``max_toxic`` and ``max_ordinary`` documents, lowest key hash first, of at
most ``max_bytes`` bytes each; its size doesn't follow the input's. The calibration's bias is shifted from the
sample's odds of toxic to ordinary documents to those of all usable labels, so that a score doesn't depend on the
bounds. Scoring covers every window of every text.

Defined results: null and empty texts have no window and get the score of no evidence; without a toxic or
without an ordinary label every score is 0 or 1 as all labels are, and 0 without any; repeated rows are scored each; a label
row without its document is ignored; a document labelled both ways counts as toxic.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from textloom.llm.staging import only
from textloom.llm.word_ids import give_back

#: Bounds of the labelled sample.
MAX_TOXIC = 1500
MAX_ORDINARY = 3000
MAX_BYTES = 50_000
#: Bytes of a window; it ends at white space. Longer runs are cut at four windows.
WINDOW = 40
#: Bytes of the dictionaries' parts.
ORDINARY_BYTES = 12_000
TOXIC_BYTES = 2_000
#: A toxic word holds a piece of this many bytes that toxic documents have this many times as often.
PIECE = 5
ODDS = 20.0
#: Bytes of ordinary text compressed ahead of each window, so that a block is never stored raw.
LEAD = 48
#: Gains are counted from -1 to this.
MOST = 8
DENSITIES = (0.02, 0.05, 0.1, 0.2, 0.4)


def windows(text: bytes, width: int = WINDOW) -> list[bytes]:
    """All of ``text`` in windows of about ``width`` bytes that end before white space."""
    if not text:
        return []
    a = np.frombuffer(text, np.uint8)
    white = np.flatnonzero((a == 32) | ((a >= 9) & (a <= 13)))
    aim = np.arange(width, len(a), width)
    if len(white):
        at = np.searchsorted(white, aim)
        end = np.where(at < len(white), white[np.minimum(at, len(white) - 1)], len(a))
    else:
        end = np.full(len(aim), len(a))
    end = np.unique(np.append(np.minimum(end, aim + 3 * width), len(a))).tolist()
    return [text[i:j] for i, j in zip([0, *end[:-1]], end, strict=True)]


def _pieces(word: bytes) -> set[bytes]:
    return {word[i:i + PIECE] for i in range(len(word) - PIECE + 1)}


def _words(text: bytes) -> list[bytes]:
    return [b" " + w + b" " for w in text.split()]


def _marked_words(toxic: list[bytes], ordinary: list[bytes]) -> set[bytes]:
    """Words that set toxic documents apart."""
    def document_counts(texts: list[bytes]) -> Counter:
        counts: Counter = Counter()
        for t in texts:
            counts.update({p for w in set(_words(t)) for p in _pieces(w)})
        return counts

    in_toxic, in_ordinary = document_counts(toxic), document_counts(ordinary)
    least = max(2.0, 0.01 * len(toxic))
    marks = {p for p, c in in_toxic.items()
             if c >= least and c / len(toxic) > ODDS * (in_ordinary[p] + 0.5) / max(len(ordinary), 1)}
    uses: Counter = Counter()
    before: dict[bytes, set[bytes]] = defaultdict(set)
    for t in toxic:
        last, seen = b"", set()
        for w in _words(t):
            if w not in seen and not marks.isdisjoint(_pieces(w)):
                seen.add(w)
                uses[w] += 1
                before[w].add(last)  # near copies repeat a word after the same one
            last = w
    varied = max(2, 0.004 * len(toxic))
    plain = Counter(w for t in ordinary for w in set(_words(t)) if w in uses)
    return {w for w, c in uses.items() if len(before[w]) >= varied and c / len(toxic) > ODDS * plain[w] / max(len(ordinary), 1)}


def _toxic_samples(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """What the toxic dictionary is trained on: each place of a marked word in the toxic texts, with the next such place.

    Whole windows won't do: most of a toxic text is ordinary, and the trainer picks what is frequent in its samples.
    """
    marked = _marked_words(toxic, ordinary)
    places = [w for t in toxic for w in _words(t) if w in marked]
    return [a + b for a, b in zip(places, places[1:])] or places


def _train(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; the samples' own bytes if there are too few to train on."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _compressor(dictionary: bytes):
    params = zstandard.ZstdCompressionParameters(
        window_log=17, chain_log=14, hash_log=14, search_log=5, min_match=5, target_length=16,
        strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_dict_id=False, write_checksum=False)
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=params).compress


@dataclass
class ToxicityModel:
    """Both dictionaries and the calibrated thresholds; a few tens of KB."""

    ordinary: bytes
    toxic: bytes
    constant: float | None = None
    bins: np.ndarray = field(default_factory=lambda: np.zeros((len(DENSITIES), MOST + 2)))
    slope: float = 1.0
    bias: float = 0.0

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_both"}

    def gains(self, text: bytes) -> np.ndarray:
        """How often each gain from -1 to ``MOST`` occurs among the windows."""
        both = self.__dict__.get("_both")
        if both is None:
            both = self.__dict__["_both"] = (_compressor(self.ordinary), _compressor(self.toxic), self.ordinary[-LEAD:])
        plain, marked, lead = both
        found = [len(plain(w)) - len(marked(w)) for w in (lead + x for x in windows(text))]
        return np.bincount(np.clip(np.array(found, np.int64), -1, MOST) + 1, minlength=MOST + 2)

    def evidence(self, gains: np.ndarray) -> float:
        """Log ratio of the toxic hypothesis (mean over densities) to the ordinary one."""
        logs = self.bins @ gains
        top = float(logs.max())
        return top + math.log(float(np.exp(logs - top).mean()))

    def score(self, text: bytes) -> float:
        if self.constant is not None:
            return self.constant
        x = self.slope * self.evidence(self.gains(text)) + self.bias
        return 1.0 / (1.0 + math.exp(-min(max(x, -40.0), 40.0)))


def train(toxic: list[bytes], ordinary: list[bytes], counts: tuple[int, int] | None = None) -> ToxicityModel:
    """Fit on labelled texts (held in memory; see the bounds above), a sample of ``counts`` toxic and ordinary ones."""
    if not toxic or not ordinary:
        return ToxicityModel(b"", b"", constant=1.0 if toxic else 0.0)
    # Two of three documents give the dictionaries, the third the calibration.
    part = lambda texts, rest: [t for i, t in enumerate(texts) if (i % 3 == 2) == rest]
    tox, plain = part(toxic, False) or toxic, part(ordinary, False) or ordinary
    base = _train([w for t in plain for w in windows(t, 64)], ORDINARY_BYTES)
    model = ToxicityModel(base, _train(_toxic_samples(tox, plain), TOXIC_BYTES) + base)
    tox, plain = part(toxic, True) or toxic, part(ordinary, True) or ordinary
    g_tox, g_plain = (np.array([model.gains(t) for t in texts], float) for texts in (tox, plain))
    share = lambda g: (g / np.maximum(g.sum(1, keepdims=True), 1)).mean(0)
    ordinary_p = (share(g_plain) + 1e-5) / (1 + 1e-5 * (MOST + 2))
    extra = np.maximum(share(g_tox) - ordinary_p, 0.0)
    extra[:2] = 0.0  # a toxic window gains
    toxic_p = (extra + 1e-6) / (extra + 1e-6).sum()
    model.bins = np.log1p([d * (toxic_p / ordinary_p - 1.0) for d in DENSITIES])
    x = np.array([model.evidence(g) for g in (*g_tox, *g_plain)])
    y = np.concatenate([np.ones(len(g_tox)), np.zeros(len(g_plain))])
    model.slope, model.bias = _logistic(x, y)
    n_toxic, n_plain = counts or (len(toxic), len(ordinary))
    model.bias += math.log(n_toxic / n_plain) - math.log(len(g_tox) / len(g_plain))
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias by Newton's method, slightly regularised."""
    mean, spread = float(x.mean()), max(float(x.std()), 1e-9)
    a = np.stack([(x - mean) / spread, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + 1e-2 * np.eye(2), a.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(w[0], 0.0) / spread), float(w[1] - max(w[0], 0.0) * mean / spread)


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learnt from; a null id is one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(documents: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY,
        max_bytes: int = MAX_BYTES) -> ToxicityModel:
    """Train on the bounded labelled sample."""
    marks = only(labels, "doc_id", "toxic").where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Choose by key first; only the chosen documents' texts are shuffled and sent.
    usable = only(documents, "doc_id", "text").where(~held_out(F.col("doc_id")) & F.octet_length("text").between(1, max_bytes))
    keys = marks.where(~held_out(F.col("doc_id"))).join(usable.select("doc_id"), "doc_id", "left_semi")
    counts = dict(keys.groupBy("toxic").count().collect())
    parts = {}
    for mark, most in ((1, max_toxic), (0, max_ordinary)):
        chosen = keys.where(F.col("toxic") == mark).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        ids = [r[0] for r in chosen.select("doc_id").collect()]
        # One text an id, the greatest: what is collected is bounded by the sample's own bounds.
        rows = usable.where(F.col("doc_id").isin(ids)).groupBy("doc_id").agg(F.max("text").alias("text")).collect() if ids else []
        texts = {r["doc_id"]: r["text"] for r in rows}
        parts[mark] = [texts[i].encode() for i in ids]
    return train(parts[1], parts[0], (counts.get(1, 0), counts.get(0, 0)))


def score_column(model: ToxicityModel, text: Column) -> Column:
    """Score of a text column; a map, no shuffle."""

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = pa.array([model.score(t.as_py().encode() if t.is_valid else b"") for t in texts], pa.float64())
        give_back()
        return out

    return score(text)


def score_documents(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = only(documents, "doc_id", "text").withColumn("score", score_column(model, F.col("text")))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))

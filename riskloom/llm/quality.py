"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader steps.

Features are n-grams of words (one and two) and of word shapes (one to three), where a shape keeps punctuation and reduces runs of
letters and digits; each n-gram is hashed into a fixed number of weights. A text's score is the sparse dot product of its n-gram
shares with the weights. Training runs on a bounded sample of labelled rows, split over shards whose weights are averaged.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.texts import MIX_A, MIX_B, Shipped, drawn, map_documents, worker_cache

BITS = 18
ALPHA, BETA, L1, L2, EPOCHS = 0.3, 1.0, 1e-4, 1e-3, 4
MEMO = 200_000

_RUN = re.compile(r"[^\W_]+")


def _kind(run: re.Match) -> str:
    s = run[0]
    return "0" if s.isdigit() else "A" if len(s) > 1 and s.isupper() else "a"


def shape(word: str) -> str:
    """The word with each run of letters and digits reduced to one sign: its punctuation and the case of its letters stay."""
    return _kind(_RUN.match(word)) if word.isalnum() else _RUN.sub(_kind, word)


class _Words(dict):
    """Word -> hash of the lower-case word and hash of its shape, as 16 bytes."""

    def __missing__(self, word: str) -> bytes:
        if len(self) > MEMO:
            self.clear()
        self[word] = pair = struct.pack("<QQ", xxhash.xxh64_intdigest(word.lower()), xxhash.xxh64_intdigest(shape(word), seed=1))
        return pair


def words_of() -> _Words:
    return worker_cache("words", "quality", _Words)


def _slot(h: np.ndarray) -> np.ndarray:
    return (h * MIX_A >> np.uint64(64 - BITS)).astype(np.int64)


def ngram_slots(text: str | None) -> np.ndarray:
    """Hashed n-grams of the whole text, repeats included; empty for a text without words."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int64)
    known = words_of()
    pairs = np.frombuffer(b"".join(map(known.__getitem__, words)), "<u8")
    w, s = pairs[::2], pairs[1::2]
    same = (w[1:] == w[:-1]).astype(np.uint64)
    two = s[:-1] * MIX_B + s[1:]
    grams = [w, w[:-1] * MIX_B + w[1:] * np.uint64(3), s, two, two[:-1] * MIX_B + s[2:], same + np.uint64(11)]
    return _slot(np.concatenate(grams))


class Leader:
    """State of follow-the-regularised-leader (proximal) with one learning rate for each weight."""

    def __init__(self):
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.bias_z = self.bias_n = 0.0

    @staticmethod
    def _weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def step(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        z, n = self.z[at], self.n[at]
        w, bias = self._weights(z, n), float(self._weights(self.bias_z, self.bias_n))
        error = 1 / (1 + np.exp(-np.clip(float(w @ x) + bias, -35, 35))) - label
        g = error * x
        self.z[at] = z + g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g
        grown = self.bias_n + error * error
        self.bias_z += error - (np.sqrt(grown) - np.sqrt(self.bias_n)) / ALPHA * bias
        self.bias_n = grown

    def weights(self) -> tuple[np.ndarray, float]:
        return self._weights(self.z, self.n), float(self._weights(self.bias_z, self.bias_n))


#: Shares of n-grams are tiny for long texts; this puts them where the learning rates work.
GAIN = 20.0


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    slots = ngram_slots(text)
    at, counts = np.unique(slots, return_counts=True)
    return at, counts * (GAIN / max(1, len(slots)))


class QualityModel:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), bias

    def score(self, text: str | None) -> float:
        slots = ngram_slots(text)
        margin = self.bias + (GAIN * float(self.weights[slots].sum(dtype=np.float64)) / len(slots) if len(slots) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(margin, -35, 35))))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                bound: int = 12_000, shards: int = 6) -> QualityModel:
    """Train on about ``bound`` labelled rows (all, if there are fewer), drawn by a hash of the id, in ``shards`` tasks.

    A document with several labels counts as the larger one; null labels and ids are left out. Without labels every score is 0.5.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("label"))
    share = bound / max(1, known.count())
    chosen = known.filter(drawn(share, "key", F.lit("quality"))).groupBy("key").agg(F.max("label").alias("label"))
    # At most about `bound` rows of two numbers.
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "key").dropDuplicates(["key", "text"]).select(
        "key", "label", "text", F.pmod(F.xxhash64("key", F.lit("shard")), F.lit(shards)).alias("shard"))

    def train(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["key", "text"])
        own, leader, order = [features(t) for t in part["text"]], Leader(), np.random.default_rng(5)
        labels = part["label"].to_numpy()
        for _ in range(EPOCHS):
            for i in order.permutation(len(own)):
                leader.step(*own[i], int(labels[i]))
        w, bias = leader.weights()
        return pd.DataFrame({"rows": [len(own)], "bias": [bias], "weights": [w.astype("<f4").tobytes()]})

    trained = rows.groupBy("shard").applyInPandas(train, "rows long, bias double, weights binary").collect()  # a row for each shard
    total = sum(r["rows"] for r in trained)
    if not total:
        return QualityModel(np.zeros(1 << BITS), 0.0)
    w = sum(np.frombuffer(r["weights"], "<f4").astype(np.float64) * (r["rows"] / total) for r in trained)
    return QualityModel(w, sum(r["bias"] * r["rows"] / total for r in trained))


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and score double between 0 and 1. A text without words gets the score of the bias alone; repeated rows stay."""
    shared = Shipped(docs.sparkSession, model)  # 2**BITS weights, whatever the corpus is

    def score(rows: Iterator[tuple]):
        own, keys, scores = shared.value, [], []
        for key, text in rows:
            keys.append(key)
            scores.append(own.score(text))
            if len(keys) >= 256:
                yield {id_col: keys, "score": scores}
                keys, scores = [], []
        if keys:
            yield {id_col: keys, "score": scores}

    return map_documents(docs, [id_col, text_col], f"{id_col} {docs.schema[id_col].dataType.simpleString()}, score double", score)

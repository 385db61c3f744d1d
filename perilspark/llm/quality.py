"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Features are 1- and 2-grams of the words as they stand, 1- to 3-grams of the words' shapes (``THE!!`` is ``A!``), and a
mark for a word that repeats the one before; all are hashed to ``2 ** BITS`` weights, and a feature's value is its share
of a text's words. A score is a sparse dot product and the logistic function.

Training takes a bounded sample of labelled rows (``TRAIN_ROWS``): each of ``SHARDS`` groups of rows makes its
per-coordinate FTRL-proximal updates from the common state, the states are averaged, and the next epoch starts from there. What
travels is the state, whose size is fixed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilspark.llm.common import as_bytes, bounded_sample, byte_batches, mix, starts_of, sum_by_row
from perilspark.llm.words import WordMemo, of_worker
from perilspark.session import materialise

BITS = 18
#: Labelled rows that training takes at most, chosen by a hash of the key.
TRAIN_ROWS = 20_000
SHARDS, EPOCHS = 8, 3
#: FTRL-proximal: learning rate, its smoothing, and the penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
#: A text's feature values sum to this many per kind of feature.
SCALE = 10.0

_SHAPE = bytes(
    ord("A") if 65 <= c <= 90 else ord("a") if 97 <= c <= 122 or c >= 128 else ord("0") if 48 <= c <= 57 else c for c in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


def describe(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and of its shape."""
    digest = xxhash.xxh64_intdigest
    shapes = [_RUN.sub(rb"\1", w.translate(_SHAPE)) for w in words]
    return np.array([digest(w) for w in words], np.uint64), np.array([digest(s, 1) for s in shapes], np.uint64)


class Features:
    """Hashed features of texts: (features of all texts in order, number of each text's)."""

    def __init__(self) -> None:
        self.memo = WordMemo(describe)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature numbers in runs by text, run lengths, and numbers of words."""
        counts, codes, (word, shape) = self.memo.of_texts(texts)
        w, s = word[codes], shape[codes]
        starts = starts_of(counts)
        place = np.arange(len(codes)) - np.repeat(starts[:-1], counts)
        salt = lambda x, n: mix(x + np.uint64(n))

        def back(x: np.ndarray, n: int) -> np.ndarray:
            """The value n words before; 0 before the first word."""
            out = np.zeros_like(x)
            out[n:] = x[:-n] if n else x
            out[place < n] = 0
            return out

        w1, s1, s2 = back(w, 1), back(s, 1), back(s, 2)
        columns = [
            salt(w, 1),
            mix(salt(w, 2) + w1),
            salt(s, 3),
            mix(salt(s, 4) + s1),
            mix(mix(salt(s, 5) + s1) + s2),
            np.where((w == w1) & (place > 0), salt(s, 6), np.uint64(7)),
        ]
        return (np.stack(columns, axis=1).ravel() >> np.uint64(64 - BITS)).astype(np.int64), counts * len(columns), counts


def features_of_worker() -> Features:
    """One for all tasks of a worker, so that words are described once."""
    return of_worker(Features)


def margin(weights: np.ndarray, bias: float, features: Features, texts: list[bytes]) -> np.ndarray:
    numbers, lengths, words = features(texts)
    return bias + sum_by_row(weights[numbers], lengths) * SCALE / np.maximum(words, 1)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class Ftrl:
    """State of FTRL-proximal: sums ``z`` and squared gradients ``n``; the last coordinate is the bias."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        g = (logistic(w @ x) - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def one_epoch(z: np.ndarray, n: np.ndarray):
    """One shard's updates, in a fixed order, from the common state on."""

    def run(shard: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("o", "ascending"), ("id", "ascending")])
        state, features = Ftrl(z.astype(np.float64), n.astype(np.float64)), features_of_worker()
        for batch in table.to_batches(max_chunksize=2000):
            labels = batch.column("y").to_numpy()
            for first, texts in byte_batches(batch, "body"):
                numbers, lengths, words = features(texts)
                starts = starts_of(lengths)
                for i in range(len(texts)):
                    at, times = np.unique(numbers[starts[i] : starts[i + 1]], return_counts=True)
                    state.update(np.append(at, len(z) - 1), np.append(times * SCALE / max(words[i], 1), 1.0), labels[first + i])
        return pa.table({"z": [state.z.astype(np.float32).tobytes()], "n": [state.n.astype(np.float32).tobytes()]})

    return run


def train(rows: DataFrame, key: str, text: str, label: str) -> tuple[np.ndarray, float]:
    """Weights and bias from labelled rows; labels are 0 or 1, others and null are left out."""
    spark = rows.sparkSession
    rows = rows.where(F.col(label).isin(0, 1)).select(F.col(key).alias("id"), as_bytes(text).alias("body"), F.col(label).cast("int").alias("y"))
    order = F.xxhash64("id", "body")
    rows = materialise(bounded_sample(rows, "id", TRAIN_ROWS).select("*", order.alias("o"), F.pmod(order, F.lit(SHARDS)).alias("shard")), "train")
    size = (1 << BITS) + 1
    z, n = np.zeros(size, np.float32), np.zeros(size, np.float32)
    for _ in range(EPOCHS):
        states = rows.groupBy("shard").applyInArrow(one_epoch(z, n), "z binary, n binary").collect()
        if states:
            z = np.mean([np.frombuffer(s["z"], np.float32) for s in states], axis=0)
            n = np.mean([np.frombuffer(s["n"], np.float32) for s in states], axis=0)
    weights = Ftrl(z, n).weights().astype(np.float32)
    return weights[:-1], float(weights[-1])


def quality_scores(docs: DataFrame, weights: np.ndarray, bias: float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score``, the probability of good quality; empty and null texts get that of the bias alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = features_of_worker()
        for batch in batches:
            for first, texts in byte_batches(batch, "body"):
                score = logistic(margin(weights, bias, features, texts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(score)], ["id", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("id"), as_bytes(text).alias("body")).mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", key)


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """Train on the labelled rows for which ``learn`` holds and score every document.

    ``labels`` holds ``key`` and ``label``; it may repeat documents or lack them. One row a document row, repeated keys
    included; an empty table gives no rows, and with no labels at all every score is 0.5. Other columns are ignored.
    """
    labelled = docs.select(key, text).where(learn).join(labels.select(key, label), key)
    weights, bias = train(labelled, key, text, label)
    return quality_scores(docs, weights, bias, key, text)

"""Toxicity: a support vector machine on a subsequence string kernel with Nystrom landmarks.

The kernel of two words is the inner product over all subsequences of ``P`` letters, each weighted by ``DECAY`` to the
power of its span, divided by the length that the weights of each word's places have; words that share most of an insult's letters in order are near it, with gaps or inserted
characters too. Words are folded to plain letters first (case, accents, digits that stand for letters, symbols dropped), and runs of
single letters (``i d i o t``) are read as one word.

Training takes a bounded sample of labelled rows (``TRAIN_ROWS``) and counts, for every folded word, the toxic and the clean
documents that hold it. Words are the examples, weighted by these counts; landmarks are picked among them by pivoted
Cholesky steps, half of them toxic words and half the clean words most like those; the machine (squared hinge) is solved in the landmarks' space. A document's margin is that of its worst word,
brought to a probability by logistic calibration on the sample's documents.

Since a landmark's subsequences can be listed, the sum over landmarks is folded into one weight a subsequence, so scoring a new word is
one gather, and a word is scored once in a worker.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilspark.llm.common import as_bytes, bounded_sample, byte_batches, starts_of
from perilspark.llm.words import WordMemo
from perilspark.session import materialise

P, DECAY = 3, 0.6
#: Letters a-z and the mark of a word's ends, the byte before ``a``.
MARK, LETTERS = b"`", 27
#: Longer words are read in overlapping pieces of so many letters.
PIECE = 16
#: Labelled rows that training takes at most; words it takes (the most frequent), and landmarks.
TRAIN_ROWS, TRAIN_WORDS, LANDMARKS = 20_000, 12_000, 320
#: Other words, chosen by a hash, that a first machine scores, and how many of the highest become examples of the second.
POOL, HARDEST = 40_000, 3_000
#: A word is an example of toxic ones if it stands between so many different pairs of words in toxic documents, and so many times
#: as often as in clean ones. Contexts are counted, not documents: copies of one toxic document show nothing.
POSITIVE_CONTEXTS, POSITIVE_LIFT = 4, 8.0
#: Candidates for toxic words whose contexts are counted, at most (those with the highest lift times documents).
CANDIDATES = 20_000
#: Ridge of the machine, and weight of clean examples against toxic ones.
RIDGE, CLEAN_WEIGHT = 0.1, 4.0

# Digits and signs that stand for letters.
_STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_PLAIN = str.maketrans(_STANDS_FOR)
_OTHER = bytes(c for c in range(256) if not 97 <= c <= 122)


def folded(word: bytes) -> bytes:
    """Plain letters a-z of a word between marks, or nothing; signs stand for letters only inside a word."""
    text = word.decode("utf-8", "ignore").casefold()
    text = text.strip(".,;:!?$\"'()").translate(_PLAIN)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
    plain = text.encode("ascii", "ignore").translate(None, _OTHER)
    return MARK + plain + MARK if plain else plain


def pieces(word: bytes) -> list[bytes]:
    """Overlapping pieces of a folded word of up to PIECE letters that cover it."""
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - PIECE // 2, PIECE // 2)]


@lru_cache(maxsize=None)
def subsequences(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all subsequences of P letters of a word of this length, and their weights."""
    at = np.array(list(combinations(range(length), P)), np.int64).reshape(-1, P)
    return at, DECAY ** (at[:, -1] - at[:, 0] + 1.0)


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Positions, subsequence numbers, their weights and norms for the words of each length from P on, in bounded parts."""
    lengths = np.array([len(w) for w in words], np.int64)
    for n in np.unique(lengths[lengths >= P]):
        mine = np.flatnonzero(lengths == n)
        at, weight = subsequences(int(n))
        for first in range(0, len(mine), 2000):
            some = mine[first : first + 2000]
            letters = np.frombuffer(b"".join([words[i] for i in some]), np.uint8).reshape(len(some), n).astype(np.int32) - MARK[0]
            number = letters[:, at[:, 0]].astype(np.int32)
            for k in range(1, P):
                number = number * LETTERS + letters[:, at[:, k]]
            yield some, number, weight, np.full(len(some), np.sqrt((weight**2).sum()))


def features(words: list[bytes]) -> np.ndarray:
    """Normalised subsequence weights of a few words, one dense row each; words without letters are 0."""
    out = np.zeros((len(words), LETTERS**P), np.float32)
    for some, number, weight, norm in by_length(words):
        for row, numbers, length in zip(some, number, norm):
            out[row] = np.bincount(numbers, weight, LETTERS**P) / length
    return out


def kernels(words: list[bytes], table: np.ndarray) -> np.ndarray:
    """Kernel of words with the landmarks whose features are the rows of ``table``."""
    out = np.zeros((len(words), len(table)))
    turned = np.ascontiguousarray(table.T)
    for some, number, weight, norm in by_length(words):
        for first in range(0, len(some), 20):
            part = slice(first, first + 20)
            out[some[part]] = np.matmul(weight.astype(np.float32), turned[number[part]]) / norm[part, None]
    return out


def pick_landmarks(words: list[bytes], number: int) -> list[bytes]:
    """Words that together span the others best: greedy pivots of their kernel matrix."""
    table = features(words)
    rest = (table**2).sum(axis=1).astype(np.float64)
    steps = np.zeros((number, len(words)))
    picked: list[int] = []
    for k in range(min(number, len(words))):
        i = int(np.argmax(rest))
        if rest[i] < 1e-6:
            break
        row = table @ table[i] - steps[:k, i] @ steps[:k]
        steps[k] = row / np.sqrt(rest[i])
        rest = np.maximum(rest - steps[k] ** 2, 0)
        rest[i] = 0
        picked.append(i)
    return [words[i] for i in picked]


def solve_machine(z: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared-hinge machine with a bias, by Newton steps on the examples inside the margin."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(x.shape[1])
    ridge = RIDGE * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-8
    inside = np.ones(len(x), bool)
    for _ in range(50):
        c = cost * inside
        w = np.linalg.solve(ridge + (x * c[:, None]).T @ x, (x * c[:, None]).T @ y)
        now = y * (x @ w) < 1
        if np.array_equal(now, inside):
            break
        inside = now
    return w[:-1], float(w[-1])


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through (margin, label), with a little ridge."""
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + 1e-3 * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


class Margins:
    """Margin of each text: that of its worst word or run of single letters."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.memo = WordMemo(self.describe, 800_000)

    def of_folded(self, words: list[bytes]) -> np.ndarray:
        """A word has the margin of its worst piece; words without letters have that of the bias."""
        parts = [pieces(w) for w in words]
        flat = [p for x in parts for p in x]
        out = np.full(len(flat), self.bias)
        for some, number, weight, norm in by_length(flat):
            out[some] += self.weights[number] @ weight / norm
        return np.maximum.reduceat(out, starts_of(np.array([len(x) for x in parts]))[:-1]) if words else out

    def describe(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        plain = [folded(w) for w in words]
        known = {w: i for i, w in enumerate(dict.fromkeys(plain))}
        value = self.of_folded(list(known))
        letter = np.array([p[1] if len(p) == 3 else 0 for p in plain], np.uint8)
        return value[[known[p] for p in plain]] if plain else value, letter

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        counts, codes, (value, letter) = self.memo.of_texts(texts)
        starts = starts_of(counts)
        out = np.full(len(texts), self.bias)
        full = np.flatnonzero(counts)
        if len(full):
            out[full] = np.maximum.reduceat(value[codes], starts[full])
        rows, runs = spelled(letter[codes], counts)
        if runs:
            np.maximum.at(out, rows, self.of_folded(runs))
        return out


def spelled(letters: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Runs of at least P words of one letter each, within a text: (text, letters joined)."""
    single = letters > 0
    if not single.any():
        return np.empty(0, np.int64), []
    text = np.repeat(np.arange(len(counts)), counts)
    first = single & np.concatenate([[True], ~single[:-1] | (text[1:] != text[:-1])])
    start = np.flatnonzero(first)
    run = np.cumsum(first)[single] - 1
    size = np.bincount(run, minlength=len(start))
    keep = np.flatnonzero(size >= P)
    return text[start[keep]], [MARK + letters[start[i] : start[i] + size[i]].tobytes() + MARK for i in keep]


def count_words(rows: DataFrame) -> DataFrame:
    """For every folded piece of a word, the toxic and the clean documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, list[bytes]] = {}
        for batch in batches:
            labels = batch.column("y").to_numpy()
            for first, texts in byte_batches(batch, "body"):
                counts = [Counter(), Counter()]
                if len(memo) > 400_000:
                    memo = {}
                for i, text in enumerate(texts):
                    words = set(text.split())
                    for w in words:
                        if w not in memo:
                            memo[w] = [p for p in pieces(folded(w)) if len(p) >= P]
                    counts[labels[first + i]].update({p for w in words for p in memo[w]})
                names = list(counts[0].keys() | counts[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n.decode() for n in names], pa.string()), pa.array([counts[1][n] for n in names], pa.int64()), pa.array([counts[0][n] for n in names], pa.int64())],
                    ["word", "toxic", "clean"],
                )

    return rows.mapInArrow(run, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def count_contexts(rows: DataFrame, candidates: set[bytes]) -> DataFrame:
    """For every candidate the number of different (word before, word after) it has in toxic and in clean documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, tuple[bytes, ...]] = {}
        for batch in batches:
            labels = batch.column("y").to_numpy()
            for first, texts in byte_batches(batch, "body"):
                seen = set()
                if len(memo) > 400_000:
                    memo = {}
                for y, text in zip(labels[first:].tolist(), texts):
                    words = text.split()
                    for w in set(words):
                        if w not in memo:
                            memo[w] = tuple(p for p in pieces(folded(w)) if p in candidates)
                    for i, own in enumerate(map(memo.__getitem__, words)):
                        for p in own:
                            around = (words[i - 1] if i else b"") + b" " + (words[i + 1] if i + 1 < len(words) else b"")
                            seen.add((p, xxhash.xxh64_intdigest(around) >> 1, y))
                columns = [pa.array([w.decode() for w, _, _ in seen], pa.string()), pa.array([c for _, c, _ in seen], pa.int64()), pa.array([y for _, _, y in seen], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["word", "around", "y"])

    found = rows.select("y", "body").mapInArrow(run, "word string, around long, y int").distinct()
    return found.groupBy("word").agg(F.sum("y").alias("in_toxic"), F.sum(1 - F.col("y")).alias("in_clean"))


class ToxicityModel:
    """Weights of subsequences with the bias, and the calibration curve."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights, bias, slope, offset


def fit(words: pd.DataFrame, hard: list[bytes]) -> tuple[np.ndarray, float]:
    """Weights of subsequences and bias of the machine on counted words; ``hard`` ones are candidates for landmarks."""
    names, positive = [w.encode() for w in words["word"]], words["positive"].to_numpy()
    y = np.where(positive, 1.0, -1.0)
    toxic, both = words["toxic"].to_numpy(), np.sqrt(words["toxic"].to_numpy() + words["clean"].to_numpy())
    cost = np.where(positive, toxic / toxic[positive].sum(), CLEAN_WEIGHT * both / max(both[~positive].sum(), 1)) * len(words) / 10
    toxic_ones = pick_landmarks([n for n, p in zip(names, positive) if p][:1000], LANDMARKS // 2)
    others = [n for n, p in zip(names, positive) if not p]
    likeness = kernels(others, features(toxic_ones)).max(axis=1, initial=0) if others else np.empty(0)
    close = hard + [others[i] for i in np.argsort(-likeness, kind="stable")[:1000]]
    table = features(toxic_ones + (pick_landmarks(close, LANDMARKS - len(toxic_ones)) if close else []))
    value, vector = np.linalg.eigh((table @ table.T).astype(np.float64))
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-4))) @ vector.T
    w, bias = solve_machine(kernels(names, table) @ root, y, cost)
    return (root @ w @ table).astype(np.float32), bias


def train(rows: DataFrame, key: str, text: str, label: str) -> ToxicityModel:
    """Model from labelled rows; labels are 0 or 1, others and null are left out."""
    rows = rows.where(F.col(label).isin(0, 1)).select(F.col(key).alias("id"), as_bytes(text).alias("body"), F.col(label).cast("int").alias("y"))
    rows = materialise(bounded_sample(rows, "id", TRAIN_ROWS), "train")
    totals = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    flat = ToxicityModel(np.zeros(LETTERS**P, np.float32), 0.0, 0.0, float(np.log((toxic + 0.5) / (clean + 0.5))))
    if not toxic or not clean:
        return flat
    lift = lambda a, b: (F.col(a) / toxic) / ((F.col(b) + 0.5) / clean)
    counted = materialise(count_words(rows).where(F.col("toxic") + F.col("clean") >= 2), "words")
    likely = counted.where((F.col("toxic") >= POSITIVE_CONTEXTS) & (lift("toxic", "clean") >= POSITIVE_LIFT / 2))
    likely = likely.orderBy(F.desc(lift("toxic", "clean") * F.col("toxic")), "word").limit(CANDIDATES).select("word").toPandas()["word"]
    contexts = count_contexts(rows, {w.encode() for w in likely})
    positive = (F.col("in_toxic") >= POSITIVE_CONTEXTS) & (lift("in_toxic", "in_clean") >= POSITIVE_LIFT)
    counted = counted.join(contexts, "word", "left").withColumn("positive", F.coalesce(positive, F.lit(False)))
    # Words that only copies of toxic documents hold are examples of neither kind.
    counted = counted.where(F.col("positive") | F.col("in_toxic").isNull() | (lift("in_toxic", "in_clean") < 2))
    counted = materialise(counted.select("word", "toxic", "clean", "positive"), "examples")
    words = counted.orderBy(F.desc("positive"), F.desc(F.col("toxic") + F.col("clean")), "word").limit(TRAIN_WORDS).toPandas()
    if not words["positive"].any():
        return flat
    weights, bias = fit(words, [])
    pool = counted.where(~F.col("positive")).orderBy(F.xxhash64("word"), "word").limit(POOL).toPandas()
    pool = pool[~pool["word"].isin(words["word"])]
    order = np.argsort(-Margins(weights, bias).of_folded([w.encode() for w in pool["word"]]), kind="stable")[:HARDEST]
    hardest = pool.iloc[order]
    weights, bias = fit(pd.concat([words, hardest]), [w.encode() for w in hardest["word"][:500]])
    margins = _margins(rows, "id", weights, bias, "y").select("margin", "y").toPandas()
    slope, offset = calibrate(margins["margin"].to_numpy(), margins["y"].to_numpy())
    return ToxicityModel(weights, bias, slope, offset)


def _margins(rows: DataFrame, key: str, weights: np.ndarray, bias: float, *more: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins = Margins(weights, bias)
        for batch in batches:
            for first, texts in byte_batches(batch, "body"):
                kept = [batch.column(c).slice(first, len(texts)) for c in (key, *more)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(margins(texts))], [key, *more, "margin"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (key, *more))
    return rows.select(key, *more, "body").mapInArrow(run, f"{kinds}, margin double")


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Train on the labelled rows for which ``learn`` holds and give ``key`` and ``score``, the probability of toxicity.

    ``labels`` holds ``key`` and ``label``; it may repeat documents or lack them. Null and empty texts have the score of a
    text without words. One row a document row, repeated keys included; an empty table gives no rows; without labels of
    both kinds every score is the share of toxic ones. Other columns are ignored.
    """
    model = train(docs.select(key, text).where(learn).join(labels.select(key, label), key), key, text, label)
    rows = docs.select(F.col(key).alias("id"), as_bytes(text).alias("body"))
    margin = _margins(rows, "id", model.weights, model.bias)
    score = 1 / (1 + F.exp(-(F.col("margin") * model.slope + model.offset)))
    return margin.select(F.col("id").alias(key), score.alias("score"))

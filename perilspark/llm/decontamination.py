"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Documents and items are compared by shingles of five words (A-Z lower-cased). For every item that shares a shingle with a
document, windows of the item's size slide over the places of the shared shingles, and each gets a 64-bit SimHash. The
items' fingerprints are indexed by ``BLOCKS`` blocks: two fingerprints within ``RADIUS`` bits differ in at most
``RADIUS // BLOCKS`` bits of some block, so probing every block with that many changed bits finds all of them. Candidates
are verified by the exact weighted similarity of the shingle multisets, sum of minima over sum of maxima. A similarity above zero needs a shared
shingle, so looking only there loses nothing.

Items are a stated query set: they are taken in blocks of bounded size (``ITEM_BYTES``), and each block is sent to all tasks, so
what travels to a task is bounded however large the benchmark is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilspark.llm.common import as_bytes, byte_batches, mix, split_mix, starts_of
from perilspark.llm.simhash_dedup import fold
from perilspark.llm.words import WordMemo
from perilspark.session import materialise

WORDS, SIMILARITY = 5, 0.8
#: Weighted similarity of 0.8 is an angle of about 27 degrees, 10 of 64 bits; the radius leaves ample room for chance.
RADIUS, BLOCKS = 26, 16
#: Text bytes of benchmark items sent to all tasks at a time.
ITEM_BYTES = 8 << 20
_FACTORS = split_mix(8, 5) | np.uint64(1)


def describe(words: list[bytes]) -> tuple[np.ndarray]:
    return (np.array([xxhash.xxh64_intdigest(w, 3) for w in words], np.uint64),)


def shingles(names: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` words at each place that has so many."""
    n = max(len(names) - width + 1, 0)
    out = np.full(n, np.uint64(width))
    for k in range(width):
        out += names[k : k + n] * _FACTORS[k]
    return mix(out)


class Items:
    """Shingles, sizes and fingerprints of benchmark items, and the index over the fingerprints' blocks."""

    def __init__(self, items: list[tuple[object, bytes]]):
        memo = WordMemo(describe)
        self.ids, self.width, self.counts = [], [], []
        hashes, owner = [], []
        for name, text in items:
            words = text.lower().split()
            if not words:
                continue
            codes, (value,) = memo.look_up(words)
            width = min(WORDS, len(words))
            own = shingles(value[codes], width)
            owner += [len(self.ids)] * len(own)
            self.ids.append(name)
            self.width.append(width)
            self.counts.append(Counter(own.tolist()))
            hashes.append(own)
        self.size = np.array([len(x) for x in hashes], np.int64)
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.prints = fold(flat, self.size) if hashes else np.zeros(0, np.uint64)
        pairs = sorted({*zip(flat.tolist(), owner)})
        self.shingle = np.array([s for s, _ in pairs], np.uint64)
        self.owner = np.array([o for _, o in pairs], np.int64)
        self.known = np.unique(self.shingle)
        self.widths = sorted(set(self.width))
        bits = 64 // BLOCKS
        changes = [sum(1 << i for i in c) for k in range(RADIUS // BLOCKS + 1) for c in combinations(range(bits), k)]
        self.found = np.zeros((BLOCKS, 1 << bits, len(self.ids)), bool)
        for b in range(BLOCKS):
            part = (self.prints >> np.uint64(b * bits)) & np.uint64((1 << bits) - 1)
            for change in changes:
                self.found[b, part ^ np.uint64(change), np.arange(len(self.ids))] = True

    def near(self, item: int, prints: np.ndarray) -> np.ndarray:
        """Which fingerprints the index finds for an item and lie within the radius."""
        bits = 64 // BLOCKS
        hit = np.zeros(len(prints), bool)
        for b in range(BLOCKS):
            hit |= self.found[b, (prints >> np.uint64(b * bits)) & np.uint64((1 << bits) - 1), item]
        return hit & (np.bitwise_count(prints ^ self.prints[item]) <= RADIUS)

    def matches(self, names: np.ndarray, similarity: float) -> list[tuple[object, float, int, int]]:
        """(item, similarity, first word, words) of each item that some window of a text reaches; the best window."""
        found = []
        for width in self.widths:
            own = shingles(names, width)
            if not len(own):
                continue
            at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
            places = np.flatnonzero(self.known[at] == own)
            if not len(places):
                continue
            low, high = np.searchsorted(self.shingle, own[places], "left"), np.searchsorted(self.shingle, own[places], "right")
            count = high - low
            item = self.owner[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(starts_of(count)[:-1], count)]
            place = np.repeat(places, count)
            order = np.argsort(item, kind="stable")
            item, place = item[order], place[order]
            cut = np.flatnonzero(np.diff(item)) + 1
            for j, here in zip(item[np.concatenate([[0], cut])].tolist(), np.split(place, cut)):
                if self.width[j] == width:
                    best = self.best_window(j, own, here, similarity)
                    if best:
                        found.append((self.ids[j], best[0], best[1], best[2] + width - 1))
        return found

    def best_window(self, j: int, own: np.ndarray, here: np.ndarray, similarity: float) -> tuple[float, int, int] | None:
        """Best window for item ``j`` among those that hold one of its shingles, which lie at ``here``."""
        size, n = int(self.size[j]), len(own)
        wide = min(size, n)
        # Shared places that any window needs: a sum of minima of at least s (|window| + |item|) / (1 + s).
        need = similarity * (wide + size) / (1 + similarity) - 1e-9
        if len(here) < need:
            return None
        shared = np.zeros(n + 1, np.int64)
        shared[here + 1] = 1
        shared = np.cumsum(shared)
        starts = np.flatnonzero(shared[wide:] - shared[: n - wide + 1] >= need)
        best = None
        for first in range(0, len(starts), 256):
            some = starts[first : first + 256]
            windows = own[some[:, None] + np.arange(wide)]
            prints = fold(windows.ravel(), np.full(len(some), wide))
            for k in np.flatnonzero(self.near(j, prints)):
                weights = Counter(windows[k].tolist())
                least = sum(min(c, weights[s]) for s, c in self.counts[j].items())
                value = least / (wide + size - least)
                if value >= similarity and (best is None or value > best[0]):
                    best = (value, int(some[k]), wide)
        return best


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``key``, ``item``, ``similarity``, ``first_word`` and ``n_words`` of the best window for every document and item that match.

    A match is a window of the item's number of five-word shingles (the whole document if it is shorter) whose weighted
    similarity with the item is at least ``similarity``. Items of fewer than five words are one shingle of all their
    words; items and documents without words (null, empty, white space) match nothing. Repeated rows of either table
    give rows of their own; empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    bodies = benchmark.select(F.col(item).alias("item"), as_bytes(item_text).alias("body"))
    bodies = materialise(bodies.where(F.octet_length("body") > 0), "items")
    size = bodies.agg(F.coalesce(F.sum(F.octet_length("body") + 64), F.lit(0))).first()[0]
    parts = max(1, -(-size // ITEM_BYTES))
    kind, item_kind = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), as_bytes(text).alias("body"))

    def compare(block: list[tuple[object, bytes]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items, memo = Items(block), WordMemo(describe)
            for batch in batches:
                for first, texts in byte_batches(batch, "body"):
                    counts, codes, (value,) = memo.of_texts([x.lower() for x in texts])
                    names, begin = value[codes], starts_of(counts)
                    out = [(first + i, *m) for i in range(len(texts)) for m in items.matches(names[begin[i] : begin[i + 1]], similarity)]
                    if out:
                        at, ids, values, starts, words = zip(*out)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(at)), pa.array(ids, item_type), pa.array(values, pa.float64()), pa.array(starts, pa.int64()), pa.array(words, pa.int64())],
                            ["id", "item", "similarity", "first_word", "n_words"],
                        )

        return run

    from pyspark.sql.pandas.types import to_arrow_type

    item_type = to_arrow_type(benchmark.schema[item].dataType)
    found = None
    for number in range(parts):
        part = bodies.where(F.pmod(F.xxhash64("item", "body"), F.lit(parts)) == number).collect()
        if part:
            run = compare([(r["item"], bytes(r["body"])) for r in part])
            more = rows.mapInArrow(run, f"id {kind}, item {item_kind}, similarity double, first_word long, n_words long")
            found = more if found is None else found.unionByName(more)
    if found is None:
        found = spark.createDataFrame([], f"id {kind}, item {item_kind}, similarity double, first_word long, n_words long")
    return found.select(F.col("id").alias(key), F.col("item").alias(item), "similarity", "first_word", "n_words")


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that match no benchmark item, with all their columns."""
    return docs.join(contaminated(docs.select(key, text), benchmark, key, text).select(key).distinct(), key, "left_anti")

"""Packing into fixed windows by non-negative least squares.

A document's tokens are cut into full windows and a remainder. The remainders' histogram (at most one bin a length) is what
the plan is made from: shallow combinations of lengths that fill a window exactly (one length that is a power of two, pairs,
triples of frequent lengths, and repeats of a frequent length with one other) are the columns of a matrix, non-negative least squares
gives their repeat counts against the histogram, the counts are rounded down to what the histogram holds, and a greedy pass
raises them where it can. Documents get ranks within their length and find their place in the plan by rank; remainders
that no combination took are laid end to end and cut at the windows' borders, so only the very last window is padded.

The plan's size depends on the window alone. Ranks and running totals are sums of small chunks of rows, never one sorted whole.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from perilspark.llm.common import as_bytes, byte_batches
from perilspark.llm.words import of_worker
from perilspark.session import materialise

WINDOW, END_ID = 4096, 2
#: Most frequent lengths that triples and repeats are built from, and repeats of one length at most.
FREQUENT, REPEATS = 64, 8
ROUNDS = 400
#: Documents of one unit of ranking.
CHUNK_ROWS = 1024
#: Words whose ids a worker keeps; only bounds memory.
KEPT_WORDS = 500_000
_SPECIAL = "<|endoftext|>"


#: Signs that end a word, all of ASCII but the apostrophe (which the tokenizer joins with some letters after it).
_SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_LATIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


class Tokens:
    """Ids of texts as little-endian arrays; words of ASCII white space are encoded once in a worker.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its words in turn. A tokenizer that
    lower-cases, takes runs of letters apart from signs and marks each run's last id encodes the letters and the signs of a word
    once each. Strings that the file calls special tokens have their own ids, as in the tokenizer.
    """

    def __init__(self, name: str):
        path = name if "/" in name else public_tokenizers.path(name)
        self.fast = Tokenizer.from_file(path)
        self.separator = self.fast.token_to_id(_SPECIAL)
        size = self.fast.get_vocab_size()
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.known: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        steps = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        suffix = rules["model"].get("end_of_word_suffix")
        self.apart = bool(suffix) and [x["type"] for x in steps] == ["Split", "ByteLevel"] and "[\\p{L}]+|" in json.dumps(steps[0]["pattern"], ensure_ascii=False).replace("\\\\", "\\")
        if self.apart:
            # Letters need no normal form and no pattern: white space between them and the byte alphabet are enough.
            self.letters = Tokenizer.from_file(path)
            self.letters.normalizer = normalizers.Sequence([])
            bytelevel = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytelevel])
            self.last = np.zeros(size, bool)
            self.last[[i for token, i in self.fast.get_vocab().items() if token.endswith(suffix)]] = True

    def learn(self, words: list[bytes]) -> None:
        """Ids of new words."""
        stems, signs, plain, other = [], [], [], []
        if self.apart:
            lower = b"\n".join(words).decode("utf-8", "replace").lower().split("\n")
            for w, text in zip(words, lower):
                stem = text.rstrip(_SIGNS)
                if stem.isalpha() and (stem.isascii() or _LATIN.fullmatch(stem)):
                    plain.append(w)
                    stems.append(stem)
                    signs.append(text[len(stem) :])
                else:
                    other.append(w)
        else:
            other = words
        self.encode(other)
        self.encode_letters(list(set(stems).difference(self.parts)))
        tails = [x.encode() for x in set(signs).difference(self.parts) if x]
        self.encode([x for x in tails if x not in self.known])
        self.parts.update((x.decode(), self.known[x]) for x in tails)
        self.parts[""] = b""
        of = self.parts.__getitem__
        self.known.update(zip(plain, map(bytes.__add__, map(of, stems), map(of, signs))))

    def encode_letters(self, units: list[str]) -> None:
        size = self.kind.itemsize
        for first in range(0, len(units), 1000):
            part = units[first : first + 1000]
            ids = np.array(self.letters.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int64)
            ends = ((np.flatnonzero(self.last[ids]) + 1) * size).tolist()
            if len(ends) != len(part):
                raise ValueError("the tokenizer took letters apart")
            packed = ids.astype(self.kind).tobytes()
            self.parts.update(zip(part, [packed[a:b] for a, b in zip([0, *ends], ends)]))

    def encode(self, words: list[bytes]) -> None:
        odd = [w for w in words if b"<|" in w]
        plain = [w for w in words if b"<|" not in w]
        for w in odd:
            self.known[w] = np.array(self.fast.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids, self.kind).tobytes()
        for first in range(0, len(plain), 1000):
            part = plain[first : first + 1000]
            joined = _SPECIAL.join(w.decode("utf-8", "replace") for w in part)
            # The fast form leaves out offsets; a batch of one starts no threads.
            ids = np.array(self.fast.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
            cuts = np.flatnonzero(ids == self.separator)
            if len(cuts) != len(part) - 1:
                raise ValueError("the tokenizer took a word for a separator")
            edges = [-1, *cuts.tolist(), len(ids)]
            packed = ids.astype(self.kind).tobytes()
            size = self.kind.itemsize
            for w, a, b in zip(part, edges, edges[1:]):
                self.known[w] = packed[(a + 1) * size : b * size]

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        split = [x.split() for x in texts]
        if len(self.known) > KEPT_WORDS // 2:
            # The older half goes; what is met again moves to the younger.
            self.earlier, self.known, self.parts = self.known, {}, {}
        new = set().union(*split).difference(self.known)
        again = new.intersection(self.earlier)
        self.known.update(zip(again, map(self.earlier.__getitem__, again)))
        if len(new) > len(again):
            self.learn(list(new - again))
        end = np.array([END_ID], self.kind).tobytes()
        get = self.known.__getitem__
        return [b"".join(map(get, x)) + end for x in split]


def tokens_of(name: str) -> Tokens:
    """One for all tasks of a worker."""
    return of_worker(Tokens, name)


def combinations_of(histogram: np.ndarray, window: int) -> list[tuple[tuple[int, int], ...]]:
    """Combinations of present lengths that leave no padding: tuples of (length, times)."""
    present = np.flatnonzero(histogram)
    present = present[present > 0]
    here = set(present.tolist())
    often = sorted(here, key=lambda n: (-histogram[n], n))[:FREQUENT]
    found: dict[tuple[tuple[int, int], ...], None] = {}

    def add(*lengths: int) -> None:
        names, times = np.unique(lengths, return_counts=True)
        found[tuple(zip(names.tolist(), times.tolist()))] = None

    for n in sorted(here):
        if n & (n - 1) == 0:
            add(n)
        if 2 * n <= window and window - n in here:
            add(n, window - n)
    for i, a in enumerate(often):
        for b in often[i:]:
            if window - a - b in here:
                add(a, b, window - a - b)
        for times in range(2, REPEATS + 1):
            rest = window - times * a
            if rest in here:
                add(*[a] * times, rest)
            elif rest == 0:
                add(*[a] * times)
    return list(found)


def solve_counts(combos: list[tuple[tuple[int, int], ...]], histogram: np.ndarray) -> np.ndarray:
    """Whole repeat counts that the histogram can serve, near the non-negative least-squares fit to it."""
    if not combos:
        return np.zeros(0, np.int64)
    column = np.concatenate([[i] * len(c) for i, c in enumerate(combos)])
    row = np.array([n for c in combos for n, _ in c])
    times = np.array([t for c in combos for _, t in c], np.float64)
    target = histogram.astype(np.float64)
    # Accelerated projected gradient on the column-scaled problem; the step is the bound of the largest eigenvalue.
    scale = 1 / np.sqrt(np.bincount(column, times**2))
    value = times * scale[column]
    step = 1 / (np.bincount(row, np.abs(value), len(histogram)).max() * np.bincount(column, np.abs(value)).max())
    x = np.zeros(len(combos))
    y, speed = x.copy(), 1.0
    for _ in range(ROUNDS):
        gap = np.bincount(row, value * y[column], len(histogram)) - target
        new = np.maximum(y - step * np.bincount(column, value * gap[row]), 0)
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        y = new + (speed - 1) / faster * (new - x)
        x, speed = new, faster
    wanted = np.floor(x * scale + 1e-9).astype(np.int64)
    left = histogram.astype(np.int64).copy()
    counts = np.zeros(len(combos), np.int64)
    for limit in (True, False):
        for i in np.argsort(-wanted, kind="stable"):
            most = min(int(left[n]) // t for n, t in combos[i])
            take = min(int(wanted[i]), most) if limit else most
            if take > 0:
                counts[i] += take
                for n, t in combos[i]:
                    left[n] -= t * take
    return counts


class Plan:
    """Places of ranks within a length: intervals sorted by (length, first rank)."""

    def __init__(self, histogram: np.ndarray, window: int):
        combos = combinations_of(histogram, window)
        counts = solve_counts(combos, histogram)
        used = np.zeros(len(histogram), np.int64)
        rows = []
        self.sequences = 0
        for combo, count in zip(combos, counts.tolist()):
            if not count:
                continue
            offset = 0
            for n, times in combo:
                for _ in range(times):
                    rows.append((n, used[n], self.sequences, offset))
                    used[n] += count
                    offset += n
            self.sequences += count
        rows.sort()
        self.used = used
        self.length, self.first, self.sequence, self.offset = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 4
        self.start = np.searchsorted(self.length, np.arange(len(histogram) + 1))

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of a rank of a length, -1 where no combination took it."""
        taken = rank < self.used[length]
        key = self.length * (1 << 40) + self.first
        at = np.searchsorted(key, length * (1 << 40) + rank, side="right") - 1
        at = np.where(taken, at, 0)
        if not len(key):
            return np.full(len(rank), -1), np.full(len(rank), -1)
        return np.where(taken, self.sequence[at] + rank - self.first[at], -1), np.where(taken, self.offset[at], -1)


def running(totals: DataFrame, key: str, column: str) -> DataFrame:
    """Adds ``before``, the sum of ``column`` over smaller keys (whole numbers from 0), by blocks of keys."""
    blocks = totals.withColumn("block", F.floor(F.col(key) / 1024))
    sums = blocks.groupBy("block").agg(F.sum(column).alias("s"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("block", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("within", F.coalesce(F.sum(column).over(inside), F.lit(0)))
    return blocks.join(sums, "block").withColumn("before", F.col("base") + F.col("within")).drop("block", "base", "within")


def tokenize(docs: DataFrame, key: str, text: str, tokenizer: str) -> DataFrame:
    """``row`` (a number for the row), ``id``, ``n`` and ``ids`` (binary) of every document, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer)
        for batch in batches:
            for first, texts in byte_batches(batch, "body"):
                ids = tokens(texts)
                sizes = np.array([len(x) // tokens.kind.itemsize for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(sizes), pa.array(ids, pa.binary())], ["id", "n", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), as_bytes(text).alias("body")).mapInArrow(run, f"id {kind}, n long, ids binary")
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "tokens")


def pack_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "word_bpe_49k.json", window: int = WINDOW
) -> DataFrame:
    """One row a piece: ``key``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A document's tokens are its text's ids and the end id; null and empty texts are the end id alone. Every id lies in
    one piece; sequences hold at most ``window`` ids, and all but one are full or hold a power of two. Repeated keys are packed
    row by row; an empty table gives no rows; other columns are ignored.
    """
    tokens = tokenize(docs, key, text, tokenizer)
    chunks = max(1, -(-tokens.count() // CHUNK_ROWS))
    rows = tokens.select("row", F.floor(F.col("n") / window).alias("full"), (F.col("n") % window).cast("int").alias("rest"), F.pmod(F.xxhash64("row"), F.lit(chunks)).alias("chunk"))
    histogram = np.zeros(window, np.int64)
    for r in rows.where("rest > 0").groupBy("rest").count().collect():
        histogram[r["rest"]] = r["count"]
    plan = Plan(histogram, window)
    whole = tokens.agg(F.coalesce(F.sum(F.floor(F.col("n") / window)), F.lit(0))).first()[0]

    # Rank of a document within its remainder's length: documents before it in its chunk, and in the chunks before.
    per_chunk = rows.groupBy("rest", "chunk").count()
    earlier = Window.partitionBy("rest").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = per_chunk.select("rest", "chunk", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("rest", "chunk").orderBy("row")
    ranked = rows.withColumn("rank", F.row_number().over(inside) - 1).join(per_chunk, ["rest", "chunk"])
    ranked = ranked.select("row", "chunk", "full", "rest", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest, rank = batch.column("rest").to_numpy().astype(np.int64), batch.column("rank").to_numpy().astype(np.int64)
            sequence, offset = plan.place(rest, rank)
            left = np.where(sequence < 0, rest, 0)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("chunk"), batch.column("full"), pa.array(sequence), pa.array(offset), pa.array(left)], ["row", "chunk", "full", "sequence", "offset", "left"])

    placed = materialise(ranked.mapInArrow(place, "row long, chunk long, full long, sequence long, offset long, left long"), "placed")
    totals = placed.groupBy("chunk").agg(F.sum("left").alias("left"), F.sum("full").alias("full"))
    lefts = running(totals.select("chunk", "left"), "chunk", "left").select("chunk", F.col("before").alias("left_before"))
    fulls = running(totals.select("chunk", "full"), "chunk", "full").select("chunk", F.col("before").alias("full_before"))
    bases = materialise(lefts.join(fulls, "chunk"), "bases")
    earlier = Window.partitionBy("chunk").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.withColumns({c + "_at": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in ("left", "full")}).join(bases, "chunk")
    sums = sums.select("row", "sequence", "offset", (F.col("left_at") + F.col("left_before")).alias("left_at"), (F.col("full_at") + F.col("full_before")).alias("full_at"))
    first_combined, first_left = int(whole), int(whole) + plan.sequences

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [batch.column(c).to_pylist() for c in ("n", "sequence", "offset", "left_at", "full_at")]
            ids = batch.column("ids")
            rows: list[tuple] = []
            for i, (n, sequence, offset, left_at, full_at) in enumerate(zip(*at)):
                packed = ids[i].as_py()
                values = np.frombuffer(packed, f"<u{len(packed) // n}").astype("<u4")
                cut = [(full_at + k, k * window, window, 0) for k in range(n // window)]
                start, rest = n // window * window, n % window
                if rest and sequence >= 0:
                    cut.append((first_combined + sequence, start, rest, offset))
                while rest and sequence < 0:
                    here = min(rest, window - left_at % window)
                    cut.append((first_left + left_at // window, start, here, left_at % window))
                    start, rest, left_at = start + here, rest - here, left_at + here
                for number, start, length, offset in cut:
                    body = values[start : start + length].tobytes()
                    rows.append((i, start, length, body, zlib.crc32(body), n, number, offset))
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(columns[0])), *(pa.array(c, pa.binary() if k == 2 else pa.int64()) for k, c in enumerate(columns[1:]))],
                    ["id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
                )

    kind = docs.schema[key].dataType.simpleString()
    out = tokens.join(sums, "row").select("id", "n", "ids", "sequence", "offset", "left_at", "full_at")
    return out.mapInArrow(pieces, f"id {kind}, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long").withColumnRenamed("id", key)

"""Language-model scoring: a hashed maximum-entropy model with class-factored softmax.

The probability of a word is that of its class given the words before, times that of the word within its class. The
class model is log-linear: hashed features of the history (the word before, the two before as a pair, and skips to the
second and third before) each have a row of one weight a class, and the softmax runs over the classes. It is trained by
distributed gradient updates: every task makes minibatch steps on its documents from the common weights, weighted means of
the tasks' weights are the next ones. From these common weights, of a fixed width, every block of histories goes on with a wider
table of its own: a token belongs to the block of the pair before it, blocks hold ``BLOCK_TOKENS`` training tokens on average, so the
number of weights grows with the training tokens. Blocks are trained and applied where their tokens meet, crowded blocks in parts,
and no task holds more than one block's table. Within a class a word's probability does not depend on the history: it is its
discounted share of the class's tokens, and the discounts are the share of words never seen.

Documents are split into words twice, for the counts and for a table of codes, which all later steps read. Tokens go to the
blocks in ``TURNS`` turns, each with its share of the blocks, so that shuffle files never hold all of them.

Counts of tokens cover all training documents. The ``HEAD`` most frequent words are scored where they stand, with a table of
bounded size; every other word of every document is joined with the counts. No rare word is frequent enough to be a hot key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilspark.llm.common import BATCH_BYTES, as_bytes, byte_batches, mix, starts_of, sum_by_row
from perilspark.llm.simhash_dedup import CLEANUP
from perilspark.llm.words import WordMemo, of_worker
from perilspark.session import materialise

#: The end of a text, which no word can be.
END = b"\n"
#: Frequent words that each task holds, and bits of the feature hash.
HEAD, BITS = 131_072, 13
#: Training tokens of a block of histories on average, bits of its feature hash, and tokens that a task takes of one block.
BLOCK_TOKENS, BLOCK_BITS, PART_TOKENS = 1 << 20, 16, 1 << 21
#: A token between tasks, its rows in the table of its block and its class.
TOKEN = np.dtype([("at", "<u2", 4), ("cls", "u1")])
#: A token of a stored document: its place among the frequent words, beyond them that in the document's list of others.
CODE = np.dtype("<u4")
#: Tokens of a group of documents whose sums meet in a task.
GROUP_TOKENS = 4_000_000
#: Turns in which the blocks are dealt out, so that only a share of the tokens lies in shuffle files at a time.
TURNS = 2
#: Tokens that a task counts before it passes sums on.
COUNTED = 4_000_000
#: Parts of the training documents that are gone through in turn, tokens of a step, and its rate.
ROUNDS, STEP_TOKENS, RATE = 2, 16_384, 0.3
#: Classes: 5 levels of frequent words and one of the others, by 4 kinds of last character; and the end.
LEVELS, KINDS = 5, 4
CLASSES = (LEVELS + 1) * KINDS + 1
FEATURES = 4


def describe(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of a word and the kind of its last character: letter or digit, comma, full stop, other sign."""
    digest = xxhash.xxh64_intdigest
    kinds = [0 if (c := w[-1]) >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 1 if c == 44 else 2 if c == 46 else 3 for w in words]
    return np.array([digest(w, 42) for w in words], np.uint64).view(np.int64), np.array(kinds, np.int64)


class Corpus:
    """Hashes and kinds of the tokens of texts, each text with its end."""

    def __init__(self) -> None:
        self.memo = WordMemo(describe)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lower = [x.lower() for x in texts]
        words: list[bytes] = []
        counts = np.empty(len(texts), np.int64)
        for i, x in enumerate(lower):
            own = x.split()
            own.append(END)
            counts[i] = len(own)
            words += own
        codes, (name, kind) = self.memo.look_up(words)
        return counts, name[codes], kind[codes]


def corpus_of_worker() -> Corpus:
    """One for all tasks of a worker, so that words are described once."""
    return of_worker(Corpus)


def token_counts(rows: DataFrame) -> DataFrame:
    """``name`` (hash), ``kind`` and ``n`` of every token of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus = corpus_of_worker()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def sums() -> pa.RecordBatch:
            names, kinds = (np.concatenate(x) for x in zip(*held))
            unique, first, n = np.unique(names, return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(unique), pa.array(kinds[first].astype(np.int32)), pa.array(n)], ["name", "kind", "n"])

        for batch in batches:
            for _, texts in byte_batches(batch, "body"):
                _, names, kinds = corpus(texts)
                held.append((names, kinds))
                if sum(len(x) for x, _ in held) > COUNTED:
                    yield sums()
                    held = []
        if held:
            yield sums()

    return rows.select("body").mapInArrow(run, "name long, kind int, n long").groupBy("name").agg(F.first("kind").alias("kind"), F.sum("n").alias("n"))


class Vocabulary:
    """What every task knows: the frequent words with counts and levels, and sums of the classes."""

    def __init__(self, names: np.ndarray, counts: np.ndarray, kinds: np.ndarray, rare: dict[int, tuple[int, int]], total: int, words: int, discount: float):
        order = np.argsort(names)
        self.names, self.counts = names[order], counts[order]
        rank = np.empty(len(names), np.int64)
        rank[np.argsort(-self.counts, kind="stable")] = np.arange(len(names))
        self.total, self.words, self.discount, self.rare = total, words, discount, rare
        level = np.minimum(np.log2(rank + 1.0) / np.log2(max(len(names), 2)) * LEVELS, LEVELS - 1).astype(np.int64)
        self.end = int(describe([END])[0][0])
        self.cls = np.where(self.names == self.end, CLASSES - 1, level * KINDS + kinds[order])
        mass = np.bincount(self.cls, self.counts, CLASSES)
        self.within = np.log10(self.counts / mass[self.cls]) if len(names) else np.zeros(0)

    def find(self, names: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the frequent words, -1 for others, and class of tokens."""
        if not len(self.names):
            return np.full(len(names), -1), LEVELS * KINDS + kinds
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        hit = self.names[at] == names
        return np.where(hit, at, -1), np.where(hit, self.cls[at], LEVELS * KINDS + kinds)


def coded_batches(batch: pa.RecordBatch, vocabulary: Vocabulary) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, int]]:
    """First row and number of rows, counts, names and classes of the tokens, and the first text's hash, of consecutive parts of a batch of stored documents.

    Parts end where those of the texts do.
    """
    frequent = len(vocabulary.names)
    cuts, held = [0], 0
    for i, size in enumerate(batch.column("size").to_pylist()):
        if i > cuts[-1] and held + size > BATCH_BYTES:
            cuts.append(i)
            held = 0
        held += size
    for first, after in zip(cuts, [*cuts[1:], batch.num_rows]):
        packed = batch.column("codes").slice(first, after - first).to_pylist()
        codes = np.frombuffer(b"".join(packed), CODE).astype(np.int64)
        counts = np.array([len(x) // CODE.itemsize for x in packed], np.int64)
        lists = [batch.column(c).slice(first, len(packed)) for c in ("names", "kinds")]
        begin = starts_of(pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False))[:-1]
        other_names, other_kinds = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
        # The frequent words and the lists of the documents as one table.
        codes += np.where(codes < frequent, 0, np.repeat(begin, counts))
        names = np.concatenate([vocabulary.names, other_names]).astype(np.int64)[codes]
        classes = np.concatenate([vocabulary.cls, LEVELS * KINDS + other_kinds]).astype(np.uint8)[codes]
        yield first, len(packed), counts, names, classes, batch.column("hash")[first].as_py() & (1 << 64) - 1


def words_before(counts: np.ndarray, names: np.ndarray) -> list[np.ndarray]:
    """Words one, two and three before every token; fixed ones at a text's start."""
    place = np.arange(len(names)) - np.repeat(starts_of(counts)[:-1], counts)
    before = []
    for k in (1, 2, 3):
        x = np.full(len(names), k, np.uint64)
        x[k:] = names[:-k].view(np.uint64)
        x[place < k] = k
        before.append(x)
    return before


def pairs(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return mix(mix(one + np.uint64(2)) + two)


def hashed_words(one: np.ndarray, two: np.ndarray, three: np.ndarray) -> np.ndarray:
    return np.stack([mix(one + np.uint64(1)), pairs(one, two), mix(two + np.uint64(3)), mix(three + np.uint64(4))])


def histories(counts: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Hashed features of every token: word before, pair before, second before, third before; fixed ones at a text's start."""
    return hashed_words(*words_before(counts, names))


def rows_of(hashed: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Rows of features in a table of so many bits; those of a wider table split those of a narrower one."""
    return (hashed >> np.uint64(64 - bits)).astype(np.int64)


def blocks_of(hashed: np.ndarray, blocks: int) -> np.ndarray:
    """Block of every token, by other bits of the pair before it than those of its row."""
    return block_of_pair(hashed[1], blocks)


def block_of_pair(pair: np.ndarray, blocks: int) -> np.ndarray:
    return ((pair & np.uint64(0xFFFFFFFF)) % np.uint64(blocks)).astype(np.int64)


def widened(weights: np.ndarray) -> np.ndarray:
    """The common weights as a block's table to start from."""
    return np.concatenate([np.repeat(weights[:-1], 1 << (BLOCK_BITS - BITS), axis=0), weights[-1:]])


def dealt(batch: pa.RecordBatch, vocabulary: Vocabulary, parts: np.ndarray, turn: int) -> Iterator[pa.RecordBatch]:
    """Tokens of stored documents as one record a block of this turn, with the documents' rows.

    The first text's hash chooses the part of a crowded block and fixes the order within it.
    """
    ids = batch.column("row").to_numpy()
    for start, number, counts, names, classes, order in coded_batches(batch, vocabulary):
        one, two, three = words_before(counts, names)
        block = block_of_pair(pairs(one, two), len(parts))
        mine = np.flatnonzero(block % TURNS == turn)
        # Blocks as 16-bit numbers are sorted by radix.
        block = block[mine]
        by = np.argsort(block.astype(np.uint16) if len(parts) <= 1 << 16 else block, kind="stable")
        mine, block = mine[by], block[by]
        tokens = np.empty(len(mine), TOKEN)
        tokens["at"] = rows_of(hashed_words(one[mine], two[mine], three[mine]), BLOCK_BITS).T
        tokens["cls"] = classes[mine]
        rows = np.repeat(ids[start : start + number], counts)[mine]
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, np.int64)
        offsets = np.append(first, len(block))
        packed = [
            pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((offsets * x.itemsize).astype(np.int32).tobytes()), pa.py_buffer(x.tobytes())])
            for x in (tokens, rows)
        ]
        own = block[first]
        part = (np.uint64(order) % parts[own].astype(np.uint64)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.astype(np.int32)), pa.array(part), pa.array(np.full(len(own), order >> 1, np.int64)), *packed],
            ["block", "part", "place", "tokens", "rows"],
        )


_DEALT = "block int, part int, place long, tokens binary"
_STORED = ("row", "size", "hash", "codes", "names", "kinds")


def log_softmax(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Log probabilities of the classes (natural), a row each token."""
    logits = weights.take(features[0], axis=0)
    logits += weights[-1]
    for row in features[1:]:
        logits += weights.take(row, axis=0)
    logits -= logits.max(axis=1, keepdims=True)
    logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return logits


def steps(weights: np.ndarray, squares: np.ndarray, features: np.ndarray, classes: np.ndarray) -> None:
    """Minibatch gradient steps with per-weight rates, in place; the last row of weights is the bias."""
    for first in range(0, len(classes), STEP_TOKENS):
        part, goal = features[:, first : first + STEP_TOKENS], classes[first : first + STEP_TOKENS]
        error = np.exp(log_softmax(weights, part))
        error[np.arange(len(goal)), goal] -= 1
        error = error.astype(np.float32)
        updates = [(np.array([len(weights) - 1]), error.sum(axis=0, keepdims=True))]
        for row in part:
            order = np.argsort(row, kind="stable")
            row = row.take(order)
            start = np.concatenate([[0], np.flatnonzero(row[1:] != row[:-1]) + 1])
            updates.append((row[start], np.add.reduceat(error.take(order, axis=0), start, axis=0)))
        for at, gradient in updates:
            gradient /= np.float32(len(goal)) ** 0.5
            square = squares.take(at, axis=0)
            square += gradient**2
            squares[at] = square
            square += np.float32(1e-2)
            np.sqrt(square, out=square)
            gradient *= RATE
            gradient /= square
            weights[at] -= gradient


def train_classes(rows: DataFrame, vocabulary: Vocabulary, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Common weights of the class model: ``ROUNDS`` parts of the documents, each gone through once from the mean of the last.

    Also each block's share of the tokens.
    """
    shares = np.zeros(n_blocks)
    weights = np.zeros(((1 << BITS) + 1, CLASSES), np.float32)
    blocks = 16

    def one_round(weights: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, squares, seen = weights.copy(), np.zeros_like(weights), 0
            crowd = np.zeros(n_blocks)
            for batch in batches:
                for _, _, counts, names, classes, _ in coded_batches(batch, vocabulary):
                    hashed = histories(counts, names)
                    crowd += np.bincount(blocks_of(hashed, n_blocks), minlength=n_blocks)
                    steps(own, squares, rows_of(hashed).astype(np.uint16), classes)
                    seen += len(names)
            if seen:
                parts = [(x * np.float32(seen)).astype(np.float32).tobytes() for x in np.array_split(own, blocks)]
                parts.append(crowd.astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(range(blocks + 1), pa.int32()), pa.array([seen] * (blocks + 1), pa.int64()), pa.array(parts, pa.binary())], ["block", "seen", "weights"])

        return run

    def mean(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0.0, 0
        for batch in batches:
            for n, packed in zip(batch.column("seen").to_pylist(), batch.column("weights").to_pylist()):
                total, seen = total + np.frombuffer(packed, np.float32).astype(np.float64), seen + n
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([(total / seen).astype(np.float32).tobytes()], pa.binary())], ["block", "weights"])

    for number in range(ROUNDS):
        part = rows.where(F.pmod(F.xxhash64("id", F.lit("round")), F.lit(ROUNDS)) == number).select(*_STORED)
        sent = part.mapInArrow(one_round(weights), "block int, seen long, weights binary")
        found = sent.groupBy("block").applyInArrow(mean, "block int, weights binary").collect()
        if found:
            *means, share = (np.frombuffer(r["weights"], np.float32) for r in sorted(found, key=lambda r: r["block"]))
            weights, shares = np.concatenate(means).reshape(weights.shape), np.maximum(shares, share)
    return weights, shares


def without_shuffles(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder, whose shuffles are dropped once it is written."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        return materialise(df, name)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def train_blocks(rows: DataFrame, vocabulary: Vocabulary, weights: np.ndarray, parts: np.ndarray) -> DataFrame:
    """``block`` and its ``weights`` (half floats), trained on all tokens of the block from the common ones; means of a crowded block's parts."""

    def deal(turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for found in dealt(batch, vocabulary, parts, turn):
                    yield found.select(["block", "part", "place", "tokens"])

        return run

    def learn(key: tuple, table: pa.Table) -> pa.Table:
        # An order that does not depend on how the tokens came.
        table = table.sort_by([("place", "ascending"), ("tokens", "ascending")])
        tokens, own = np.frombuffer(b"".join(table.column("tokens").to_pylist()), TOKEN), widened(weights)
        steps(own, np.zeros_like(own), np.ascontiguousarray(tokens["at"].T), tokens["cls"])
        block = key[0].as_py()
        return pa.table({"block": pa.array([block], pa.int32()), "parts": pa.array([int(parts[block])], pa.int64()), "seen": pa.array([len(tokens)], pa.int64()), "weights": pa.array([own.astype(np.float16).tobytes()], pa.binary())})

    def mean(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0.0, 0
        for batch in batches:
            for n, packed in zip(batch.column("seen").to_pylist(), batch.column("weights")):
                total, seen = total + np.frombuffer(packed.as_buffer(), np.float16).astype(np.float64) * n, seen + n
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([(total / seen).astype(np.float16).tobytes()], pa.binary())], ["block", "weights"])

    tables = []
    for turn in range(min(TURNS, len(parts))):
        learnt = rows.select(*_STORED).mapInArrow(deal(turn), _DEALT).groupBy("block", "part").applyInArrow(learn, "block int, parts long, seen long, weights binary")
        learnt = without_shuffles(learnt, "block-weights")
        tables.append(learnt.where("parts = 1").select("block", "weights"))
        if (parts[turn::TURNS] > 1).any():
            tables.append(without_shuffles(learnt.where("parts > 1").groupBy("block").applyInArrow(mean, "block int, weights binary"), "crowded-weights"))
    return reduce(DataFrame.unionByName, tables)


def class_scores(scored: DataFrame, vocabulary: Vocabulary, blocks: DataFrame, weights: np.ndarray, parts: np.ndarray) -> DataFrame:
    """``row`` and ``model_c``, the log10 probability of its classes, of stored documents."""

    def deal(turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from dealt(batch, vocabulary, parts, turn)

        return run

    def apply(table: pa.Table, own: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("tokens", "ascending")])
        tokens, rows = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("tokens", TOKEN), ("rows", np.int64)))
        # A block without training tokens has the common weights.
        known = np.frombuffer(own.column("weights")[0].as_buffer(), np.float16).astype(np.float32).reshape(-1, CLASSES) if own.num_rows else widened(weights)
        value = np.empty(len(tokens))
        for i in range(0, len(tokens), STEP_TOKENS):
            some = tokens[i : i + STEP_TOKENS]
            value[i : i + STEP_TOKENS] = log_softmax(known, np.ascontiguousarray(some["at"].T))[np.arange(len(some)), some["cls"]]
        row, at = np.unique(rows, return_inverse=True)
        value = np.bincount(at, value, len(row)) / np.log(10)
        group = (mix(row.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
        by = np.argsort(group, kind="stable")
        cut = np.flatnonzero(np.diff(group[by], prepend=-1))
        sent = [[x[a:b].tobytes() for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(by)])] for x in (row[by], value[by])]
        return pa.table({"docs": pa.array(group[by][cut], pa.int64()), "rows": pa.array(sent[0], pa.binary()), "values": pa.array(sent[1], pa.binary())})

    def sums(key: tuple, table: pa.Table) -> pa.Table:
        # An order that does not depend on how the blocks came.
        table = table.sort_by([("rows", "ascending"), ("values", "ascending")])
        rows, values = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("rows", np.int64), ("values", np.float64)))
        row, at = np.unique(rows, return_inverse=True)
        return pa.table({"row": pa.array(row, pa.int64()), "model_c": pa.array(np.bincount(at, values, len(row)), pa.float64())})

    spark = scored.sparkSession
    tokens_of_all = scored.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    groups = max(1, -(-int(tokens_of_all) // GROUP_TOKENS))
    copies = spark.createDataFrame([(b, p) for b, n in enumerate(parts.tolist()) for p in range(n)], "block int, part int")
    sums_of_turns = []
    for turn in range(min(TURNS, len(parts))):
        # The few numbers go to the tables, so that these travel once.
        known = blocks.where(F.col("block") % TURNS == turn).join(F.broadcast(copies), "block").groupBy("block", "part")
        found = scored.select(*_STORED).mapInArrow(deal(turn), _DEALT + ", rows binary").groupBy("block", "part").cogroup(known)
        # A block's documents travel as one record a group of documents, not as a row each.
        of_turn = found.applyInArrow(apply, "docs long, rows binary, values binary").groupBy("docs").applyInArrow(sums, "row long, model_c double")
        sums_of_turns.append(without_shuffles(of_turn, "class-sums"))
    return reduce(DataFrame.unionByName, sums_of_turns).groupBy("row").agg(F.sum("model_c").alias("model_c"))


def score_documents(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every document.

    Tokens are the words between ASCII white space, A-Z lower-cased, and an end; null and empty texts are an end alone.
    Counts and the model come from the rows for which ``learn`` holds. ``base_score`` is the sum of
    log10((c + 1) / (N + V + 1)); ``score`` is the model's log10 probability of the text. Without training rows
    all tokens are unknown, and the model knows the classes as equally likely. One row for each row, repeated keys included;
    an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(key).alias("id"), as_bytes(text).alias("body"), F.coalesce(learn, F.lit(False)).alias("learn"))
    counts = without_shuffles(token_counts(rows.where("learn")), "counts")
    bins = counts.groupBy(F.floor(F.log2("n") * 16).alias("bin")).agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).collect()
    total, words = sum(r["tokens"] for r in bins), sum(r["words"] for r in bins)
    once, twice = (sum(r["words"] for r in bins if r["bin"] == b) for b in (0, 16))
    discount = once / (once + 2 * twice) if once else 0.5
    least, room = None, HEAD
    for r in sorted(bins, key=lambda r: -r["bin"]):
        room -= r["words"]
        if room < 0:
            break
        least = r["bin"]
    in_head = F.lit(False) if least is None else F.floor(F.log2("n") * 16) >= least
    head = counts.where(in_head).toPandas()
    rare = {r["kind"]: (r["n"], r["words"]) for r in counts.where(~in_head).groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()}
    vocabulary = Vocabulary(head["name"].to_numpy(np.int64), head["n"].to_numpy(np.int64), head["kind"].to_numpy(np.int64), rare, total, words, discount)
    n_blocks = max(1, -(-int(total) // BLOCK_TOKENS))
    spread = float(total + words + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus = corpus_of_worker()
        for batch in batches:
            for first, texts in byte_batches(batch, "body"):
                sizes, names, kinds = corpus(texts)
                at, _ = vocabulary.find(names, kinds)
                hit = at >= 0
                own = np.where(hit, at, 0)
                base = np.where(hit, np.log10((vocabulary.counts[own] + 1) / spread), 0) if len(vocabulary.counts) else np.zeros(len(names))
                within = np.where(hit, vocabulary.within[own], 0) if len(vocabulary.counts) else np.zeros(len(names))
                text_of = np.repeat(np.arange(len(texts)), sizes)[~hit]
                order = np.lexsort((names[~hit], text_of))
                text_of, other, kind = text_of[order], names[~hit][order], kinds[~hit][order]
                cut = np.concatenate([[0], np.flatnonzero((np.diff(text_of) != 0) | (np.diff(other) != 0)) + 1]) if len(other) else np.zeros(0, np.int64)
                times = np.diff(np.append(cut, len(other)))
                begin = starts_of(np.bincount(text_of[cut], minlength=len(texts)))
                offsets = begin.astype(np.int32)
                codes = at.astype(CODE)
                listed = np.repeat(np.arange(len(cut)), times) - begin[text_of]
                codes[np.flatnonzero(~hit)[order]] = len(vocabulary.names) + listed
                packed = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((starts_of(sizes) * CODE.itemsize).astype(np.int32).tobytes()), pa.py_buffer(codes.tobytes())])
                lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (other[cut], kind[cut].astype(np.int32), times.astype(np.int64))]
                sums = [sum_by_row(x, sizes) for x in (hit, base, within)]
                hashes = np.array([xxhash.xxh64_intdigest(x) for x in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)), pa.array([len(x) for x in texts], pa.int64()), pa.array(hashes), pa.array(sizes), pa.array(sums[0].round().astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]), packed, *lists],
                    ["id", "learn", "size", "hash", "n_tokens", "known", "base", "model", "codes", "names", "kinds", "times"],
                )

    kind = docs.schema[key].dataType.simpleString()
    scored = rows.select("id", "learn", "body").mapInArrow(
        run, f"id {kind}, learn boolean, size long, hash long, n_tokens long, known long, base double, model double, codes binary, names array<long>, kinds array<int>, times array<long>"
    )
    scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    training = scored.where("learn")
    weights, shares = train_classes(training, vocabulary, n_blocks)
    parts = np.maximum(np.ceil(shares * total / PART_TOKENS), 1).astype(np.int64)
    blocks = train_blocks(training, vocabulary, weights, parts)
    all_tokens = scored.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    parts = np.maximum(np.ceil(shares * all_tokens / PART_TOKENS), 1).astype(np.int64)
    class_sums = class_scores(scored, vocabulary, blocks, weights, parts)
    others = scored.select("row", F.explode(F.arrays_zip("names", "kinds", "times")).alias("t")).select("row", "t.names", "t.kinds", "t.times")
    others = others.join(counts.where(~in_head).select(F.col("name").alias("names"), "n"), "names", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    seen = F.lit(None).cast("double")
    unseen = F.lit(None).cast("double")
    for kind_number in range(KINDS):
        tokens, types = rare.get(kind_number, (0, 0))
        here = F.col("kinds") == kind_number
        seen = F.when(here, F.lit(float(max(tokens, 1)))).otherwise(seen)
        unseen = F.when(here, F.lit(float(discount * types / tokens if types else 1.0))).otherwise(unseen)
    model = F.when(F.col("c") > 0, F.log10((F.col("c") - discount) / seen)).otherwise(F.log10(unseen))
    sums = others.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known_o"),
        F.sum(F.col("times") * F.log10((F.col("c") + 1) / F.lit(spread))).alias("base_o"),
        F.sum(F.col("times") * model).alias("model_o"),
    )
    zero = lambda c, o: F.col(c) + F.coalesce(o, F.lit(0))
    out = scored.select("row", "id", "n_tokens", "known", "base", "model").join(sums, "row", "left").join(class_sums, "row", "left")
    return out.select(
        F.col("id").alias(key), "n_tokens", zero("known", "known_o").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        zero("base", "base_o").alias("base_score"), (zero("model", "model_o") + F.coalesce(F.col("model_c"), F.lit(0.0))).alias("score"),
    )

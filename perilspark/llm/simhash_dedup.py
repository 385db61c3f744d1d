"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two 64-bit fingerprints that differ in at most 2r bits share a variant within r bits of both. So every fingerprint
emits its whole ball of radius r (2081 variants for r = 2), fingerprints meet on equal variants, and whatever meets is
verified bit by bit. No pair within the radius is lost, and no bucket of unlike fingerprints arises.

Variants are dealt out by *cells*: a linear hash over the bits, so that the cell of ``fingerprint xor mask`` is the cell
of the fingerprint xor the code of the mask. A fingerprint travels once to each cell that holds one of its variants, and
the cell expands them: 8 bytes a cell in place of 16 a variant. The number of cells follows the number of fingerprints,
and cells are worked off in rounds of ``ROUND_CELLS``, so that a task's memory and the shuffle files on disk stay bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilspark.llm.common import as_bytes, byte_batches, components, forest, split_mix, starts_of
from perilspark.llm.words import clear_worker
from perilspark.session import materialise

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
#: Cells shuffled in one round, and variants that one cell expands at most on average.
ROUND_CELLS, CELL_VARIANTS = 256, 4_000_000


def shingle_hashes(text: bytes, words: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of the space-joined shingles of a text, repeats included; of all words if there are fewer."""
    tokens = text.lower().split()
    if not tokens:
        return []
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return [digest(joined, SEED)]
    ends, at = [], -1
    for token in tokens:
        at += len(token) + 1
        ends.append(at)
    first = [0, *[e + 1 for e in ends[:-words]]]
    return [digest(joined[a:b], SEED) for a, b in zip(first, ends[words - 1 :])]


def fold(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive runs of hashes: a bit is set if over half of the run has it; 0 for an empty run."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    starts = starts_of(counts)
    out = np.zeros((len(counts), 64), np.uint8)
    full = np.flatnonzero(counts)
    if len(full):
        sums = np.add.reduceat(bits, starts[full], axis=0, dtype=np.int32)
        out[full] = 2 * sums > counts[full, None]
    return np.packbits(out, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``bits``, the fingerprint as a signed long; texts without words have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker()
        for batch in batches:
            for first, texts in byte_batches(batch, "body"):
                hashes = [shingle_hashes(x) for x in texts]
                counts = np.array([len(x) for x in hashes], np.int64)
                bits = fold(np.array([h for x in hashes for h in x], np.uint64), counts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(bits.view("<i8"))], ["id", "bits"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("id"), as_bytes(text).alias("body")).mapInArrow(run, f"id {kind}, bits long").withColumnRenamed("id", key)


def ball_masks(radius: int) -> np.ndarray:
    """All 64-bit masks with at most ``radius`` bits."""
    return np.array([sum(1 << i for i in c) for k in range(radius + 1) for c in combinations(range(64), k)], np.uint64)


class Cells:
    """The linear hash of 64-bit values to ``2 ** width`` cells and the masks of a ball by their codes."""

    def __init__(self, width: int, radius: int):
        self.width = width
        codes = (split_mix(64, 7) >> np.uint64(64 - width)).astype(np.int64) if width else np.zeros(64, np.int64)
        table = np.zeros((8, 256), np.int64)
        for byte in range(8):
            for value in range(256):
                table[byte, value] = np.bitwise_xor.reduce(codes[[8 * byte + i for i in range(8) if value >> i & 1]]) if value else 0
        self.table = table
        masks = ball_masks(radius)
        code = self.of(masks)
        order = np.argsort(code, kind="stable")
        self.masks = masks[order]
        self.count = np.bincount(code, minlength=1 << width)
        self.start = starts_of(self.count)

    def of(self, values: np.ndarray) -> np.ndarray:
        parts = values.astype("<u8").view(np.uint8).reshape(-1, 8)
        out = self.table[0][parts[:, 0]]
        for byte in range(1, 8):
            out = out ^ self.table[byte][parts[:, byte]]
        return out

    def expand(self, values: np.ndarray, cell: int) -> tuple[np.ndarray, np.ndarray]:
        """The variants that lie in a cell, and whose they are (by position)."""
        need = self.of(values) ^ cell
        count = self.count[need]
        owner = np.repeat(np.arange(len(values)), count)
        within = np.arange(len(owner)) - np.repeat(starts_of(count)[:-1], count)
        return values[owner] ^ self.masks[self.start[need][owner] + within], owner


def meet(cells: Cells, values: np.ndarray, cell: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints that share a variant in this cell, verified, as a forest."""
    values = np.unique(values)
    variants, owner = cells.expand(values, cell)
    order = np.argsort(variants)
    variants, owner = variants[order], owner[order]
    same = np.flatnonzero(variants[1:] == variants[:-1])
    a, b = values[owner[same]], values[owner[same + 1]]
    near = (np.bitwise_count(a ^ b) <= radius) & (a != b)
    return forest(a[near].view("<i8"), b[near].view("<i8"))


@lru_cache(maxsize=4)
def cells_of(width: int, radius: int) -> Cells:
    return Cells(width, radius)


def near_links(prints: DataFrame, radius: int = RADIUS, bits: str = "bits") -> DataFrame:
    """Links (a, b) that join all distinct fingerprints within ``radius`` bits into their groups."""
    spark = prints.sparkSession
    distinct = materialise(prints.select(F.col(bits).alias("bits")).distinct(), "prints")
    half = radius // 2
    ball = len(ball_masks(half))
    width = 8
    total = distinct.count()
    while total * ball > CELL_VARIANTS << width:
        width += 1

    def deal(first: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = cells_of(width, half)
            wanted = np.flatnonzero(cells.count)
            for batch in batches:
                values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").view("<u8")
                own = cells.of(values)
                found: dict[int, np.ndarray] = {}
                if len(wanted) == 1 << width:
                    found = dict.fromkeys(range(first, first + ROUND_CELLS), values)
                else:
                    hit = own[:, None] ^ wanted
                    row, at = np.nonzero((hit >= first) & (hit < first + ROUND_CELLS))
                    goal = hit[row, at]
                    order = np.argsort(goal, kind="stable")
                    goal, sent = goal[order], values[row[order]]
                    cut = np.flatnonzero(np.diff(goal)) + 1
                    found = dict(zip(goal[np.concatenate([[0], cut])].tolist(), np.split(sent, cut))) if len(goal) else {}
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([v.tobytes() for v in found.values()], pa.binary())], ["cell", "packed"])

        return run

    def work(key: tuple, table: pa.Table) -> pa.Table:
        clear_worker()
        values = np.frombuffer(b"".join(table.column("packed").to_pylist()), "<u8")
        a, b = meet(cells_of(width, half), values, key[0].as_py(), radius)
        return pa.table({"a": a, "b": b})

    found = []
    with_cleanup = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        for first in range(0, 1 << width, ROUND_CELLS):
            dealt = distinct.mapInArrow(deal(first), "cell long, packed binary")
            found.append(materialise(dealt.groupBy("cell").applyInArrow(work, "a long, b long").distinct(), "near"))
    finally:
        spark.conf.unset(CLEANUP) if with_cleanup is None else spark.conf.set(CLEANUP, with_cleanup)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


#: Spark's own setting: a written table's shuffle files go when it is written, so that rounds don't add up on disk.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row a document: ``key``, ``bits`` (signed long) and ``component_id``, the smallest key of its group.

    Documents are linked if their fingerprints differ in at most ``radius`` bits (even), and a group is all that links
    reach. Null and empty texts and texts of white space have fingerprint 0 and are linked like others. Repeated keys
    give a row each; an empty table gives no rows; other columns are ignored.
    """
    if radius % 2:
        raise ValueError("the radius must be even: each side takes half of it")
    prints = materialise(fingerprints(docs, key, text), "fingerprints")
    roots = components(near_links(prints, radius), "groups").select(F.col("member").alias("bits"), "root")
    least = prints.groupBy("bits").agg(F.min(key).alias("least"))
    rooted = materialise(least.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    group = rooted.select("bits", "root").join(smallest, "root").select("bits", "component_id")
    return prints.join(group, "bits").select(key, "bits", "component_id")


def simhash_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The documents whose key is the smallest of their group, with all their columns."""
    kept = simhash_groups(docs.select(key, text), key, text, radius).where(F.col(key) == F.col("component_id")).select(key).distinct()
    return docs.join(kept, key, "left_semi")

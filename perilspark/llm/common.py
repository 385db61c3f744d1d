"""What the operators share: byte batches, hashing in numpy, tables between steps, linked groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilspark.session import materialise

#: Text bytes that a Python worker turns into numpy arrays at a time; a longer text is a batch of its own.
BATCH_BYTES = 2 << 20

_MASK = (1 << 64) - 1


def split_mix(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values, the same on every machine."""
    out, state = np.empty(n, np.uint64), seed & _MASK
    for i in range(n):
        state = (state + 0x9E3779B97F4A7C15) & _MASK
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK
        out[i] = z ^ (z >> 31)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit words so that every bit depends on every other."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def byte_batches(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """First row and byte strings of consecutive parts of an Arrow batch; null counts as empty."""
    values = batch.column(column)
    first, rows, size = 0, [], 0
    for i, value in enumerate(values):
        text = value.as_py() or b""
        if rows and size + len(text) > limit:
            yield first, rows
            first, rows, size = i, [], 0
        rows.append(text)
        size += len(text)
    if rows:
        yield first, rows


def as_bytes(column: Column | str) -> Column:
    """UTF-8 bytes of a text, empty for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def lower_ascii(text: bytes) -> bytes:
    """A-Z in lower case, all other bytes as they are."""
    return text.lower()


def starts_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def sum_by_row(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs; an empty run sums to 0."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) of one task as (member, smallest member of its group), without the smallest itself.

    Keeps what is linked to what and has at most one row a member.
    """
    if not len(a):
        return a, b
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    own = label != np.arange(len(ids))
    return ids[own], ids[label[own]]


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """Groups of linked ids: (member, root), root the smallest id reachable; roots themselves have no row.

    ``links`` has the columns ``a`` and ``b`` of one orderable type. Alternating large and small stars: each round
    links every node's larger, then smaller neighbours to the smallest; the number of rounds grows with the logarithm of
    a group's size. Each round is one table in the shared folder. Sums are partial before the shuffle, and a hub's
    edges meet its minimum in a join that Spark can split.
    """
    edges = (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges, before = materialise(edges, name), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == before or state["n"] == 0:
            return edges.select(F.col("a").alias("member"), F.col("b").alias("root"))
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.join(low, both.a == low.k).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        small = large.join(low, large.a == low.k).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where("a != b").unionByName(low.select(F.col("k").alias("a"), F.col("m").alias("b")))
        edges = materialise(small.distinct(), name)


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows of a table, chosen by a hash of ``key``; all rows of a smaller table."""
    total = df.count()
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1_000_000)) < int(1_000_000 * rows / total))


def crc_part(key: str, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts

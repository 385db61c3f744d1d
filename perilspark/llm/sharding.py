"""Sharding by Karmarkar-Karp differencing: byte-balanced shards of indivisible groups of equal texts.

A partial partition is a vector of shard sizes. Differencing takes the two with the largest spread and adds the large
ends of one to the small ends of the other, until one is left. It runs as a tree: groups are dealt by hash into buckets
of about ``BUCKET`` groups, each bucket is differenced to one vector, ``FAN`` vectors at a time are differenced again, and so on
to a single one. What is kept is the permutation that each vector went through, so a group's shard is looked up through the levels.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilspark.llm.common import as_bytes
from perilspark.session import materialise

#: Groups of a bucket, and vectors differenced together at the levels above.
BUCKET, FAN = 1024, 64
#: Bytes that a document has beside its text.
OVERHEAD = 16
#: Documents of one unit of numbering in a shard.
SLOT_ROWS = 512


def difference(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine vectors (one a row) by largest spread, oppositely ordered.

    Returns where each entry of each vector ends (the same shape), and the sums.
    """
    n, k = vectors.shape
    parent = np.full(2 * n - 1, -1)
    turn = np.empty((2 * n - 1, k), np.int64)
    heap = []
    for i, v in enumerate(vectors):
        order = np.argsort(-v, kind="stable")
        turn[i][order] = np.arange(k)
        v = v[order]
        heap.append((int(v[-1] - v[0]), i, v))
    heapq.heapify(heap)
    number = n
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, j, b = heapq.heappop(heap)
        total = a + b[::-1]
        order = np.argsort(-total, kind="stable")
        place = np.empty(k, np.int64)
        place[order] = np.arange(k)
        parent[i] = parent[j] = number
        # Entry p of the first goes to place[p], entry p of the second was added at k - 1 - p.
        turn[number] = place
        total = total[order]
        heapq.heappush(heap, (int(total[-1] - total[0]), number, total))
        parent[i], parent[j] = number, ~number  # the second is read backwards
        number += 1
    up = np.empty((number, k), np.int64)
    up[number - 1] = np.arange(k)
    for i in range(number - 2, -1, -1):
        to = parent[i]
        back = to < 0
        to = ~to if back else to
        places = up[to][turn[to]]
        up[i] = places[::-1] if back else places
    final = np.take_along_axis(up[:n], turn[:n], axis=1)
    return final, heap[0][2]


def _level(pairs: DataFrame, parents: str, shards: int) -> DataFrame:
    """Difference the vectors ``(parent, id, sizes)`` of each parent: rows (parent, id, places, sizes), id null for the sum."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending")])
        sizes = np.frombuffer(b"".join(table.column("sizes").to_pylist()), np.int64).reshape(-1, shards)
        places, total = difference(sizes)
        n = table.num_rows
        return pa.table({
            "parent": pa.array([key[0].as_py()] * (n + 1), pa.int64()),
            "id": pa.array([*table.column("id").to_pylist(), None], pa.int64()),
            "places": pa.array([*places.tolist(), None], pa.list_(pa.int32())),
            "sizes": pa.array([None] * n + [total.astype(np.int64).tobytes()], pa.binary()),
        })

    return pairs.groupBy(parents).applyInArrow(run, "parent long, id long, places array<int>, sizes binary")


def assign_groups(groups: DataFrame, shards: int) -> DataFrame:
    """Shard of every group: ``groups`` has ``g1``, ``g2`` (its name, two longs) and ``size``; adds ``shard``."""
    buckets = max(1, -(-groups.count() // BUCKET))
    keyed = groups.withColumn("bucket", F.pmod(F.xxhash64("g1", "g2"), F.lit(buckets)))

    def first(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("g1", "ascending"), ("g2", "ascending")])
        sizes = np.zeros((table.num_rows, shards), np.int64)
        sizes[:, 0] = table.column("size").to_numpy()
        places, total = difference(sizes)
        n = table.num_rows
        return pa.table({
            "bucket": pa.array([key[0].as_py()] * (n + 1), pa.int64()),
            "g1": pa.array([*table.column("g1").to_pylist(), None], pa.int64()),
            "g2": pa.array([*table.column("g2").to_pylist(), None], pa.int64()),
            "place": pa.array([*places[:, 0].tolist(), None], pa.int32()),
            "sizes": pa.array([None] * n + [total.astype(np.int64).tobytes()], pa.binary()),
        })

    dealt = keyed.groupBy("bucket").applyInArrow(first, "bucket long, g1 long, g2 long, place int, sizes binary")
    dealt = materialise(dealt, "buckets")
    vectors = dealt.where("sizes is not null").select(F.col("bucket").alias("id"), "sizes")
    # Where entry p of a bucket ends: from the top level down.
    levels, count = [], buckets
    while count > 1:
        level = materialise(_level(vectors.withColumn("parent", F.floor(F.col("id") / FAN)), "parent", shards), "level")
        levels.append(level.where("id is not null").select("id", "parent", "places"))
        vectors = level.where("id is null").select(F.col("parent").alias("id"), "sizes")
        count = -(-count // FAN)
    final = None
    for level in reversed(levels):
        if final is None:
            final = level.select("id", "places")
        else:
            above = final.select(F.col("id").alias("parent"), F.col("places").alias("above"))
            final = level.join(above, "parent").select("id", F.transform("places", lambda p: F.element_at("above", p + 1)).alias("places"))
    placed = dealt.where("place is not null").select("bucket", "g1", "g2", "place")
    if final is None:
        return placed.select("g1", "g2", F.col("place").alias("shard"))
    final = materialise(final, "places")
    return placed.join(final.withColumnRenamed("id", "bucket"), "bucket").select("g1", "g2", F.element_at("places", F.col("place") + 1).alias("shard"))


def shard_documents(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every document; shards are near equal in bytes.

    A document's size is its text's UTF-8 bytes (null: none) plus 16. Documents of equal texts are one group and stay
    together, null texts with empty ones; a group larger than a shard's share makes its shard that large. Slots number a
    shard's documents from 0 without gaps. One row for each row, repeated keys included; an empty table gives no rows; other
    columns are ignored.
    """
    body = as_bytes(text)
    rows = docs.select(
        F.col(key).alias("id"), (F.octet_length(body) + OVERHEAD).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("g1"), F.xxhash64(F.lit(1), F.octet_length(body), body).alias("g2"),
    )
    rows = materialise(rows, "sizes")
    shard_of = assign_groups(rows.groupBy("g1", "g2").agg(F.sum("size").alias("size")), shards)
    chunks = max(1, -(-rows.count() // (shards * SLOT_ROWS)))
    chunk = F.pmod(F.xxhash64("id", "g1", "size"), F.lit(chunks))
    placed = materialise(rows.join(shard_of, ["g1", "g2"]).select("id", "size", "text_crc32", "shard", chunk.alias("chunk")), "placed")
    return number_slots(placed).withColumnRenamed("id", key)


def number_slots(placed: DataFrame) -> DataFrame:
    """Gapless numbers within each shard: ranks within (shard, chunk) plus what lies in the chunks before.

    A group of equal texts is one shard's and may be large; its rows share chunks with others by their ids, salted by row.
    """
    from pyspark.sql import Window

    counts = placed.groupBy("shard", "chunk").count()
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    inside = Window.partitionBy("shard", "chunk").orderBy("id", "text_crc32", "size")
    ranked = placed.withColumn("rank", F.row_number().over(inside) - 1)
    return ranked.join(materialise(counts, "chunks"), ["shard", "chunk"]).select(
        "id", "size", "text_crc32", F.col("shard").cast("int"), (F.col("before") + F.col("rank")).cast("long").alias("slot")
    )

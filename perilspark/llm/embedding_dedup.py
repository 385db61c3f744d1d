"""Embedding near-dedup by a subspace pigeonhole join.

For unit vectors, cosine >= c means squared distance <= 2 - 2c. Rotated vectors are split into m blocks of few
dimensions; since the blocks' squared distances add up, at least one block of a linked pair is within its share of the
budget, (2 - 2c) / m. So a range join of every block under that share yields all links among its candidates, and the
candidates are verified exactly, in double precision.

The range join of a block deals vectors to tiles, cubes of the block's space ``TILE`` radii wide: a vector goes to every tile
within half a radius of it, and a pair meets in the tile that holds its midpoint. A tile of over ``PART_ROWS`` vectors is
split into parts, and every two of its parts are one unit of work, so a dense spot never lies in one task. Equal vectors of
a label collapse to one row with a weight first. A link counts once: in the first block within its share and in the tile of
the midpoint; rotated coordinates are sums in a fixed order, so every task gets the same bits for them. Tasks return sums
and forests, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilspark.llm.common import components, forest, mix, starts_of
from perilspark.session import materialise

COSINE = 0.98
#: Dimensions of a block, and width of a tile in radii.
BLOCK, TILE = 4, 4.0
#: Vectors of a tile that are compared as one unit of work, and rows compared at a time.
PART_ROWS, STRIP = 4096, 512
#: Slack on distances, far above rounding and far below any margin that matters; candidates are verified anyway.
SLACK = 1e-9


@lru_cache(maxsize=4)
def rotation(size: int) -> np.ndarray:
    """A fixed random rotation, padded so that blocks are full."""
    q, r = np.linalg.qr(np.random.default_rng(20).standard_normal((size, size)))
    wide = -(-size // BLOCK) * BLOCK
    out = np.zeros((size, wide))
    out[:, :size] = q * np.sign(np.diag(r))
    return np.round(out, 12)  # one matrix on every machine, whatever its linear algebra library does in the last bits


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def rotate(units: np.ndarray) -> np.ndarray:
    """Rotated coordinates, summed in a fixed order: a vector's bits don't depend on its neighbours in the array."""
    turn = rotation(units.shape[1])
    out = units[:, :1] * turn[0]
    for k in range(1, units.shape[1]):
        out = out + units[:, k : k + 1] * turn[k]
    return out


def tile_keys(label: np.ndarray, block: np.ndarray | int, cube: np.ndarray) -> np.ndarray:
    """One 64-bit key for (label, block, cube); equal keys of unlike tiles only mean candidates that fail."""
    key = mix(np.asarray(label, np.int64).view(np.uint64) * np.uint64(1 << 20) + np.asarray(block, np.uint64) + np.uint64(1))
    for d in range(cube.shape[1]):
        key = mix(key ^ cube[:, d].astype(np.int64).view(np.uint64))
    return key.view(np.int64)


def deal(label: np.ndarray, turned: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, block, key) for every tile within half a radius of a vector's block coordinates."""
    rows, blocks, keys = [], [], []
    width, reach = TILE * radius, radius / 2 * (1 + 1e-6) + SLACK
    for block in range(turned.shape[1] // BLOCK):
        part = turned[:, block * BLOCK : (block + 1) * BLOCK]
        low, high = np.floor((part - reach) / width), np.floor((part + reach) / width)
        seen = []
        for corner in range(1 << BLOCK):
            side = np.array([corner >> d & 1 for d in range(BLOCK)], bool)
            cube = np.where(side, high, low)
            gap = np.maximum(np.maximum(cube * width - part, part - (cube + 1) * width), 0)
            ok = ((gap**2).sum(axis=1) <= reach**2) & ~(side & (high == low)).any(axis=1)
            at = np.flatnonzero(ok)
            seen.append((at, tile_keys(label[at], block, cube[at])))
        at = np.concatenate([x for x, _ in seen])
        rows.append(at)
        blocks.append(np.full(len(at), block, np.int32))
        keys.append(np.concatenate([x for _, x in seen]))
    return np.concatenate(rows), np.concatenate(blocks), np.concatenate(keys)


def compare(block: int, key: int, label: int, vectors: np.ndarray, part: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (by position) that count in this tile; with two parts, only pairs across them."""
    units = unit(vectors)
    turned = rotate(units)
    blocks = turned.shape[1] // BLOCK
    share = (2 - 2 * cosine) / blocks + SLACK
    width = TILE * np.sqrt((2 - 2 * cosine) / blocks)
    own = turned[:, block * BLOCK : (block + 1) * BLOCK]
    square = (own**2).sum(axis=1)
    across = len(np.unique(part)) > 1
    found = [[], []]
    for first in range(0, len(own), STRIP):
        last = min(first + STRIP, len(own))
        near = square[first:last, None] + square[first:] - 2 * own[first:last] @ own[first:].T <= share + 1e-7
        a, b = np.nonzero(near)
        a, b = a + first, b + first
        ok = a < b
        if across:
            ok &= part[a] != part[b]
        a, b = a[ok], b[ok]
        for at in range(0, len(a), 100_000):
            u, v = a[at : at + 100_000], b[at : at + 100_000]
            ok = np.einsum("ij,ij->i", units[u], units[v]) >= cosine
            u, v = u[ok], v[ok]
            apart = ((turned[u] - turned[v]) ** 2).reshape(len(u), blocks, BLOCK)
            apart = apart[:, :, 0] + apart[:, :, 1] + apart[:, :, 2] + apart[:, :, 3]
            ok = np.argmax(apart <= share, axis=1) == block
            u, v = u[ok], v[ok]
            middle = np.floor((own[u] + own[v]) / 2 / width)
            ok = tile_keys(np.full(len(u), label), block, middle) == key
            found[0].append(u[ok])
            found[1].append(v[ok])
    return np.concatenate([*found[0], np.empty(0, np.int64)]), np.concatenate([*found[1], np.empty(0, np.int64)])


def embedding_groups(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE
) -> DataFrame:
    """One row a vector: ``key``, ``n_links``, ``component_id`` and ``kept`` (it is the smallest key of its group).

    Vectors link if their labels are equal and not null and their cosine in double precision is at least ``cosine``.
    A vector that is null, empty, zero or holds null, NaN or an infinite component, or whose label is null, links with
    nothing; it is a group of its own. Vectors of unlike lengths never link. Equal vectors are linked and count each
    other. An empty table gives no rows; other columns are ignored; keys are taken to be unique.
    """
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("group"), F.col(vector).cast("array<double>").alias("vec")
    )
    good = (
        F.col("group").isNotNull()
        & F.coalesce(F.size("vec") > 0, F.lit(False))
        & F.coalesce(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False))
    )
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    # Equal vectors are found by two 64-bit hashes; -0.0 and 0.0 are one number.
    vec = F.transform("vec", lambda x: x + F.lit(0.0))
    named = rows.select("id", "group", "good", "vec", F.xxhash64("group", vec).alias("h1"), F.xxhash64(F.lit(1), vec, "group").alias("h2"))
    named = materialise(named, "vectors")
    distinct = named.where("good").groupBy("group", "h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    packed = named.where("good").select(F.col("id").alias("rep"), "group", "vec").join(distinct.select("rep", "weight"), "rep")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, group, weight = (batch.column(c).to_numpy() for c in ("rep", "group", "weight"))
            column = batch.column("vec")
            sizes = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy()
            begin = starts_of(sizes)
            for size in np.unique(sizes):
                mine = np.flatnonzero(sizes == size)
                for first in range(0, len(mine), 2000):
                    some = mine[first : first + 2000]
                    vecs = flat[begin[some][:, None] + np.arange(size)]
                    vecs = vecs / np.abs(vecs).max(axis=1)[:, None]  # no overflow in the squares
                    turned = rotate(unit(vecs))
                    radius = np.sqrt((2 - 2 * cosine) / (turned.shape[1] // BLOCK))
                    at, block, tile = deal(group[some], turned, radius)
                    sent = [x.tobytes() for x in vecs]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tile), pa.array(block), pa.array(group[some][at]), pa.array(rep[some][at]), pa.array(weight[some][at]), pa.array([sent[i] for i in at], pa.binary())],
                        ["tile", "block", "group", "rep", "weight", "vec"],
                    )

    dealt = packed.mapInArrow(place, "tile long, block int, group long, rep long, weight long, vec binary")
    crowded = dealt.groupBy("tile").count().where(F.col("count") > PART_ROWS)
    crowded = materialise(crowded.select("tile", F.ceil(F.col("count") / PART_ROWS).cast("int").alias("parts")), "crowded")
    units = dealt.join(crowded, "tile", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    units = units.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts").cast("long")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    units = units.select("tile", "block", "group", "rep", "weight", "vec", "part", other.alias("other"))
    units = units.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")).drop("other")
    units = units.repartition("tile", "low", "high").sortWithinPartitions("tile", "low", "high")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups of rows of one (tile, low, high), which lie together; a group may span batches."""
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("tile", "low", "high")])
            cut = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1
            cut = [0, *cut.tolist(), batch.num_rows]
            for a, b in zip(cut, cut[1:]):
                name = tuple(names[:, a].tolist())
                if held and name != last:
                    yield from one(held)
                    held = []
                held.append(batch.slice(a, b - a))
                last = name
        if held:
            yield from one(held)

    def one(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        if table.num_rows < 2:
            return
        tile, block, group, rep, weight, part = (table.column(c).to_numpy() for c in ("tile", "block", "group", "rep", "weight", "part"))
        sent = table.column("vec").to_pylist()
        sizes = np.array([len(x) for x in sent])
        for size, number, name in {*zip(sizes.tolist(), block.tolist(), group.tolist())}:
            mine = np.flatnonzero((sizes == size) & (block == number) & (group == name))
            vecs = np.frombuffer(b"".join([sent[i] for i in mine]), np.float64).reshape(len(mine), -1)
            u, v = compare(number, int(tile[0]), name, vecs, part[mine], cosine)
            if not len(u):
                continue
            u, v = mine[u], mine[v]
            n = np.bincount(u, weight[v], len(rep)) + np.bincount(v, weight[u], len(rep))
            with_links = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(rep[with_links]), pa.array(n[with_links].astype(np.int64)), pa.nulls(len(with_links), pa.int64())], ["rep", "n", "root"])
            member, root = forest(rep[u], rep[v])
            yield pa.RecordBatch.from_arrays([pa.array(member), pa.nulls(len(member), pa.int64()), pa.array(root)], ["rep", "n", "root"])

    found = materialise(units.mapInArrow(work, "rep long, n long, root long"), "links")
    roots = components(found.where("root is not null").select(F.col("rep").alias("a"), F.col("root").alias("b")), "vector-groups")
    counts = found.where("n is not null").groupBy("rep").agg(F.sum("n").alias("n"))
    classes = (
        distinct.join(counts, "rep", "left")
        .join(roots.withColumnRenamed("member", "rep"), "rep", "left")
        .select("group", "h1", "h2", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    )
    result = named.where("good").join(classes, ["group", "h1", "h2"]).select("id", "n_links", F.col("root").alias("component_id"))
    alone = named.where(~F.col("good")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return result.unionByName(alone).select(F.col("id").alias(key), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))

"""Ranked lexical search: the best documents for each item, exact, by sparse ball trees.

A document is a sparse vector over the terms of the items: how much an occurrence counts in it. An item is the sparse
vector of its terms' weights, and a score is their inner product in whole numbers. Tasks gather documents into shards
and build a tree of balls over each; an item visits a shard's subtrees in the order of the most that any document
in them can score (inner product with the centre, plus norm times radius), and stops where that falls below the k-th
score known. Bounds are rounded up, leaves are scored in integers, so nothing is lost.

A first search of a part of the documents only gives each item a score and id that k documents reach; the search of all
documents starts from there, so what tasks return hardly grows with the number of shards.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perilspark.llm.common import as_bytes, byte_batches, starts_of
from perilspark.session import materialise

#: Documents and entries of a shard at most, documents of a leaf at most.
SHARD_DOCS = 8192
SHARD_ENTRIES = 2_000_000
LEAF_DOCS = 32

#: One document in so many is searched first, to know scores that k documents reach.
FIRST = 16

#: Terms of the items that are searched in one pass; more items take more passes.
BLOCK_TERMS = 500_000

#: Bounds are raised by this share, far above the rounding errors of sums of doubles.
SLACK = 1e-9

_BLANK = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII; only A-Z lower-cased."""
    return text.lower().translate(_BLANK).split()


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def vectors(docs: DataFrame, key: str, text: str, vocabulary: list[bytes]) -> DataFrame:
    """(key, n, terms, counts) of documents with a term: all their terms counted, those of the vocabulary by place."""
    place = {t: i for i, t in enumerate(vocabulary)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in byte_batches(batch, "text"):
                words = [terms_of(x) for x in texts]
                n = np.array([len(x) for x in words], np.int64)
                found = np.fromiter(map(place.get, chain.from_iterable(words), repeat(-1)), np.int64, n.sum())
                row = np.repeat(np.arange(len(n)), n)[found >= 0]
                entry, counts = np.unique(row * len(place) + found[found >= 0], return_counts=True)
                row, term = (entry // len(place), entry % len(place)) if place else (entry, entry)
                ends = pa.array(starts_of(np.bincount(row, minlength=len(n))), pa.int32())
                out = pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(first, len(texts)), pa.array(n), pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))], names=["key", "n", "terms", "counts"])
                yield out.filter(pa.array(n > 0))

    rows = docs.select(F.col(key).cast("long").alias("key"), as_bytes(text).alias("text"))
    return rows.mapInArrow(count, "key long, n long, terms array<int>, counts array<long>")


def length_norm(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    if len(n) and int(n.max()) * 50 * documents >= 1 << 63:
        return np.array([50 + 50 * int(x) * documents // total for x in n], np.int64)
    return 50 + 50 * n * documents // total


class Shard:
    """Documents of a task as a tree of balls.

    The geometry is that of impacts times the root of the term's weight, the item's vector holds the other root. A node is
    split at the median of the documents' place between two far ones, so the tree is balanced however many are alike.
    """

    def __init__(self, keys, absent, lengths, terms, impacts, weights, leaf: int = LEAF_DOCS):
        order = np.lexsort((keys, absent))  # the place in this order decides between equal scores
        self.keys, self.absent = keys[order], absent[order]
        self.terms, local = np.unique(terms, return_inverse=True)
        self.weights = weights[self.terms]
        self.root = np.sqrt(self.weights.astype(np.float64))
        self.point = self.root[local] * impacts
        self.local, self.impacts = local, impacts
        self.start, self.size = starts_of(lengths)[:-1][order], lengths[order]
        self.norm = np.add.reduceat(self.point**2, starts_of(lengths)[:-1])[order]
        self._build(leaf)
        # Entries in the order of the leaves, so that a leaf is one slice.
        at = self._entries(self.order)
        self.local, self.impacts = self.local[at], self.impacts[at]
        self.begin = starts_of(self.size[self.order])

    def _entries(self, docs: np.ndarray) -> np.ndarray:
        size = self.size[docs]
        return np.arange(size.sum()) + np.repeat(self.start[docs] - starts_of(size)[:-1], size)

    def _build(self, leaf: int) -> None:
        self.order = np.arange(len(self.keys))
        self.low, self.high, self.child, self.radius = [], [], [], []
        node_terms, node_centres, waiting = [], [], [(0, len(self.keys), -1)]
        while waiting:
            low, high, parent = waiting.pop()
            if parent >= 0:
                self.child[parent].append(len(self.low))
            docs = self.order[low:high]
            at, size = self._entries(docs), self.size[docs]
            terms, points, first = self.local[at], self.point[at], starts_of(size)[:-1]
            centre = np.bincount(terms, points, len(self.terms)) / len(docs)

            def inner(vector):
                return np.add.reduceat(vector[terms] * points, first)

            square = centre @ centre
            apart = self.norm[docs] - 2 * inner(centre) + square
            error = SLACK * (self.norm[docs] + square)
            self.radius.append(math.sqrt((np.maximum(apart, 0) + error).max()))
            self.low.append(low)
            self.high.append(high)
            self.child.append([])
            here = np.flatnonzero(centre)
            node_terms.append(here)
            node_centres.append(centre[here])
            if high - low <= leaf:
                continue

            def vector(i):
                out = np.zeros(len(self.terms))
                own = slice(first[i], first[i] + size[i])
                out[terms[own]] = points[own]
                return out

            one = vector(int(apart.argmax()))
            from_one = self.norm[docs] - 2 * inner(one)
            other = vector(int(from_one.argmax()))
            middle = (high - low) // 2
            side = np.argpartition(inner(one - other), middle)
            self.order[low:high] = docs[side]
            waiting += [(low + middle, high, len(self.low) - 1), (low, low + middle, len(self.low) - 1)]
        self.radius = np.array(self.radius)
        # Centres by term.
        term, nodes = np.concatenate(node_terms), np.repeat(np.arange(len(node_terms)), [len(x) for x in node_terms])
        by = np.argsort(term, kind="stable")
        self.by_node, self.by_value = nodes[by], np.concatenate(node_centres)[by]
        self.by_start = np.searchsorted(term[by], np.arange(len(self.terms) + 1))

    def bounds(self, terms: np.ndarray) -> np.ndarray:
        """Most that a document of each node can score. Only terms that a node holds count for the norm."""
        size = self.by_start[terms + 1] - self.by_start[terms]
        at = np.arange(size.sum()) + np.repeat(self.by_start[terms] - starts_of(size)[:-1], size)
        nodes, weight, root = self.by_node[at], np.repeat(self.weights[terms], size), np.repeat(self.root[terms], size)
        n = len(self.radius)
        most = np.bincount(nodes, root * self.by_value[at], n) + np.sqrt(np.bincount(nodes, weight, n)) * self.radius
        return np.floor(most * (1 + SLACK)) + 1

    def best(self, item: np.ndarray, k: int, score: int, absent: bool, key: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best for an item (terms by place in the vocabulary), best first.

        Only scores above 0 that also reach the given score and key count.
        """
        terms = np.searchsorted(self.terms, item)
        terms = terms[terms < len(self.terms)]
        terms = terms[np.isin(self.terms[terms], item)]
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(terms):
            return docs, scores
        # Documents up to this place of the order may equal the given score.
        last = np.searchsorted(self.absent, absent, "right") if absent else 0
        alike = slice(*np.searchsorted(self.absent, [absent, absent + 1]))
        last = alike.start + np.searchsorted(self.keys[alike], key, "right")
        most, weight = self.bounds(terms), np.zeros(len(self.terms), np.int64)
        weight[terms] = self.weights[terms]
        least = max(score, 1)
        heap = [(-most[0], 0)]
        heapify(heap)
        while heap and -heap[0][0] >= least:
            bound, node = heappop(heap)
            for child in self.child[node]:
                if most[child] >= least:
                    heappush(heap, (max(bound, -most[child]), child))
            if self.child[node]:
                continue
            low, high = self.low[node], self.high[node]
            at = slice(self.begin[low], self.begin[high])
            found = np.add.reduceat(weight[self.local[at]] * self.impacts[at], self.begin[low:high] - self.begin[low])
            own = self.order[low:high]
            kept = (found >= least) & ((found > score) | (own < last))
            if kept.any():
                docs, scores = np.concatenate([docs, own[kept]]), np.concatenate([scores, found[kept]])
                first = np.lexsort((docs, -scores))[:k]
                docs, scores = docs[first], scores[first]
                if len(docs) == k:
                    least = max(least, int(scores[-1]))
        return docs, scores


RESULT = "query int, item_id long, doc_id long, score long"
_RESULT = pa.schema([("query", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def searched(rows: DataFrame, items: list[tuple[int | None, np.ndarray]], weights: np.ndarray, documents: int, total: int, k: int, known: dict) -> DataFrame:
    """The k best documents of every shard for every item; ``known`` has a score and key that k documents reach."""

    def search(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        column = {c: table.column(c).combine_chunks() for c in ("key", "n", "terms", "counts")}
        lengths = np.diff(column["terms"].offsets.to_numpy()).astype(np.int64)
        terms = column["terms"].flatten().to_numpy().astype(np.int64)
        counts = column["counts"].flatten().to_numpy()
        norm = np.repeat(length_norm(column["n"].to_numpy(), documents, total), lengths)
        impacts = 1_000_000_000 * counts // (1000 * counts + 20 * norm)
        keys = column["key"].fill_null(0).to_numpy()
        shard = Shard(keys, column["key"].is_null().to_numpy(zero_copy_only=False), lengths, terms, impacts, weights)
        found = []
        for i, (_, item) in enumerate(items):
            docs, scores = shard.best(item, k, *known.get(i, (0, False, 0)))
            found.append((np.full(len(docs), i), docs, scores))
        query, docs, scores = (np.concatenate([f[j] for f in found]) for j in range(3))
        if len(docs):
            ids = pa.array([items[i][0] for i in query], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), ids, pa.array(shard.keys[docs], mask=shard.absent[docs]), pa.array(scores)], schema=_RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, docs, entries = [], 0, 0
        for batch in batches:
            lengths = starts_of(np.diff(batch.column("terms").offsets.to_numpy()))
            at = 0
            while at < batch.num_rows:
                # As many rows as the shard still takes, one at least.
                fit = np.searchsorted(lengths, lengths[at] + SHARD_ENTRIES - entries, "right") - 1 - at
                rows_ = int(min(batch.num_rows - at, SHARD_DOCS - docs, max(fit, 0 if parts else 1)))
                if rows_:
                    parts.append(batch.slice(at, rows_))
                    docs, entries, at = docs + rows_, entries + int(lengths[at + rows_] - lengths[at]), at + rows_
                if at < batch.num_rows:
                    yield from search(parts)
                    parts, docs, entries = [], 0, 0
        if parts:
            yield from search(parts)

    return rows.where(F.size("terms") > 0).select("key", "n", "terms", "counts").mapInArrow(run, RESULT)


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    first: int = FIRST, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The k documents of highest score for each item: item, rank (from 1), key, score. Only scores above 0 count.

    With N documents that hold a term, L terms in them, n in one: a term held by df of them weighs
    ``floor(1000 ln((2N+2)/(2df+1)))``, ``tf`` occurrences count ``10^9 tf div (1000 tf + 20 m)`` with
    ``m = 50 + 50 n N div L``, and the products are summed over the item's terms, each once.

    Equal scores rank by ascending key, null keys last. Null and empty texts hold no term. A repeated row is a document,
    and a repeated item an item, of its own: rows of the same item id each have their own ranks from 1. Very long texts
    count whole. A task holds one shard, a batch of texts and the terms of a block of items, whatever the tables' size;
    the items, in blocks, are the only thing that the driver and all tasks hold. Other columns are not read. An empty
    table of either gives an empty result.
    """
    asked = items.select(F.col(item).cast("long").alias("id"), as_bytes(item_text).alias("text"))
    n_terms = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-n_terms // (8 * block_terms)))
    parts = asked.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    results = []
    for b in range(blocks):
        block = [(r["id"], sorted(set(terms_of(bytes(r["text"]))))) for r in parts.where(F.col("block") == b).select("id", "text").collect()]
        vocabulary = sorted(set(chain.from_iterable(t for _, t in block)))
        place = {t: i for i, t in enumerate(vocabulary)}
        asked_for = [(i, np.array([place[t] for t in terms], np.int64)) for i, terms in block]
        rows = materialise(vectors(docs, key, text, vocabulary), "search-vectors")
        size = rows.agg(F.count("*").alias("documents"), F.sum("n").alias("total")).first()
        held = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
        weights = np.zeros(len(vocabulary), np.int64)
        for r in held:
            weights[r["term"]] = term_weight(size["documents"], r["df"])
        arguments = (asked_for, weights, size["documents"], size["total"] or 1, k)
        part = rows.where(F.pmod(F.xxhash64("key", "n", "terms"), F.lit(first)) == 0)
        reached = ranks(searched(part, *arguments, {})).where(F.col("rank") == k).collect()
        known = {r["query"]: (r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in reached}
        results.append(materialise(ranks(searched(rows, *arguments, known)).where(F.col("rank") <= k), "search-ranks"))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select(F.col("item_id").alias(item), "rank", F.col("doc_id").alias(key), "score")


def ranks(found: DataFrame) -> DataFrame:
    """With the rank of each document for its item; Spark keeps the first of each task before it shuffles."""
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order))


#: Twin of the query on the tables ``documents`` and ``benchmark``.
SQL = """
    with words as (
        select rowid as r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
        from (select row_number() over () as rowid, * from documents)),
    sizes as (select r, count(*) as n from words group by r),
    whole as (select count(*) as docs, cast(sum(n) as bigint) as total from sizes),
    asked as (
        select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
        from benchmark),
    counted as (
        select r, doc_id, term, count(*) as tf from words where term in (select term from asked) group by all),
    weighed as (
        select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w from counted, whole group by term, docs),
    scored as (
        select item_id, c.doc_id, c.r, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total)))) as bigint) as score
        from counted c join sizes using (r) join weighed using (term) join asked using (term), whole group by all),
    ranked as (
        select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score
        from scored where score > 0)
    select * from ranked where rank <= 50"""

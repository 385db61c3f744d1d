"""Ranked search against scoring every pair; the tree against a plain inner product."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from perilspark.llm import ranked_search
from perilspark.llm.ranked_search import Shard, length_norm, ranked_search as search, terms_of

RNG = np.random.default_rng(11)
WORDS = ["".join(RNG.choice(list("abcde"), RNG.integers(1, 4))) for _ in range(60)] + ["Été", "漢字", "x1", "3"]


def prose(n: int) -> str:
    return ", ".join(RNG.choice(WORDS, n))


COPY = prose(12)
DOCS = [prose(int(n)) for n in RNG.integers(0, 60, 150)] + [COPY] * 40 + [None, "", "?!", prose(5000), "É é X-x"]
ITEMS = [prose(int(n)) for n in RNG.integers(1, 15, 12)] + [COPY, COPY, "", None, "unknownword", "x X é", "a"]
DOC_SCHEMA, ITEM_SCHEMA = "doc_id long, text string, n string, terms string, rank string", "item_id long, text string, score string"


def brute(docs, items, k):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(key, Counter(words(t))) for key, t in docs]
    held = [(key, c, sum(c.values())) for key, c in held if c]
    n_docs, total = len(held), sum(n for *_, n in held)
    out = []
    for item, text in items:
        scores = []
        for key, counts, n in held:
            m = 100 - 50 + (50 * n * n_docs) // total
            score = 0
            for term in set(words(text)):
                if tf := counts[term]:
                    df = sum(term in c for _, c, _ in held)
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, i + 1, key, -score) for i, (score, _, _, key) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def tables(spark):
    # Ids out of order, one null, one repeated row, one repeated item id.
    docs = [(i * 7 % len(DOCS), t) for i, t in enumerate(DOCS)] + [(None, COPY), (3, "aa bb"), (3, "aa bb")]
    items = [*enumerate(ITEMS), (2, "b c"), (None, COPY)]
    return (
        docs, items, spark.createDataFrame([(i, t, "n", "t", "r") for i, t in docs], DOC_SCHEMA).repartition(5),
        spark.createDataFrame([(i, t, "s") for i, t in items], ITEM_SCHEMA),
    )


@pytest.mark.parametrize("k,first,block_terms", [(5, 16, 500_000), (300, 1, 500_000), (7, 3, 4)])
def test_search(tables, k, first, block_terms):
    docs, items, d, q = tables
    assert rows(search(d, q, k, first=first, block_terms=block_terms)) == brute(docs, items, k)


def test_small_shards(tables, monkeypatch):
    docs, items, d, q = tables
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 11)
    monkeypatch.setattr(ranked_search, "SHARD_ENTRIES", 70)
    assert rows(search(d, q, 6)) == brute(docs, items, 6)


def test_empty_tables(tables):
    _, _, d, q = tables
    assert rows(search(d.where("false"), q)) == []
    assert rows(search(d, q.where("false"))) == []


def test_terms():
    assert terms_of("It's É_a-1 b\x7fC".encode()) == ["it".encode(), b"s", "É".encode(), "a".encode(), "1 b".encode(), b"c"]


def test_length_norm_beyond_64_bits():
    n = np.array([1, 10**8], np.int64)
    assert length_norm(n, 10**11, 10**13).tolist() == [50 + 50 * 10**11 // 10**13, 50 + 50 * 10**19 // 10**13]


@pytest.mark.parametrize("seed", range(6))
def test_tree_loses_nothing(seed):
    rng = np.random.default_rng(seed)
    n, vocabulary = 400, 50
    held = [np.sort(rng.choice(vocabulary, rng.integers(1, 12), replace=False)) for _ in range(n)]
    for i in range(0, n, 3):
        held[i] = held[0]  # a third are alike
    lengths, terms = np.array([len(x) for x in held]), np.concatenate(held)
    impacts = rng.integers(1, 10**6, len(terms))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    for i in range(0, n, 3):
        impacts[starts[i] : starts[i + 1]] = impacts[starts[0] : starts[1]]
    weights = rng.integers(0, 9000, vocabulary)
    keys, absent = rng.permutation(n), np.zeros(n, bool)
    absent[rng.integers(0, n, 3)] = True
    dense = np.zeros((n, vocabulary), np.int64)
    dense[np.repeat(np.arange(n), lengths), terms] = impacts
    shard = Shard(keys, absent, lengths, terms, impacts, weights, leaf=8)
    order = np.lexsort((keys, absent))
    for _ in range(20):
        item = np.sort(rng.choice(vocabulary, rng.integers(1, 9), replace=False))
        score = (dense[:, item] @ weights[item])[order]
        want = [p for p in np.lexsort((np.arange(n), -score)) if score[p] > 0]
        docs, scores = shard.best(item, 10, 0, False, 0)
        assert docs.tolist() == want[:10] and scores.tolist() == score[want[:10]].tolist()
        # A known score and key leave out what is worse, and only that.
        if len(want) > 5 and not shard.absent[want[4]]:
            docs, _ = shard.best(item, 10, int(score[want[4]]), False, int(shard.keys[want[4]]))
            assert docs.tolist() == want[:5]
        # Every subtree's bound holds.
        most = shard.bounds(np.searchsorted(shard.terms, np.intersect1d(item, shard.terms))) if len(np.intersect1d(item, shard.terms)) else None
        for low, high, bound in zip(shard.low, shard.high, [] if most is None else most):
            assert score[shard.order[low:high]].max() <= bound

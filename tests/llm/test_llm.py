"""The operators against brute force on small tables, with nulls, empty and long texts, repeated rows and empty tables."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from perilspark.llm.common import components, crc_part
from perilspark.llm.decontamination import contaminated, decontaminate
from perilspark.llm.embedding_dedup import embedding_groups
from perilspark.llm.lm_score import END, score_documents
from perilspark.llm.packing import WINDOW, pack_documents
from perilspark.llm.quality import score_quality
from perilspark.llm.sharding import difference, shard_documents
from perilspark.llm.simhash_dedup import simhash_dedup, simhash_groups
from perilspark.llm.suffix_dedup import suffix_array, suffix_dedup
from perilspark.llm.toxicity import folded, score_toxicity
from perilspark.llm.url_filter import judge_urls

RNG = np.random.default_rng(3)
WORDS = ["".join(RNG.choice(list("abcdefghijklmno"), RNG.integers(2, 9))) for _ in range(400)]


def prose(n: int) -> str:
    return " ".join(RNG.choice(WORDS, n))


PASSAGE = prose(70)
BASE = [prose(int(n)) for n in RNG.integers(5, 120, 25)]
# Nulls, empty and white texts, repeated rows, an exact and a near copy, shared and inner repeats, one long text.
TEXTS = [*BASE, BASE[0], BASE[1] + " tail", None, None, "", " \n\t ", PASSAGE, "x " + PASSAGE + " y", "é" * 500, "ab " * 300, prose(9000), "Word"]
DOCS = [(i, t, f"n{i}", "s") for i, t in enumerate(TEXTS)]
SCHEMA = "doc_id long, text string, n_bytes string, row string"


@pytest.fixture(scope="module")
def docs(spark):
    """With extra columns whose names the operators use themselves."""
    return spark.createDataFrame(DOCS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def roots(n: int, linked) -> list[int]:
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(n)]


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    found = {r["member"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 150)}}


def test_simhash_groups(docs, none):
    prints = []
    for text in TEXTS:
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    want = roots(len(TEXTS), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    got = {r["doc_id"]: (r["bits"] % (1 << 64), r["component_id"]) for r in simhash_groups(docs).collect()}
    assert got == {i: (prints[i], want[i]) for i in range(len(TEXTS))}
    assert {r["doc_id"] for r in simhash_dedup(docs).collect()} == set(want)
    assert simhash_groups(none).count() == 0


def test_suffix_array():
    for trial in range(200):
        text = RNG.integers(0, RNG.integers(1, 5), RNG.integers(1, 80)).astype(np.int16)
        text = np.tile(text[: max(1, len(text) // 3)], 4) if trial % 3 == 0 else text
        assert suffix_array(text, 5).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_suffix_dedup(docs, none):
    bodies = [(t or "").encode() for t in TEXTS]
    seen = Counter(b[i : i + 200] for b in bodies for i in range(len(b) - 199))
    got = {r["doc_id"]: r for r in suffix_dedup(docs).collect()}
    assert len(got) == len(bodies)
    for i, body in enumerate(bodies):
        gone = np.zeros(len(body), bool)
        for k in range(len(body) - 199):
            if seen[body[k : k + 200]] > 1:
                gone[k : k + 200] = True
        kept = bytes(b for b, g in zip(body, gone) if not g)
        runs = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum()) if len(body) else 0
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"]) == (len(body), int(gone.sum()), runs)
        assert got[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert suffix_dedup(none).count() == 0


def test_suffix_dedup_of_a_crowd(spark):
    """One passage with unlike surroundings in more documents than one shard takes."""
    rows = [(i, prose(8) + PASSAGE + prose(8)) for i in range(300)]
    got = suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["n_removed"] >= len(PASSAGE) for r in got) and all(r["n_removed"] < r["n_bytes"] for r in got)


def test_difference_is_a_partition():
    sizes = np.zeros((300, 7), np.int64)
    sizes[:, 0] = RNG.integers(1, 1000, 300)
    places, total = difference(sizes)
    assert np.array_equal(np.bincount(places[:, 0], sizes[:, 0], 7).astype(int), total) and np.ptp(total) < 10


def test_sharding(docs, none):
    rows = shard_documents(docs, 3).toPandas()
    assert len(rows) == len(TEXTS)
    for r in rows.itertuples():
        body = (TEXTS[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(body) + 16, zlib.crc32(body))
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in rows.groupby("shard"))
    assert rows.groupby(rows.doc_id.map(lambda i: TEXTS[i] or "")).shard.nunique().max() == 1
    assert shard_documents(none, 3).count() == 0


def test_packing(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = pack_documents(docs).toPandas()
    for i, text in enumerate(TEXTS):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = rows[rows.doc_id == i].sort_values("start")
        assert np.array_equal(np.concatenate([np.frombuffer(x, "<u4") for x in own.ids]), ids)
        assert all(zlib.crc32(x) == c for x, c in zip(own.ids, own.ids_crc32)) and set(own.doc_tokens) == {len(ids)}
    short = 0
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        total = own.length.sum()
        assert own.offset.tolist() == [0, *own.length.cumsum()[:-1]] and total <= WINDOW
        short += total & (total - 1) != 0
    assert short <= 1 and pack_documents(none).count() == 0


def test_embeddings(spark):
    base = RNG.standard_normal((30, 10))
    vectors = [*base, *(base[:8] + 0.02 * RNG.standard_normal((8, 10))), base[0], 2 * base[1], np.zeros(10), np.full(10, np.nan)]
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(vectors)]
    rows += [(100, None, 0), (101, [1.0, None], 0), (102, [], 1), (103, [1.0] * 10, None), (104, [float("inf")] * 10, 0), (105, [3.0, 4.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("tile", F.lit("x"))

    def linked(i, j):
        a, b = rows[i], rows[j]
        if a[2] is None or a[2] != b[2] or not a[1] or not b[1] or len(a[1]) != len(b[1]) or None in a[1] or None in b[1]:
            return False
        x, y = np.array(a[1]), np.array(b[1])
        return bool(np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any() and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98)

    want = roots(len(rows), linked)
    got = {r["vec_id"]: r for r in embedding_groups(df).collect()}
    assert len(got) == len(rows)
    for i, row in enumerate(rows):
        assert got[row[0]]["n_links"] == sum(linked(i, j) for j in range(len(rows)) if j != i), row
        assert got[row[0]]["component_id"] == rows[want[i]][0]
    assert embedding_groups(df.limit(0)).count() == 0


def test_decontamination(spark, docs, none):
    words = BASE[3].split()[:60] if len(BASE[3].split()) > 20 else PASSAGE.split()
    items = [(0, " ".join(PASSAGE.split()[5:45]).upper()), (1, None), (2, ""), (3, prose(40)), (4, "Word"), (5, " ".join(words))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()}
    want = set()
    for i, text in enumerate(TEXTS):
        for j, item in items:
            a, b = (text or "").lower().split(), (item or "").lower().split()
            if not a or not b:
                continue
            k = min(5, len(b))
            grams = lambda w: [tuple(w[p : p + k]) for p in range(len(w) - k + 1)]  # noqa: B023, E731
            x, y = grams(a), grams(b)
            size = min(len(x), len(y))
            for s in range(len(x) - size + 1) if x else ():
                one, two = Counter(x[s : s + size]), Counter(y)
                if sum((one & two).values()) / sum((one | two).values()) >= 0.8:
                    want.add((i, j))
                    break
    assert got == want and {(TEXTS.index(PASSAGE), 0), (len(TEXTS) - 1, 4)} <= got
    assert decontaminate(docs, bench).count() == len(TEXTS) - len({i for i, _ in want})
    assert contaminated(none, bench).count() == 0 and contaminated(docs, bench.limit(0)).count() == 0


def test_lm_counts(docs, none):
    learn = crc_part("doc_id", 7) != 2
    got = {r["doc_id"]: r for r in score_documents(docs, learn).collect()}
    tokens = {i: [*(t or "").encode().lower().split(), END] for i, t in enumerate(TEXTS)}
    counts = Counter(w for i, x in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in x)
    total = sum(counts.values())
    for i, x in tokens.items():
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in x)
        assert got[i]["base_score"] == pytest.approx(base) and got[i]["n_tokens"] == len(x)
        assert got[i]["n_known"] == sum(counts[w] > 0 for w in x) and got[i]["train_tokens"] == total and got[i]["score"] < 0
    assert score_documents(none, learn).count() == 0


def test_classifiers(spark, docs, none):
    rows, marks = [], []
    for i in range(400):
        bad, rude = i % 4 == 1, i % 5 == 2
        text = prose(40)
        words = [w.upper() + "!!" for w in text.split()] if bad else text.split()
        if rude:
            words.insert(int(RNG.integers(0, 40)), ["blockhead", "nitwit", "b.l.o.c.k.h.e.a.d"][i % 3])
        rows.append((i, " ".join(words)))
        marks.append((i, int(not bad), int(rude)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    for score, label in ((score_quality, "quality"), (score_toxicity, "toxic")):
        got = score(table, labels, crc_part("doc_id", 4) != 2).join(labels, "doc_id").where(crc_part("doc_id", 4) == 2).toPandas()
        assert got.score.between(0, 1).all()
        assert ((got.score >= 0.5).astype(int) == got[label]).mean() > 0.95, label
        assert score(docs, labels, F.lit(True)).count() == len(TEXTS)
        assert score(docs, labels.limit(0), F.lit(True)).where("score between 0 and 1").count() == len(TEXTS)
        assert score(none, labels, F.lit(True)).count() == 0
    assert folded("Idi-0t!".encode()) == b"`idiot`" and folded(b"...") == b""


def test_url_rules(spark):
    urls = [
        "https://www.Example.ORG/es/1?q=1", "http://example.org/en/12", "http://a.org", "http://a.org/", "http://x.com/fr/#a", "http://x.com/de/9",
        "nothing", None, "", "http://forg/es/", "http://com/de/", "https://m.x.net/en/5/",
    ]
    table = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(table).collect()}
    assert got[0] == ("www.example.org", "/es/1", "example.org/es/", "block")
    assert got[1][2:] == ("example.org/en/1", "block") and got[2][1:3] == ("", None) and got[3][2:] == ("org/", "allow")
    assert got[4] == ("x.com", "/fr/", "com/fr/", "allow") and got[5][2:] == ("com/de/", "block") and got[10][2:] == ("com/de/", "block")
    assert got[6][:3] == got[7][:3] == got[8][:3] == ("", "", None) and got[9][2] is None
    assert {v[3] for v in got.values()} <= {"allow", "block"} and judge_urls(table.limit(0)).count() == 0

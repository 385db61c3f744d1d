"""The stages of the corpus pipeline, each on its own input: cut characters, nulls, repeated keys, empty tables."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline as pipeline
from perilspark.llm.suffix_dedup import whole_characters

RNG = np.random.default_rng(4)
WORDS = ["".join(RNG.choice(list("abcdefgh"), 6)) for _ in range(300)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score double"


def prose(n: int) -> str:
    return " ".join(RNG.choice(WORDS, n))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "k", 0.5) for i, t in rows], SCHEMA)


def texts(df) -> list:
    assert df.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_whole_characters():
    body = np.frombuffer("aé漢😀�z".encode(), np.uint8)
    for at in range(len(body)):
        gone = np.zeros(len(body), bool)
        gone[at] = True
        kept = whole_characters(body, gone).tobytes().decode()
        assert len(kept) == 5 and set(kept) < set("aé漢😀�z")
    assert whole_characters(body, np.zeros(len(body), bool)).tobytes() == body.tobytes()


def test_repeated_passages(spark):
    """A shared passage goes; genuine replacement characters and characters beside the cut stay, cut ones go whole."""
    shared = prose(60)
    docs = table(spark, [
        (1, f"one � mark {shared} end �"), (2, f"é{shared}漢 two"), (3, "� alone"), (4, None), (5, ""), (6, "x" * 150),
        # Repeats that start and end within characters of one lead byte.
        (7, "ã" + "é" * 120 + "ü one"), (8, "å" + "é" * 120 + "ö two"),
    ])
    got = dict(texts(pipeline.repeated_passages(spark, docs, "")))
    assert got[1] == "one � mark" or got[1].startswith("one � mark") and got[1].endswith("end �") and "�" in got[1][4:]
    assert got[2] == "é漢 two" and got[3] == "� alone" and got[4] is None and got[5] == "" and got[6] == "x" * 150
    assert got[7].endswith(" one") and "�" not in got[7] + got[8]
    kept = {r["doc_id"]: r["n_chars"] for r in pipeline.repeated_passages(spark, docs, "").collect()}
    assert kept == {i: None if t is None else len(t) for i, t in got.items()}


def test_near_duplicates(spark):
    body = prose(80)
    docs = table(spark, [(5, body), (2, body), (9, body + " " + WORDS[0]), (4, prose(90)), (7, None), (6, ""), (4, prose(70))])
    kept = [i for i, _ in texts(pipeline.near_duplicates(spark, docs, ""))]
    assert kept.count(2) == 1 and 5 not in kept and 4 in kept and len({6, 7} & set(kept)) == 1


@pytest.fixture()
def folder(spark, tmp_path):
    item = prose(40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = [(i, i % 2, 0) for i in range(400)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), item


def test_benchmark_leaks(spark, folder):
    path, item = folder
    docs = table(spark, [(1, prose(50)), (2, f"{prose(30)} {item} {prose(30)}"), (3, None), (4, ""), (5, item)])
    assert [i for i, _ in texts(pipeline.benchmark_leaks(spark, docs, path))] == [1, 3, 4]


def test_quality(spark, folder):
    path, _ = folder
    bad = ["zzz", "qqq", "xxx"]
    docs = table(spark, [(i, prose(40) if i % 2 else " ".join(RNG.choice(bad, 40))) for i in range(400)] + [(900, None), (901, prose(40))])
    kept = {i for i, _ in texts(pipeline.quality(spark, docs, path))}
    assert len(kept & {i for i in range(400) if i % 2}) > 190 and len(kept & {i for i in range(400) if not i % 2}) < 10 and 901 in kept


def test_packing_and_empty_tables(spark, folder):
    path, _ = folder
    docs = table(spark, [(1, prose(30)), (2, None), (3, "")])
    assert {(r["doc_id"], r["start"]) for r in pipeline.packing(spark, docs, path).collect()} == {(1, 0), (2, 0), (3, 0)}
    none = docs.where("false")
    for name, stage in pipeline.STAGES:
        assert stage(spark, none, path).count() == 0, name

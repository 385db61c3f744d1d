"""Fill-in-middle against a plain scan over units; restoring is exact."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from perilspark.llm.infilling import fill_in_middle, restored, unit_ends

TEXTS = [
    None, "", "a", "ab cd", "ab  cd\n\nef", "été 12", "\u0000 x", "<P> marked", "x<S>", "<M>", "<p> <s", "<<P", "\r\n", "漢字 kanji", "😀😀 a",
    "word " * 3000, "x" * 5000, "7" * 4000, "same same", "same same",
]
SCHEMA = "doc_id long, text string, n string, form string, key string, cuts string, output string"


def expected(key, text, epoch=1, rate=90, spm=20):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    sha = hashlib.sha256(f"{epoch}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(sha[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return (key, n, "plain", None, None, text)
    if h[3] % 100 < spm:
        return (key, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (key, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def order(rows):
    return sorted(rows, key=lambda r: tuple(("" if v is None else str(v)) for v in r))


def test_fill_in_middle(spark):
    # Every text under many keys, a null key and a repeated row.
    rows = [(k * 100 + i, t) for k in range(12) for i, t in enumerate(TEXTS)] + [(None, "a null key"), (5, "twice"), (5, "twice")]
    docs = spark.createDataFrame([(i, t, "n", "f", "k", "c", "o") for i, t in rows], SCHEMA)
    done = fill_in_middle(docs)
    assert done.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    want = [expected(i, t) for i, t in rows]
    assert order(tuple(r) for r in done.collect()) == order(want)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    back = done.select("doc_id", restored(F.col("output"), F.col("form")).alias("text"))
    assert order(tuple(r) for r in back.collect()) == order((i, t or "") for i, t in rows)
    assert fill_in_middle(docs.where("false")).collect() == []


def test_parameters(spark):
    docs = spark.createDataFrame([(i, f"one two three {i}") for i in range(300)], "page long, body string")
    done = {r["page"]: tuple(r) for r in fill_in_middle(docs, "page", "body", epoch=7, rate=50, spm_rate=50).collect()}
    assert done == {i: expected(i, f"one two three {i}", 7, 50, 50) for i in range(300)}


def test_markers_of_choice(spark):
    docs = spark.createDataFrame([(i, f"one <P> two {i}") for i in range(50)], "doc_id long, text string")
    marks = ("[pre]", "[suf]", "[mid]")
    done = fill_in_middle(docs, rate=100, markers=marks).withColumn("back", restored(F.col("output"), F.col("form"), marks)).collect()
    assert all(r["form"] != "plain" and r["back"] == f"one <P> two {r['doc_id']}" for r in done)


def test_stretches_do_not_show():
    rng = np.random.default_rng(1)
    for _ in range(50):
        text = "".join(rng.choice(list("ab Z9é\n"), rng.integers(0, 200)))
        want = [m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
        for stretch in (1, 2, 7, 1000):
            assert unit_ends(text, stretch).tolist() == want


def test_one_long_text(spark):
    text = "lorem ipsum, " * 300_000 + "x" * 2_000_000
    docs = spark.createDataFrame([(3, text)], "doc_id long, text string")
    row = fill_in_middle(docs, rate=100).withColumn("back", restored(F.col("output"), F.col("form"))).first()
    assert row["n"] == 300_000 * 5 + 1 and row["back"] == text

"""Runs of crowded anchors, cut into pieces."""

from __future__ import annotations

import hashlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from perilspark.llm import suffix_dedup as module
from perilspark.session import shared_dir

RNG = np.random.default_rng(8)
WORDS = ["".join(RNG.choice(list("abcdefgh"), RNG.integers(2, 7))) for _ in range(60)]
BASE = list(RNG.choice(WORDS, 120))


def near_copy() -> str:
    words = list(BASE)
    for at in RNG.integers(0, len(words), 3):
        words[at] = str(RNG.choice(WORDS))
    return " ".join(words)


#: Near copies, exact copies, and texts that hold strings and anchors more than once.
TEXTS = [*[near_copy() for _ in range(320)], " ".join(BASE), " ".join(BASE), " ".join(BASE * 3), "ab " * 900, "ab " * 700 + "x", None, ""]


def removed(bodies: list[bytes]) -> list[tuple[int, str]]:
    seen = Counter(b[i : i + 200] for b in bodies for i in range(len(b) - 199))
    out = []
    for body in bodies:
        gone = np.zeros(len(body), bool)
        for k in range(len(body) - 199):
            if seen[body[k : k + 200]] > 1:
                gone[k : k + 200] = True
        out.append((int(gone.sum()), hashlib.sha256(np.frombuffer(body, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("limit", [0, 20_000, module.CROWD_BYTES])
def test_pieces_equal_brute_force(spark, monkeypatch, limit):
    """All strings by hash, both ways mixed, and shards alone."""
    monkeypatch.setattr(module, "CROWD_BYTES", limit)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in module.suffix_dedup(docs).collect()}
    assert [got[i] for i in range(len(TEXTS))] == removed([(t or "").encode() for t in TEXTS])


def test_crowded_anchors_make_few_rows(spark, monkeypatch):
    """Rows of crowded runs stay far below one a start."""
    monkeypatch.setattr(module, "CROWD_BYTES", 60_000, raising=False)
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    docs = spark.createDataFrame(list(enumerate(TEXTS[:320])), "doc_id long, text string")
    assert module.suffix_dedup(docs).where("n_removed > 0").count() > 300
    made = {name: sum(spark.read.parquet(str(p)).count() for p in set(folder.iterdir()) - before if p.name.startswith(name)) for name in ("strings-", "pieces-")}
    starts = sum(len(t) - 199 for t in TEXTS[:320])
    assert made["pieces-"] > 0 and made["strings-"] + made["pieces-"] < starts / 5

"""The language model's weights grow with the training tokens, and scores are those of each block's own table."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from perilspark.llm import lm_score


def test_scores_of_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words, 40)) if i % 9 else "") for i in range(120)] + [(500, rows_text := " ".join(words)), (500, rows_text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = {}
    plain = lm_score.train_blocks

    def kept(training, vocabulary, weights, parts):
        found = plain(training, vocabulary, weights, parts)
        held.update(vocabulary=vocabulary, n=len(parts), weights={r["block"]: np.frombuffer(r["weights"], np.float16).astype(np.float32).reshape(-1, lm_score.CLASSES) for r in found.collect()})
        return found

    monkeypatch.setattr(lm_score, "train_blocks", kept)
    monkeypatch.setattr(lm_score, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(lm_score, "PART_TOKENS", 300)
    got = sorted((r["doc_id"], r["score"]) for r in lm_score.score_documents(docs, F.col("doc_id") % 2 == 0).collect())
    tokens = sum(len((t or "").split()) + 1 for i, t in rows if i % 2 == 0)
    # As many tables as the training tokens make blocks, each wider than the common one.
    assert held["n"] == -(-tokens // 500) == len(held["weights"]) > 1
    assert {len(w) for w in held["weights"].values()} == {(1 << lm_score.BLOCK_BITS) + 1}
    want = []
    for i, text in rows:
        counts, names, kinds = lm_score.Corpus()([text.encode()])
        hashed = lm_score.histories(counts, names)
        at, classes = held["vocabulary"].find(names, kinds)
        score = 0.0
        for k, block in enumerate(lm_score.blocks_of(hashed, held["n"]).tolist()):
            table = held["weights"][block]
            score += lm_score.log_softmax(table, lm_score.rows_of(hashed[:, k : k + 1], lm_score.BLOCK_BITS))[0, classes[k]] / np.log(10)
            score += held["vocabulary"].within[at[k]] if at[k] >= 0 else 0.0
        want.append((i, score))
    assert [i for i, _ in got] == [i for i, _ in sorted(want)]
    assert [x for _, x in got] == pytest.approx([x for _, x in sorted(want)], rel=1e-4)

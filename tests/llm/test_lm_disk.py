"""The language model deals its tokens out in turns: shuffle files and stored tokens stay small."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from perilspark.llm import lm_score


def test_stored_and_dealt_bytes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{j}" for j in rng.integers(0, 400, 60))) for i in range(80)] + [(80, ""), (81, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    held = {}
    plain = lm_score.class_scores

    def kept(scored, vocabulary, blocks, weights, parts):
        held.update(stored=scored.select(*lm_score._STORED).toArrow(), vocabulary=vocabulary, parts=parts)
        return plain(scored, vocabulary, blocks, weights, parts)

    monkeypatch.setattr(lm_score, "class_scores", kept)
    monkeypatch.setattr(lm_score, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(lm_score, "HEAD", 200)
    out = lm_score.score_documents(docs, F.col("doc_id") % 2 == 0).collect()
    assert len(out) == len(rows) and all(r["score"] < 0 for r in out)
    tokens, blocks = sum(r["n_tokens"] for r in out), []
    # A stored token takes 4 bytes, and a turn deals its own blocks, 9 bytes and a row a token.
    assert sum(len(x) for x in held["stored"].column("codes").to_pylist()) == 4 * tokens
    batch = held["stored"].combine_chunks().to_batches()[0]
    for turn in range(lm_score.TURNS):
        found = pa.Table.from_batches(lm_score.dealt(batch, held["vocabulary"], held["parts"], turn))
        assert {b % lm_score.TURNS for b in found.column("block").to_pylist()} == {turn}
        blocks += [len(x) for x in found.column("tokens").to_pylist()]
        assert sum(len(x) for x in found.column("rows").to_pylist()) // 8 == sum(blocks[-found.num_rows :]) // 9
    assert sum(blocks) == 9 * tokens
    # Words outside the frequent ones are found again in their documents' lists.
    _, _, counts, names, _, _ = next(lm_score.coded_batches(batch, held["vocabulary"]))
    stored = dict(zip(batch.column("row").to_pylist(), np.split(names, np.cumsum(counts)[:-1])))
    assert 0 < len(held["vocabulary"].names) < 400
    want = sorted(tuple(lm_score.Corpus()([(t or "").encode()])[1].tolist()) for _, t in rows)
    assert sorted(tuple(x.tolist()) for x in stored.values()) == want

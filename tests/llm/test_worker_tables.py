"""What an operator keeps in a Python worker goes when the next operator's tasks come."""

from __future__ import annotations

import weakref
from unittest.mock import MagicMock

import pyarrow as pa

from perilspark.llm import packing, quality, simhash_dedup


def test_tables_of_one_operator_at_a_time(spark):
    features = quality.features_of_worker()
    features([b"some words"])
    assert quality.features_of_worker() is features
    held = weakref.ref(features)
    del features
    tokens = packing.tokens_of("word_bpe_49k.json")
    assert held() is None and packing.tokens_of("word_bpe_49k.json") is tokens


def test_tasks_without_tables_clear_them(spark):
    held = weakref.ref(quality.features_of_worker())
    docs = MagicMock()
    simhash_dedup.fingerprints(docs)
    run = docs.select.return_value.mapInArrow.call_args[0][0]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([b"a b c d e"])], ["id", "body"])
    assert sum(x.num_rows for x in run(iter([batch]))) == 1
    assert held() is None

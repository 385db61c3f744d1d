"""Rows moved in blocks by a permutation."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from perilspark.functions.keys import hash_key
from perilspark.operators import learners
from perilspark.session import shared_dir


@pytest.mark.parametrize("n, block", [(1, 4), (2, 4), (3, 4), (23, 4), (24, 4), (37, 64)])
def test_every_row_meets_the_row_a_step_on(spark, monkeypatch, n, block):
    monkeypatch.setattr(learners, "BLOCK_ROWS", block)
    rows = spark.range(n).select((F.col("id") + 1).alias("_i"), F.lit(n).cast("long").alias("_i_of"), (F.col("id") % 2).alias("y"), F.col("id").alias("a"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("b"))
    blocks = learners._row_blocks(rows, "y", ["a", "b"])
    assert blocks.select(F.max(F.size("_rows"))).first()[0] == min(n, block)
    got = sorted((r["_repeat"], r["_own"]["a"], r["_other"]["a"], r["_other"]["b"]) for r in learners._moved_pairs(blocks, ["a", "b"], 3, 24).collect())
    step = [1 + (r + 24) * 2654435761 % (n - 1) if n > 1 else 0 for r in range(3)]
    other = [[(i - step[r]) % n for i in range(n)] for r in range(3)]
    assert got == [(r, i, other[r][i], str(other[r][i]) if other[r][i] % 3 else None) for r in range(3) for i in range(n)]


class Rule:
    algorithm, n_classes, features = "hgbc", 2, ["a", "b"]

    def score(self, df):
        p = F.least(F.lit(1.0), F.col("a") / 10)
        return df.withColumns({"prob_class_0": 1 - p, "prob_class_1": p})

    def with_label(self, df):
        return df.withColumn("predicted", (F.col("prob_class_1") > 0.5).cast("int"))


def test_permutation_writes_blocks(spark):
    """A packed row holds 256; importance is that of rows moved one by one."""
    folder = Path(shared_dir(spark))
    before = set(folder.iterdir())
    rows = spark.range(1000).select("id", (F.col("id") % 10 > 5).cast("int").alias("y"), (F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 7).cast("int").alias("b"))
    got = {r["feature"]: r["importance"] for r in learners.permutation_importance(Rule(), rows, "y", ["id"], repeats=2).collect()}
    made = [p for p in set(folder.iterdir()) - before if p.name.startswith("permutation-") and "quality" not in p.name]
    assert [spark.read.parquet(str(p)).count() for p in made] == [4]
    plain = [r["a"] for r in rows.orderBy(hash_key("id")).collect()]
    step = [1 + (r + 24) * 2654435761 % 999 for r in range(2)]
    right = [sum((plain[(i - s) % 1000] > 5) == (plain[i] > 5) for i in range(1000)) / 1000 for s in step]
    assert got == {"a": pytest.approx(1 - sum(right) / 2), "b": 0.0}

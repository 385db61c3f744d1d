"""A training corpus in five stages: quality, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, folder of tables) and works on all that the stage before kept; its result is written as
Parquet and reread as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilspark.llm.common import crc_part
from perilspark.llm.decontamination import decontaminate
from perilspark.llm.packing import pack_documents
from perilspark.llm.quality import score_quality
from perilspark.llm.simhash_dedup import simhash_dedup
from perilspark.llm.suffix_dedup import suffix_dedup
from perilspark.session import materialise

#: Least probability of good quality that a document is kept with.
QUALITY = 0.7


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier, trained on labelled rows outside the held-out quarter, does not reject.

    Null and empty texts are scored like others. Rows of one key go together if one of them is rejected.
    """
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scores = score_quality(docs, labels, crc_part("doc_id", 4) != 2)
    rejected = scores.where(F.col("score") < QUALITY).select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id.

    Texts without a word are alike, null ones too, so one of them stays.
    """
    return simhash_dedup(docs).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the strings of 200 bytes that occur elsewhere in what is left; a cut character goes whole.

    Texts that lose nothing, null and empty ones among them, stay as they are; a text may become empty. All else in a
    text stays, replacement characters too. Rows of equal keys are documents of their own.
    """
    kept = suffix_dedup(docs, characters=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept").cast("string")).otherwise(F.col("doc")["text"])
    columns = [text.alias(c) if c == "text" else F.char_length(text).cast("long").alias(c) if c == "n_chars" else F.col("doc")[c].alias(c) for c in docs.columns]
    return kept.select(*columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none. Rows of one key go together."""
    return decontaminate(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens; null and empty texts are one token, the end."""
    return pack_documents(docs).drop("ids")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packing", packing),
]

#: SQL can neither train the classifier nor tokenize; ``tests/llm/test_pipeline.py`` tests the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, folder), f"stage-{name}")
    return docs

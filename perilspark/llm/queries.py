"""Registered queries of the subpackage and their SQL twins.

Each query applies its operator, with production parameters, to its whole table; what the operator returns is only
brought into the digest columns here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from perilspark.llm import infilling, ranked_search, warc
from perilspark.llm.common import crc_part
from perilspark.llm.decontamination import contaminated
from perilspark.llm.embedding_dedup import embedding_groups
from perilspark.llm.lm_score import score_documents
from perilspark.llm.packing import pack_documents
from perilspark.llm.quality import score_quality
from perilspark.llm.sharding import shard_documents
from perilspark.llm.simhash_dedup import simhash_groups
from perilspark.llm.suffix_dedup import suffix_dedup
from perilspark.llm.toxicity import score_toxicity
from perilspark.llm.url_filter import judge_urls
from perilspark.session import run_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup(table(spark, folder, "documents")).drop("doc", "kept")


def sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = shard_documents(table(spark, folder, "documents"), shards=40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    held_out = crc_part("doc_id", 4) == 2
    scores = score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    held_out = crc_part("doc_id", 4) == 2
    scores = score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents")).drop("ids")


def lm_score(spark: SparkSession, folder: str) -> DataFrame:
    held_out = crc_part("doc_id", 7) == 2
    scores = score_documents(table(spark, folder, "documents"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"))


def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_groups(table(spark, folder, "embeddings"))


def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    rows = infilling.fill_in_middle(table(spark, folder, "documents"))
    back = infilling.restored(F.col("output"), F.col("form"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def warc_pages(spark: SparkSession, folder: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, folder, "pages"), run_dir(spark, "warc"))
    rows = warc.read_sound(manifest, ["record_type", "record_id", "refers_to", "payload_bytes", "payload_digest"])
    rows = rows.where(F.col("record_type").isin("response", "revisit"))
    return rows.select(warc.page_key("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_key("refers_to").alias("refers_to"))


def lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {
    "op1_suffix_array_dedup": suffix_array_dedup,
    "op2_sharding": sharding,
    "op3_toxicity": toxicity,
    "op4_quality_classifier": quality_classifier,
    "op5_benchmark_decontamination": benchmark_decontamination,
    "op6_packing": packing,
    "op7_url_filter": url_filter,
    "op8_lm_score": lm_score,
    "op9_embedding_near_dedup": embedding_near_dedup,
    "op10_simhash_near_dedup": simhash_near_dedup,
    "op11_fill_in_middle": fill_in_middle,
    "op12_warc": warc_pages,
    "op13_ranked_lexical_search": lexical_search,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op11_fill_in_middle": infilling.SQL,
    "op12_warc": warc.SQL,
    "op13_ranked_lexical_search": ranked_search.SQL,
}

"""Daily refresh: new forecast files in, scored alerts out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.tables import upsert


def forecast_stream(spark: SparkSession, folder: str, schema: StructType, files: str = "*.parquet", per_batch: int = 64) -> DataFrame:
    """Parquet files of a folder as a stream, a bounded number per batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    return reader.option("maxFilesPerTrigger", per_batch).parquet(folder)


def refresh_scores(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    keys: list[str],
    partition: str = "yearmon",
    issued: str | None = None,
) -> None:
    """Score every batch and merge it into the result table.

    ``score`` maps a batch of raw forecast rows to result rows: anomalies
    against a stored climatology (a stream-static join), probabilities, alert
    levels. The merge goes by ``keys``, so a replayed batch or a repeated
    forecast leaves one row per key: that of the latest ``issued`` time, in
    whatever order files come. Runs over what has landed, then stops.
    """

    def merge(batch: DataFrame, _: int) -> None:
        upsert(score(batch), out, keys, partition, issued=issued)

    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def dedupe_stream(stream: DataFrame, keys: list[str], time: str, delay: str = "2 days") -> DataFrame:
    """First row per key within the watermark delay.

    State is dropped once the watermark passes, so it does not grow with the
    stream; its size is one row per key and delay.
    """
    stamped = stream.withColumn(time, F.col(time).cast("timestamp"))
    return stamped.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def append_stream(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append to a Parquet table, exactly once, over what has landed."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()

"""Session helpers: a tuned session for local runs, shared-storage paths."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def build_session(app: str = "perilspark", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the operators rely on (UTC dates, AQE).

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submit
    command decides them, and AQE coalesces or splits shuffle partitions.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # Stream state beyond executor memory spills to local disk.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


@lru_cache(maxsize=None)
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix="perilspark-")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only where a session with one machine (master ``local``) names none, a
    temporary folder of this application takes its place; on a cluster that is
    an error, since executors would each write to their own disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir(spark.sparkContext.applicationId)


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df, name: str):
    """Write a table to the shared folder and read it back.

    Cuts lineage in a way that survives the loss of executors; used where an
    iterative step (model search, permutations) would re-read its input.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

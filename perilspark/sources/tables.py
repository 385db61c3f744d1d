"""Parquet tables: pruned scans and repeatable writes."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.temporal import Calendar
from ..operators.calendar import coverage_audit
from ..operators.forecast import first_per_key
from ..session import materialise


def read_table(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None, merge: bool = False) -> DataFrame:
    """Scan one or many Parquet stores; nothing found is FileNotFoundError.

    ``merge`` unites the columns of stores written at different times.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.option("mergeSchema", str(merge).lower()).parquet(*([path] if isinstance(path, str) else path))
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no table at {path}") from error
        raise


def write_table(df: DataFrame, path: str, codec: str = "zstd", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", codec).parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    write_table(df, path, mode="append")


def overwrite_partitions(df: DataFrame, path: str, partition: str = "yearmon") -> None:
    """Replace exactly the partitions present in ``df``; reruns change nothing.

    The rebalance hint gathers each partition into few files and lets AQE
    split one that is much larger than the others.
    """
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(partition)
        .parquet(path)
    )


def write_cells(df: DataFrame, path: str, time: str = "time") -> None:
    """Raster cells in long form, partitioned by year."""
    overwrite_partitions(df.withColumn("year", F.year(time)), path, "year")


def _partition_text(df: DataFrame, partition: str) -> DataFrame:
    # Partition values read back from folder names may be inferred as numbers.
    return df.withColumn(partition, F.col(partition).cast("string"))


def read_period(spark: SparkSession, path: str, start: dt.date | str, end: dt.date | str, time: str = "time", partition: str = "yearmon") -> DataFrame:
    """Rows of a date range; only the months in range are listed and read."""
    period = Calendar(start, end)
    table = spark.read.parquet(path)
    month = F.col(partition).cast("int") if dict(table.dtypes)[partition] != "string" else F.col(partition)
    low, high = (f"{d:%Y%m}" for d in (period.start, period.end))
    bounds = (int(low), int(high)) if dict(table.dtypes)[partition] != "string" else (low, high)
    return _partition_text(table.where(month.between(*bounds) & period.between(time)), partition)


MANIFEST = "_manifest"


@dataclass(frozen=True)
class Manifest:
    """What a keyed table holds: its schema and partitions, written with every batch.

    A batch so neither lists the table nor reads its footers. Every record has
    the whole state; the last counts. Spark's readers skip the folder.
    """

    number: int
    schema: StructType
    partitions: list[str]

    @classmethod
    def of(cls, spark: SparkSession, path: str, partition: str) -> Manifest | None:
        """The last record; of a table without one, what its files say; None where there is no table."""
        try:
            rows = spark.read.schema("number long, schema string, partitions array<string>").json(f"{path}/{MANIFEST}")
            last = rows.orderBy(F.desc("number")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            last = None
        if last is not None:
            return cls(last["number"], StructType.fromJson(json.loads(last["schema"])), list(last["partitions"]))
        try:
            table = _partition_text(read_table(spark, path, merge=True), partition)
        except FileNotFoundError:
            return None
        return cls(0, table.schema, [r[0] for r in table.select(partition).distinct().collect()])

    def write(self, spark: SparkSession, path: str) -> None:
        row = [(self.number, json.dumps(self.schema.jsonValue()), self.partitions)]
        df = spark.createDataFrame(row, "number long, schema string, partitions array<string>")
        df.coalesce(1).write.mode("append").json(f"{path}/{MANIFEST}")


def read_keyed(spark: SparkSession, path: str, partition: str = "yearmon", only: Sequence[str] | None = None) -> DataFrame:
    """A table that ``upsert`` keeps, by its manifest: no footer is read, and of ``only`` some partitions no other listed."""
    manifest = Manifest.of(spark, path, partition)
    if manifest is None:
        raise FileNotFoundError(f"no table at {path}")
    reader = spark.read.schema(manifest.schema)
    if only is None:
        return reader.parquet(path)
    chosen = sorted(set(only) & set(manifest.partitions))
    if not chosen:
        return spark.createDataFrame([], manifest.schema)
    return reader.option("basePath", path).parquet(*[f"{path}/{partition}={value}" for value in chosen])


def upsert(new: DataFrame, path: str, keys: list[str], partition: str = "yearmon", order: list[str] | None = None, issued: str | None = None) -> None:
    """Replace rows with equal keys, insert the others.

    Of several new rows with one key the first by ``order`` (then by the other
    columns) is taken; null keys are a key like others. ``issued`` names a
    column that tells versions of a row apart: the highest stays, among new
    and stored rows alike, so a late file never replaces a newer row.
    Only partitions that receive rows are read and rewritten, in two writes:
    the new rows aside, so that they are computed once, and the merged
    partitions, which Spark swaps in when all of them are written. The
    partition column must follow from the keys.
    """
    spark = new.sparkSession
    fresh = _partition_text(materialise(new, "upsert-new"), partition)
    touched = [r[0] for r in fresh.select(partition).distinct().collect()]  # months or days
    manifest = Manifest.of(spark, path, partition)
    rows = fresh.withColumn("_stored", F.lit(False))
    if manifest is not None:
        stored = read_keyed(spark, path, partition, touched)
        rows = rows.unionByName(stored.withColumn("_stored", F.lit(True)), allowMissingColumns=True)
    newest = [] if issued is None else [F.col(issued).isNull().alias("_unissued"), (-_as_number(rows, issued)).alias("_issue")]
    merged = first_per_key(rows, keys, [*newest, "_stored", *(order or [])]).drop("_stored")
    overwrite_partitions(merged, path, partition)
    known = set(manifest.partitions) if manifest else set()
    Manifest(manifest.number + 1 if manifest else 1, merged.schema, sorted(known | set(touched))).write(spark, path)


def _as_number(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    if kind == "date":
        return F.unix_date(column)
    return F.unix_micros(column) if kind == "timestamp" else F.col(column)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def extract(
    spark: SparkSession, path: str | Sequence[str], period: Calendar, time: str = "time", by_range: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows of a request and its audit.

    Rows carry ``key``: the year, or the range key with ``by_range``. The
    audit tells per year how many expected days have landed.
    """
    landed = read_table(spark, path, merge=True)
    rows = landed.where(period.contains(time))
    key = F.lit(period.key) if by_range else F.year(time).cast("string")
    return rows.withColumn("key", key), coverage_audit(landed, period, time)


def request_status(audit: DataFrame) -> DataFrame:
    """One row: 'success', 'partial' or 'failed', and the incomplete years."""
    lacking = F.sort_array(F.collect_list(F.when(F.col("landed_days") == 0, F.col("year"))))
    landed = F.sum("landed_days")
    status = F.when(landed == 0, "failed").when(F.size(lacking) > 0, "partial").otherwise("success")
    return audit.agg(status.alias("status"), F.size(lacking).alias("years_missing"), landed.alias("landed_days"))

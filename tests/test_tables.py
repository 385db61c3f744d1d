from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from perilspark.functions.temporal import Calendar
from perilspark.sources.tables import (
    extract,
    overwrite_partitions,
    read_keyed,
    read_period,
    read_table,
    request_status,
    upsert,
    write_cells,
)
from perilspark.streaming.refresh import append_stream, dedupe_stream, forecast_stream, refresh_scores


def series(spark, start, n, v=1.0):
    first = dt.date.fromisoformat(start)
    rows = [(i % 3, first + dt.timedelta(days=i), v) for i in range(n)]
    df = spark.createDataFrame(rows, "cell int, time date, v double")
    return df.withColumn("yearmon", F.date_format("time", "yyyyMM"))


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none"))


def test_partition_overwrite_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        overwrite_partitions(series(spark, "2024-01-15", 40), path)
    overwrite_partitions(series(spark, "2024-02-01", 10, 9.0), path)
    got = spark.read.parquet(path)
    assert got.count() == 17 + 10 and got.where("v = 9").count() == 10


def test_read_period_prunes_and_keeps_the_first_month(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_partitions(series(spark, "2024-01-01", 120), path)
    out = read_period(spark, path, "2024-01-20", "2024-03-05")
    assert out.count() == 46 and dict(out.dtypes)["yearmon"] == "string"
    assert read_period(spark, path, "2024-02-10", "2024-02-10").count() == 1
    plan = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(yearmon" in plan


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(series(spark, "2024-01-25", 20), path, ["cell", "time"])
    for _ in range(2):
        upsert(series(spark, "2024-01-30", 10, 5.0).withColumn("note", F.lit("new")), path, ["cell", "time"])
    got = read_table(spark, path, merge=True)
    assert got.count() == 20 + 10  # other cells fall on the same days
    assert got.where("v = 5").count() == 10 and got.where("note = 'new'").count() == 10


def test_cells_by_year(spark, tmp_path):
    path = str(tmp_path / "t")
    write_cells(series(spark, "2023-12-20", 30), path)
    assert {r[0] for r in spark.read.parquet(path).select("year").distinct().collect()} == {2023, 2024}


@pytest.mark.parametrize("end,status", [("2024-01-20", "success"), ("2025-02-01", "partial")])
def test_request_status(spark, tmp_path, end, status):
    path = str(tmp_path / "t")
    overwrite_partitions(series(spark, "2024-01-01", 60), path)
    rows, audit = extract(spark, path, Calendar("2024-01-01", end), by_range=True)
    assert request_status(audit).first()["status"] == status
    assert rows.first()["key"] == Calendar("2024-01-01", end).key


def test_stream_replay_leaves_one_row_per_key(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    score = lambda batch: batch.groupBy("cell", "time", "yearmon").agg(F.max("v").alias("v"))
    for value in (1.0, 2.0):
        series(spark, "2024-01-25", 20, value).write.mode("append").parquet(source)
        stream = forecast_stream(spark, source, spark.read.parquet(source).schema)
        refresh_scores(stream, score, out, progress, ["cell", "time"])
    got = spark.read.parquet(out)
    assert got.count() == 20 and {r["v"] for r in got.collect()} == {2.0}


def test_stream_dedupe(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for _ in range(3):
        series(spark, "2024-01-25", 20).write.mode("append").parquet(source)
        stream = forecast_stream(spark, source, spark.read.parquet(source).schema)
        append_stream(dedupe_stream(stream, ["cell", "time"], "time", "60 days"), out, progress)
    assert spark.read.parquet(out).count() == 20


def test_upsert_keeps_one_row_per_key(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([(1, "a", 5.0), (1, "a", 4.0), (None, "a", 1.0)], "k int, yearmon string, v double")
    upsert(first, path, ["k", "yearmon"])
    upsert(spark.createDataFrame([(None, "a", 2.0), (2, "a", 3.0)], "k int, yearmon string, v double"), path, ["k", "yearmon"])
    rows = {(r["k"], r["v"]) for r in spark.read.parquet(path).collect()}
    assert rows == {(1, 4.0), (None, 2.0), (2, 3.0)}


def test_manifest_serves_a_table(spark, tmp_path):
    """Files and schema come from the manifest: new columns, tables from before it, partitions that no batch touches."""
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "202401", 1.0), (2, "202402", 2.0)], "k int, yearmon string, v double")
    overwrite_partitions(rows, path)  # a table without a manifest
    upsert(spark.createDataFrame([(1, "202401", 5.0, "x")], "k int, yearmon string, v double, note string"), path, ["k", "yearmon"])
    upsert(spark.createDataFrame([(3, "202403", 3.0)], "k int, yearmon string, v double"), path, ["k", "yearmon"])
    got = {r["k"]: (r["yearmon"], r["v"], r["note"]) for r in read_keyed(spark, path).select("k", F.col("yearmon").cast("string"), "v", "note").collect()}
    assert got == {1: ("202401", 5.0, "x"), 2: ("202402", 2.0, None), 3: ("202403", 3.0, None)}
    assert {r["k"] for r in read_keyed(spark, path, only=["202403", "209901"]).collect()} == {3}
    assert read_keyed(spark, path, only=["209901"]).count() == 0
    with pytest.raises(FileNotFoundError):
        read_keyed(spark, str(tmp_path / "none"))


def test_latest_issue_wins_in_any_order(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, yearmon string, v double, issued date"
    at = lambda d: dt.date(2024, 1, d)
    upsert(spark.createDataFrame([(1, "202401", 9.0, at(1)), (1, "202401", 1.0, at(2)), (2, "202401", 7.0, None), (3, "202401", 4.0, at(5))], schema), path, ["k", "yearmon"], issued="issued")
    upsert(spark.createDataFrame([(1, "202401", 8.0, at(1)), (2, "202401", 6.0, at(1)), (3, "202401", 5.0, at(5))], schema), path, ["k", "yearmon"], issued="issued")
    # A late old file loses, a row without a time loses to any other, of equal times the newer batch stays.
    assert {r["k"]: r["v"] for r in read_keyed(spark, path).collect()} == {1: 1.0, 2: 6.0, 3: 5.0}

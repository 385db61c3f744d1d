"""The master queries cover every day of the given tables, counted without the period the queries name."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the generated tables are not here")


def one(sql: str):
    return duckdb.sql(sql.replace("lineitem", f"'{FOLDER}/lineitem.parquet'").replace("orders", f"'{FOLDER}/orders.parquet'")).fetchall()[0][0]


def test_features_of_all_days(spark):
    days = QUERIES["align_features"](spark, FOLDER).groupBy("time").agg(F.count("t2m").alias("t2m"), F.count("tp").alias("tp"), F.count("altitude").alias("altitude"))
    got = days.agg(*[F.count(F.when(F.col(c) > 0, 1)) for c in ("t2m", "tp", "altitude")]).first()
    assert got[0] == one("select count(distinct cast(l_shipdate as date)) from lineitem where l_linenumber in (2, 3, 4)")
    assert got[1] == one("select count(distinct cast(o_orderdate as date)) from orders")
    assert got[2] == 7 * 365 + 2


def test_stations_of_all_days(spark):
    """Every station has its node's static features on every day of 1995 to 2001."""
    assert QUERIES["station_extract"](spark, FOLDER).count() == one("select count(distinct o_custkey % 6400) from orders") * (7 * 365 + 2)


def test_training_rows_of_all_days(spark):
    """Every station day with a target is a row, as the static set has every node on every day."""
    want = one("select count(distinct (o_custkey % 6400, cast(o_orderdate as date))) from orders where o_totalprice % 3 < 2")
    assert QUERIES["master_train"](spark, FOLDER).count() == want

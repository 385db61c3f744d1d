"""Queries over the given tables and their SQL twins.

Each module fills ``QUERIES`` (Spark) and ``ORACLES`` (SQL for DuckDB).
Values that come out of floating-point sums are rounded in both engines,
because the order of a sum changes its last bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Means of cent amounts often end exactly on a rounding tie, where the last bit
# of the sum decides; both engines add this before rounding to 3 digits.
OFF_TIE = 0.00012345


def rounded_off_tie(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + OFF_TIE, 3) for c in columns})


def off_tie_sql(expression: str) -> str:
    return f"round(({expression}) + {OFF_TIE}e0, 3)"


def point_lon(key: Column | str) -> Column:
    """Longitude derived from a key, as in the SQL twin ``LON_SQL``."""
    k = F.col(key) if isinstance(key, str) else key
    return F.round(-69.6 + (k % 80) * 0.15, 4)


def point_lat(key: Column | str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.round(-22.9 + (F.floor(k / 80) % 80) * 0.165, 4)


def lon_sql(key: str) -> str:
    return f"round(-69.6e0 + ({key} % 80) * 0.15e0, 4)"


def lat_sql(key: str) -> str:
    return f"round(-22.9e0 + (({key} // 80) % 80) * 0.165e0, 4)"


def orders_series(spark: SparkSession, folder: str) -> DataFrame:
    """Order value per priority ("station") and day over seven years."""
    from perilspark.operators.calendar import daily_series

    orders = table(spark, folder, "orders").withColumnRenamed("o_orderpriority", "station_id")
    return daily_series(orders, ["station_id"], "o_orderdate", value=F.round(F.sum("o_totalprice"), 2))


ORDERS_SERIES = """
    select o_orderpriority as station_id, cast(o_orderdate as date) as time, round(sum(o_totalprice), 2) as value
    from orders group by 1, 2
"""


def events_series(spark: SparkSession, folder: str) -> DataFrame:
    """Event value per user ("station") and day."""
    from perilspark.operators.calendar import daily_series

    events = table(spark, folder, "events").withColumnRenamed("user_id", "station_id")
    return daily_series(events, ["station_id"], "ts", value=F.round(F.sum("value"), 2))


EVENTS_SERIES = """
    select user_id as station_id, cast(ts as date) as time, round(sum(value), 2) as value
    from events group by 1, 2
"""

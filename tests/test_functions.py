from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from perilspark.functions.flags import COLD_ALERTS, RAIN_ALERTS, alert_level, flag, threshold_name
from perilspark.functions.numeric import (
    lon_to_180,
    lon_to_360,
    mean_of_available,
    nan_to_null,
    normalise_longitudes,
    snap_bounds,
    snap_nearest,
)
from perilspark.functions.temporal import Calendar, previous_day, range_key, resolve_period, time_part, with_time_parts


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def listed(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_longitudes(spark):
    df = column(spark, [-180.0, 0.0, 179.9, 180.0, 359.9, None])
    assert listed(df, lon_to_180("v")) == [-180.0, 0.0, 179.9, -180.0, pytest.approx(-0.1), None]
    assert listed(df, lon_to_360("v")) == [180.0, 0.0, 179.9, 180.0, 359.9, None]


def test_longitudes_change_only_when_needed(spark):
    east = column(spark, [0.0, 180.0])
    assert listed(normalise_longitudes(east, "v"), "v") == [0.0, 180.0]
    wide = column(spark, [10.0, 200.0])
    assert listed(normalise_longitudes(wide, "v"), "v") == [10.0, -160.0]
    signed = column(spark, [-5.0, 180.0])
    assert listed(normalise_longitudes(signed, "v"), "v") == [-5.0, -180.0]


def test_bounds_grow_outward(spark):
    assert snap_bounds(-69.61, -22.91, -57.49, -9.8, 10) == {"minx": -69.7, "miny": -23.0, "maxx": -57.4, "maxy": -9.8}
    assert listed(column(spark, [0.25, 0.35, 0.449]), snap_nearest("v", 10)) == [0.2, 0.4, 0.4]


def test_missing_values(spark):
    df = spark.createDataFrame([(1.0, None), (None, 3.0), (1.0, 3.0), (None, None)], "a double, b double")
    assert listed(df, mean_of_available("a", "b")) == [1.0, 3.0, 2.0, None]
    assert listed(nan_to_null(column(spark, [float("nan"), 2.0]), ["v"]), "v") == [None, 2.0]
    assert listed(column(spark, [None, -1.0, 0.0, 1.0]), flag(F.col("v") <= 0)) == [0, 1, 1, 0]


def test_alert_thresholds_belong_to_their_level(spark):
    df = column(spark, [0.60, 0.599, 0.12, 0.119, 0.40, 0.10, None])
    assert listed(df, alert_level("v", COLD_ALERTS)) == ["Red", "Orange", "Orange", "None", "Orange", "None", "None"]
    assert listed(df, alert_level("v", RAIN_ALERTS)) == ["Red", "Red", "Orange", "Orange", "Red", "Orange", "None"]


def test_threshold_names():
    assert [threshold_name(t) for t in (1, 1.0, 1.5, 95)] == ["1", "1", "1.5", "95"]


def test_time_parts(spark):
    df = column(spark, [dt.date(2021, 1, 3), dt.date(2020, 12, 31), dt.date(2021, 1, 4)], "date").withColumnRenamed("v", "time")
    out = with_time_parts(df, ["week", "dayofyear", "year", "month", "yearmon"]).collect()
    assert [r["week"] for r in out] == [53, 53, 1]
    assert [r["dayofyear"] for r in out] == [3, 366, 4]
    assert out[1]["yearmon"] == "202012"
    with pytest.raises(ValueError):
        time_part("time", "decade")


def test_previous_day(spark):
    df = column(spark, [dt.date(2024, 3, 1)], "date").withColumnRenamed("v", "time")
    assert previous_day(df).first().asDict() == {"time": dt.date(2024, 2, 29), "time_orig": dt.date(2024, 3, 1)}


@pytest.mark.parametrize("every,unit,count", [(1, "day", 60), (7, "day", 9), (1, "month", 2)])
def test_calendar_frame_and_membership_agree(spark, every, unit, count):
    calendar = Calendar("2024-01-01", "2024-02-29", every, unit)
    days = [r[0] for r in calendar.frame(spark).collect()]
    assert len(days) == count
    around = Calendar("2023-12-01", "2024-04-01").frame(spark)
    assert sorted(r[0] for r in around.where(calendar.contains("time")).collect()) == days


def test_periods():
    assert range_key("2024-01-05", dt.date(2024, 2, 1)) == "20240105_20240201"
    assert resolve_period(today=dt.date(2026, 5, 1)) == (1995, 2025)
    assert resolve_period(2001, 2003) == (2001, 2003)
    assert Calendar("2010-03-01", "2012-01-01").years == [2010, 2011, 2012]
    with pytest.raises(ValueError):
        Calendar("2024-01-01", "2024-02-01", 0)

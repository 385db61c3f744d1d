from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import brute
from perilspark.functions.flags import flag
from perilspark.functions.temporal import Calendar
from perilspark.operators.bias import mean_variance_scaling, monthly_bias_factors, weekly_share, with_monthly_bias
from perilspark.operators.calendar import coverage_audit, daily_series, fill_gaps
from perilspark.operators.climatology import (
    anomaly_features,
    circular_smooth,
    doy_moments,
    doy_percentile,
    full_years,
    weekly_climatology,
)
from perilspark.operators.forecast import accumulate_between, first_per_key, lead_days
from perilspark.operators.series import forward_mean, forward_sum, run_target
from perilspark.plans.targets import cold_day_target, create_target

DAY = dt.date(2024, 1, 1)


def days(values, station="a", start=DAY):
    return [(station, start + dt.timedelta(days=i), v) for i, v in enumerate(values)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "station string, time date, v double")


def by_day(df, column, station="a"):
    return [r[column] for r in df.where(F.col("station") == station).orderBy("time").collect()]


def test_forward_windows_stay_within_a_station(spark):
    df = frame(spark, days([1.0, None, 3.0, 4.0]) + days([10.0, 20.0], "b"))
    out = df.withColumns({"s": forward_sum("v", ["station"], 3), "m": forward_mean("v", ["station"], 2)})
    assert by_day(out, "s") == [4.0, 7.0, None, None]
    assert by_day(out, "m") == [1.0, 3.0, 3.5, None]
    assert by_day(out, "s", "b") == [None, None]


def test_all_missing_window_is_missing(spark):
    out = frame(spark, days([None, None, 5.0])).withColumn("s", forward_sum("v", ["station"], 2))
    assert by_day(out, "s") == [None, 5.0, None]


def test_run_target(spark):
    df = frame(spark, days([1.0, 1.0, 9.0, 1.0, 1.0, None])).withColumn("low", flag(F.col("v") <= 1))
    out = run_target(df, "low", ["station"], 2, "n", "target")
    assert by_day(out, "n") == [2, 1, 1, 2, 1, None]
    assert by_day(out, "target") == [1, 0, 0, 1, 0, 0]


def test_gap_filling_carries_station_attributes(spark):
    rows = [("a", dt.date(2024, 1, 1), 5.0, 1.5), ("a", dt.date(2024, 1, 3), 6.0, 1.5)]
    df = spark.createDataFrame(rows, "station string, time date, v double, lon double")
    out = fill_gaps(df, ["station"], Calendar("2024-01-01", "2024-01-04"), ["lon"]).orderBy("time").collect()
    assert [r["v"] for r in out] == [5.0, None, 6.0, None]
    assert {r["lon"] for r in out} == {1.5}


def test_daily_series_is_unique_per_day(spark):
    rows = [("a", dt.datetime(2024, 1, 1, h), float(h)) for h in (1, 5, 23)]
    df = spark.createDataFrame(rows, "station string, ts timestamp, v double")
    assert daily_series(df, ["station"], "ts", v=F.sum("v")).collect()[0]["v"] == 29.0


def test_coverage(spark):
    df = frame(spark, days([1.0] * 300) + days([1.0] * 10, start=dt.date(2025, 3, 1)))
    out = {r["year"]: r for r in coverage_audit(df, Calendar("2024-01-01", "2026-12-31")).collect()}
    assert [(out[y]["landed_days"], out[y]["complete"], out[y]["status"]) for y in (2024, 2025, 2026)] == [
        (300, 1, "partial"), (10, 0, "partial"), (0, 0, "missing")]


@pytest.fixture(scope="module")
def noisy():
    rng = np.random.default_rng(7)
    time = pd.date_range("2015-01-01", "2020-12-31")
    parts = []
    for station in ("a", "b"):
        v = rng.normal(10, 3, len(time)).round(0)
        v[rng.random(len(time)) < 0.1] = np.nan
        parts.append(pd.DataFrame({"station": station, "time": time.date, "v": v}))
    return pd.concat(parts, ignore_index=True)


def spark_frame(spark, pdf):
    return spark.createDataFrame(pdf.astype({"v": object}).where(pdf.notna(), None), "station string, time date, v double")


def test_doy_percentile_equals_365_passes(spark, noisy):
    got = doy_percentile(spark_frame(spark, noisy), "v", ["station"], 3).toPandas()
    noisy = noisy.assign(want=brute.doy_percentile(noisy, "v", "station", 3))
    both = noisy.merge(got, on=["station", "time"])
    assert len(both) == len(noisy)
    np.testing.assert_allclose(both["perc_v"].astype(float), both["want"], atol=1.01e-4)
    leap = both[pd.to_datetime(both["time"]).dt.dayofyear == 366]
    assert len(leap) and leap["perc_v"].isna().all()


def test_doy_moments_equal_365_passes(spark, noisy):
    got = doy_moments(spark_frame(spark, noisy), "v", ["station"], 7, digits=None).toPandas()
    want = brute.doy_moments(noisy, "v", "station", 7)
    both = noisy.assign(**want).merge(got, on=["station", "time"])
    np.testing.assert_allclose(both["clim_v_mean"].astype(float), both["mean"], atol=1e-9)
    np.testing.assert_allclose(both["clim_v_std"].astype(float), both["std"], atol=1e-9)


def test_constant_window_has_zero_std_and_missing_value_no_flag(spark):
    df = frame(spark, days([4.0] * 20 + [None]))
    out = cold_day_target(df, "v", ["station"], [1], [3], "x")
    rows = out.orderBy("time").collect()
    assert rows[0]["clim_v_std"] == 0.0 and rows[0]["flag_tmin_1sd_x"] == 1
    assert rows[-1]["flag_tmin_1sd_x"] == 0
    assert [r["n_1sd_next3d_x"] for r in rows[-4:]] == [3, 2, None, None]


def test_all_missing_station_gets_no_climatology(spark):
    out = doy_moments(frame(spark, days([None, None, None])), "v", ["station"], 3).collect()
    assert len(out) == 3 and all(r["clim_v_mean"] is None for r in out)


def test_circular_smoothing(spark):
    rows = [("a", w, float(w)) for w in range(1, 7)]
    df = spark.createDataFrame(rows, "cell string, week int, v double")
    got = {r["week"]: r["v"] for r in circular_smooth(df, ["v"], ["cell"], reach=1).collect()}
    assert got == {1: 3.0, 2: 2.0, 3: 3.0, 4: 4.0, 5: 5.0, 6: 4.0}


def test_only_full_years_enter_a_climatology(spark):
    rows = days([1.0] * 365, start=dt.date(2021, 1, 1)) + days([100.0] * 359, start=dt.date(2022, 1, 1))
    df = frame(spark, rows)
    assert df.select(full_years(df)).first()[0] == [2021]
    out = weekly_climatology(df, ["v"], ["station"], smooth=0).collect()
    assert {r["clim_v"] for r in out} == {1.0} and {r["std_v"] for r in out} == {0.0}


def test_zero_spread_gives_no_anomaly(spark):
    features, _ = anomaly_features(frame(spark, days([1.0] * 365, start=dt.date(2021, 1, 1))), ["v"], ["station"])
    assert {r["anom_v"] for r in features.collect()} == {None}


def test_training_anomalies_average_to_zero(spark, noisy):
    features, _ = anomaly_features(spark_frame(spark, noisy.dropna()), ["v"], ["station"], smooth=0, min_days=1)
    means = features.groupBy("station", F.weekofyear("time")).agg(F.avg("anom_v").alias("m")).collect()
    assert max(abs(r["m"]) for r in means if r["m"] is not None) < 1e-9


@pytest.mark.parametrize("observed,factor", [(25, 1.0), (26, 2.0)])
def test_month_needs_enough_days(spark, observed, factor):
    rows = [("a", DAY + dt.timedelta(days=i), 2.0 if i < observed else None, 2.0 * observed / 31 / 2) for i in range(31)]
    df = spark.createDataFrame(rows, "station string, time date, obs double, prod double")
    out = with_monthly_bias(df, ["station"], "obs", "prod", "adj").collect()
    assert {round(r["bias_factor"], 9) for r in out} == {factor}
    table = monthly_bias_factors(df, ["station"], "obs", "prod").collect()
    assert len(table) == (observed >= 26)


def test_zero_product_mean_keeps_factor_one(spark):
    rows = [("a", DAY + dt.timedelta(days=i), 2.0, 0.0) for i in range(31)]
    df = spark.createDataFrame(rows, "station string, time date, obs double, prod double")
    assert with_monthly_bias(df, ["station"], "obs", "prod", "adj").first()["bias_factor"] == 1.0


def test_scaling_matches_observed_moments(spark):
    rng = np.random.default_rng(3)
    rows = [("a", DAY + dt.timedelta(days=i), float(rng.normal(5, 2)), float(rng.normal(50, 9))) for i in range(30)]
    df = spark.createDataFrame(rows, "station string, time date, obs double, prod double")
    out = mean_variance_scaling(df, ["station"], "obs", "prod", "adj", "mix").toPandas()
    assert out["adj"].mean() == pytest.approx(out["obs"].mean())
    assert out["adj"].std() == pytest.approx(out["obs"].std())
    assert np.allclose(out["mix"], (out["adj"] + out["obs"]) / 2)


def test_dry_week_shares_are_zero(spark):
    rows = [("a", dt.date(2024, 1, 1 + i), 3.0, 0.0) for i in range(7)]
    df = spark.createDataFrame(rows, "station string, time date, obs double, prod double")
    out = weekly_share(df, ["station"], "obs", "prod", "share", "adj").collect()
    assert {(r["share"], r["adj"]) for r in out} == {(0.0, 0.0)}


def test_accumulation_between_leads(spark):
    rows = [("c", DAY, 2, 5.0), ("c", DAY, 7, 4.0), ("d", DAY, 7, 9.0)]
    df = spark.createDataFrame(rows, "cell string, time date, step int, tp double")
    plain = {r["cell"]: (r["time"], r["tp"]) for r in accumulate_between(df, ["tp"], ["cell"], 2, 7).collect()}
    assert plain == {"c": (dt.date(2024, 1, 3), -1.0), "d": (dt.date(2024, 1, 3), None)}
    clipped = {r["cell"]: r["tp_cum"] for r in accumulate_between(df, ["tp"], ["cell"], 2, 7, clip=True, suffix="_cum").collect()}
    assert clipped == {"c": 0.0, "d": None}


def test_accumulation_with_hour_alignment(spark):
    at = dt.datetime(2024, 1, 1, 18)
    df = spark.createDataFrame([("c", at, 24, 1.0), ("c", at, 48, 4.0)], "cell string, time timestamp, step int, tp double")
    row = accumulate_between(df, ["tp"], ["cell"], 24, 48, clip=True, shift_hours=30, suffix="_cum").first()
    assert row["tp_cum"] == 3.0 and row["time"] == dt.datetime(2024, 1, 3, 0)


def test_leads_as_intervals(spark):
    df = spark.createDataFrame([(dt.timedelta(days=2, hours=12),)], "step interval day to second")
    assert df.select(lead_days("step")).first()[0] == 2.5


def test_first_per_key_is_the_first_in_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 1, "b"), ("c", 5, "z")], "k string, run int, v string")
    assert sorted(tuple(r) for r in first_per_key(df, ["k"], ["run"]).collect()) == [("a", 1, "b"), ("c", 5, "z")]


def test_unknown_hazard():
    with pytest.raises(KeyError):
        create_target("hail")

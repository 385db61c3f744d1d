"""Polygon tables, equal shapes and repeated readings."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from perilspark.functions.temporal import Calendar
from perilspark.operators.climatology import doy_moments, doy_percentile
from perilspark.operators.grid import GridSpec
from perilspark.operators.spatial import distinct_areas, edges_of_ring, number_areas, outline, polygon_join, polygons_from_rings
from perilspark.plans.targets import TargetArea, station_series
from perilspark.session import run_dir
from perilspark.sources.geometries import join_polygons, read_polygons, read_tiles, write_polygons

L = [(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]
BOX = [(10, 0), (12, 0), (12, 2), (10, 2)]


def areas(spark, *rows):
    return polygons_from_rings(spark, ["name"], list(rows))


def test_ring_closes_itself(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in BOX])
    got = spark.range(1).select(edges_of_ring(ring).alias("edges")).first()["edges"]
    assert [tuple(e) for e in got] == [tuple(map(float, (*a, *b))) for a, b in zip(BOX, [*BOX[1:], BOX[0]])]


def test_outline_ignores_start_and_direction(spark):
    df = areas(spark, ("a", L), ("b", L[3:] + L[:3]), ("c", L[::-1]), ("d", L[:5] + [(0.5, 4)]), ("e", L[:2] + [L[1]] + L[2:]))
    forms = {r["name"]: r["o"] for r in df.select("name", outline("edges").alias("o")).collect()}
    assert forms["a"] == forms["b"] == forms["c"] == forms["e"] != forms["d"]


def test_equal_shapes_keep_the_smallest_row(spark):
    df = areas(spark, ("b", L), ("a", L[::-1]), ("z", BOX), (None, BOX[1:] + BOX[:1]))
    assert sorted((r["name"] or "", r["minx"]) for r in distinct_areas(df).collect()) == [("", 10.0), ("a", 0.0)]
    ids = {r["name"]: r["location_id"] for r in number_areas(df).collect()}
    assert ids == {"a": "ID-001", None: "ID-002"}
    assert number_areas(df.limit(0)).count() == 0


def test_polygon_table_round_trip_and_pruned_join(spark):
    path = run_dir(spark, "areas")
    rng = np.random.default_rng(3)
    turn = np.sort(rng.uniform(0, 2 * np.pi, 3000))
    reach = rng.uniform(2, 6, 3000)
    star = list(zip((25 + reach * np.cos(turn)).round(6), (reach * np.sin(turn)).round(6)))
    df = areas(spark, ("L", L), ("box", BOX), ("star", star), ("twin", BOX))
    none = df.limit(1).withColumns({"name": F.lit("none"), "edges": F.filter("edges", lambda e: F.lit(False))})
    write_polygons(df.unionByName(none), path, cell=0.7)
    assert read_polygons(spark, path).count() == 5
    near = {"minx": 11.0, "miny": -1.0, "maxx": 20.0, "maxy": 0.0}
    assert sorted(r["name"] for r in read_polygons(spark, path, near).collect()) == ["box", "star", "twin"]
    whole, cell = read_tiles(spark, path)
    some, _ = read_tiles(spark, path, near)
    assert cell == 0.7 and 0 < some.count() < whole.count()
    xy = np.vstack([rng.uniform([-1, -7], [33, 7], (3000, 2)), np.array(star[:50])])
    points = spark.createDataFrame([tuple(map(float, p)) for p in xy], "lon double, lat double")
    stored = join_polygons(points, path, ["name"], "left")
    direct = polygon_join(points, df, ["name"], "left")
    assert sorted(map(str, stored.collect())) == sorted(map(str, direct.collect()))
    inside = points.where("lon between 11 and 20 and lat between -1 and 0")
    pruned = join_polygons(inside, path, ["name"], bounds=near)
    assert sorted(map(str, pruned.collect())) == sorted(map(str, polygon_join(inside, df, ["name"]).collect()))
    write_polygons(df.where("name = 'L'"), path)
    assert [r["name"] for r in read_polygons(spark, path).collect()] == ["L"]


def test_absent_polygon_table(spark):
    with pytest.raises(FileNotFoundError):
        read_polygons(spark, run_dir(spark, "nothing"))


@pytest.fixture
def repeated(spark):
    at = lambda d, h: dt.datetime(2001, 1, d, h)
    rows = [("s", at(1, 3), 1.0, 1.0, 5.0, "b"), ("s", at(1, 21), 1.0, 1.0, 2.0, "a"), ("s", at(3, 23), 1.0, 1.0, None, None),
            ("s", at(3, 1), 1.0, 1.0, 7.0, None), ("far", at(2, 1), 9.0, 9.0, 1.0, None)]
    return spark.createDataFrame(rows, "station_id string, time timestamp, lon double, lat double, tmin double, station string")


def test_readings_of_a_day_become_one(spark, repeated):
    where = TargetArea({"minx": 0.0, "miny": 0.0, "maxx": 9.5, "maxy": 9.5}, GridSpec(0, 9, 9, 9, 1), GridSpec(0, 9, 9, 9, 1), areas(spark, ("L", L)), ["name"])
    clusters = spark.createDataFrame([("s", 2)], "station_id string, cluster int")
    day = lambda d: dt.date(2001, 1, d)
    series, located = station_series(repeated, Calendar("2001-01-01", "2001-01-03"), where, clusters=clusters)
    got = series.orderBy("time").select("time", "tmin", "station", "cluster").collect()
    assert [tuple(r) for r in got] == [(day(1), 2.0, "b", 2), (day(2), None, None, 2), (day(3), 7.0, None, 2)]
    assert [r["name"] for r in located.collect()] == ["L"]
    series, _ = station_series(repeated, Calendar("2001-01-01", "2001-01-03"), where, gap_fill=False, daily={"tmin": F.sum})
    assert [tuple(r) for r in series.orderBy("time").select("time", "tmin").collect()] == [(day(1), 7.0), (day(3), 7.0)]


def test_day_of_year_operators_refuse_repeated_days(spark, repeated):
    days = repeated.select("station_id", F.to_date("time").alias("time"), "tmin")
    for run in (doy_moments, doy_percentile):
        with pytest.raises(PySparkException, match="several rows for one day"):
            run(days, "tmin", ["station_id"]).count()
            run(days, "tmin", ["station_id"]).collect()
    assert doy_moments(days.groupBy("station_id", "time").agg(F.min("tmin").alias("tmin")), "tmin", ["station_id"]).count() == 3


def test_period_holds_its_whole_last_day(repeated):
    period = Calendar("2001-01-02", "2001-01-03")
    assert repeated.where(period.between("time")).count() == 3
    assert repeated.where(period.between(F.to_date("time"))).count() == 3

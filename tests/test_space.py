from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from perilspark.functions.temporal import Calendar
from perilspark.operators import columns as C
from perilspark.operators import joins
from perilspark.operators.grid import (
    GridSpec,
    enclosing_slice,
    match_to_grid,
    number_locations,
    regrid_linear,
    regrid_nearest,
    spatial_params,
    total_bounds,
)
from perilspark.operators.nearest import nearest_points
from perilspark.operators.spatial import area_of_interest, box_polygon, polygon_join, polygon_tiles, polygons_from_rings
from perilspark.operators.terrain import terrain, terrain_features
from perilspark.plans.targets import attach_product


def points(spark, rows, names="lon double, lat double"):
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], names)


def test_grid_excludes_far_bounds_and_does_not_drift(spark):
    grid = GridSpec.from_bounds(-69.7, -23.0, -57.4, -9.7, 40)
    assert (grid.nx, grid.ny) == (492, 532)
    rows = grid.points(spark).agg(F.count("*"), F.min("lon"), F.max("lon"), F.min("lat"), F.max("lat")).first()
    assert tuple(rows) == (492 * 532, -69.7, -57.425, -22.975, -9.7)
    assert GridSpec.from_bounds(0, 0, 0, 1, 10).nx == 0


def test_half_way_points_take_the_lower_node(spark):
    grid = GridSpec.from_bounds(0.0, 0.0, 1.0, 1.0, 10)
    df = points(spark, [(0.05, 0.95), (0.06, 0.94), (-5, 9), (5, -9)])
    got = [tuple(r)[2:] for r in match_to_grid(df, grid, "lon", "lat", "x", "y").collect()]
    assert got == [(0.0, 0.9), (0.1, 0.9), (0.0, 1.0), (0.9, 0.1)]


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_points_equal_brute_force_on_clusters(spark, k):
    rng = np.random.default_rng(5)
    dense = rng.normal([10, 10], 0.001, (400, 2))
    spread = rng.uniform(-60, 60, (80, 2))
    samples = np.vstack([dense, spread, spread[:5]]).round(7)
    targets = np.vstack([rng.uniform(-70, 70, (40, 2)), rng.normal([10, 10], 0.001, (20, 2)), spread[:3]]).round(7)
    got = nearest_points(points(spark, targets), points(spark, samples), k).orderBy("rank").collect()
    want = brute.nearest(targets, np.unique(samples, axis=0), k)
    found = {}
    for r in got:
        found.setdefault((r["target_lon"], r["target_lat"]), []).append((r["lon"], r["lat"]))
    assert found == want


def test_nearest_points_with_fewer_samples_than_k(spark):
    got = nearest_points(points(spark, [(0, 0)]), points(spark, [(1, 0), (0, 3)]), 5).orderBy("rank").collect()
    assert [(r["lon"], r["distance"]) for r in got] == [(1.0, 1.0), (0.0, 3.0)]


def test_nearest_regrid_prefers_the_larger_source(spark):
    cells = points(spark, [(0, 0, 1), (1, 0, 2), (0, 1, 3), (1, 1, 4)], "lon double, lat double, v double")
    got = regrid_nearest(cells, GridSpec(0.5, 0.4, 2, 1, 1))
    assert sorted(tuple(r) for r in got.collect()) == [(0.5, 0.4, 2.0), (1.5, 0.4, 2.0)]


def test_regrid_to_some_nodes_equals_whole_regrid(spark):
    rng = np.random.default_rng(1)
    rows = [(i / 4, j / 4, t, rng.random()) for i in range(6) for j in range(5) for t in range(3)]
    cells = points(spark, rows, "lon double, lat double, t double, v double")
    grid = GridSpec(-0.2, 1.3, 14, 13, 10)
    whole = regrid_nearest(cells, grid)
    nodes = grid.points(spark).where(F.col("lon") > F.col("lat"))
    some = regrid_nearest(cells, grid, nodes=nodes)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.join(nodes, ["lon", "lat"], "left_semi").select(*some.columns).collect()))


def test_linear_regrid(spark):
    cells = points(spark, [(0, 0, 0), (2, 0, 2), (0, 2, 4), (2, 2, 6)], "lon double, lat double, v double")
    got = {(r["lon"], r["lat"]): r["v"] for r in regrid_linear(cells, GridSpec(0, 3, 4, 4, 1), ["v"]).collect()}
    assert got == {(x, y): x + 2 * y for x in (0.0, 1.0, 2.0) for y in (0.0, 1.0, 2.0)}
    gap = cells.withColumn("v", F.when(F.col("v") < 6, F.col("v")))
    got = {(r["lon"], r["lat"]): r["v"] for r in regrid_linear(gap, GridSpec(0, 3, 4, 4, 1), ["v"]).collect()}
    assert got[(1.0, 1.0)] is None and got[(1.0, 0.0)] == 1.0


def test_enclosing_slice(spark):
    cells = points(spark, [(x, y) for x in range(5) for y in range(5)])
    box = {"minx": 1.2, "maxx": 2.2, "miny": 3.5, "maxy": 9.0}
    assert sorted(map(tuple, enclosing_slice(cells, box).collect())) == [(x, y) for x in (1.0, 2.0, 3.0) for y in (3.0, 4.0)]


def test_location_numbers(spark):
    df = points(spark, [(2, 1), (1, 5), (1, 7), (1, 5)])
    got = {(r["lon"], r["lat"]): r["location_id"] for r in number_locations(df).collect()}
    assert got == {(1.0, 7.0): "ID-001", (1.0, 5.0): "ID-002", (2.0, 1.0): "ID-003"}
    with pytest.raises(ValueError):
        number_locations(df, "x", "y")


L_SHAPE = [(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]


@pytest.fixture(scope="module")
def shapes(spark):
    far = [(100, 40), (130, 40), (115, 60)]
    return polygons_from_rings(spark, ["name"], [("L", L_SHAPE), ("box", [(1, 1), (3, 1), (3, 3), (1, 3)]), ("far", far)])


@pytest.mark.parametrize("broadcast", [True, False])
def test_polygons_equal_ray_test(spark, shapes, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(joins.is_small, "__defaults__", (None, 0))
        monkeypatch.setattr(joins.broadcast_if_small, "__defaults__", (None, 0))
    rng = np.random.default_rng(2)
    pts = np.vstack([rng.uniform(-1, 5, (300, 2)), rng.uniform([95, 35], [135, 65], (200, 2))]).round(3)
    got = polygon_join(points(spark, pts), shapes, ["name"])
    assert ("BroadcastHashJoin" in got._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))) == broadcast or broadcast is False
    rings = {"L": L_SHAPE, "box": [(1, 1), (3, 1), (3, 3), (1, 3)], "far": [(100, 40), (130, 40), (115, 60)]}
    want = sorted((float(x), float(y), n) for x, y in pts for n, ring in rings.items() if brute.inside(x, y, ring))
    assert sorted(map(tuple, got.collect())) == want


def test_ring_of_many_edges(spark):
    turn = np.linspace(0, 2 * np.pi, 2000, endpoint=False)
    reach = 1 + 0.2 * np.sin(37 * turn)
    ring = np.stack([25 * reach * np.cos(turn), 16 * reach * np.sin(turn)], axis=1).round(6).tolist()
    shapes = polygons_from_rings(spark, ["name"], [("wave", ring), ("wave", ring)])
    pts = np.random.default_rng(6).uniform([-32, -21], [32, 21], (400, 2)).round(4)
    got = sorted(map(tuple, polygon_join(points(spark, pts), shapes, ["name"]).collect()))
    want = sorted((float(x), float(y), "wave") for x, y in pts if brute.inside(x, y, ring))
    assert got == sorted(want * 2)
    assert polygon_tiles(shapes, ["name"]).agg(F.sum(F.size("_edges"))).first()[0] < 4 * 2000 * 2


def test_polygon_border_rule_and_left_join(spark, shapes):
    df = points(spark, [(0, 0), (4, 1), (0, 1), (1, 4), (1.5, 1.5), (50, 50)])
    got = sorted((r["lon"], r["lat"], r["name"] or "") for r in polygon_join(df, shapes, ["name"], "left").collect())
    assert got == [(0.0, 0.0, "L"), (0.0, 1.0, "L"), (1.0, 4.0, ""), (1.5, 1.5, "L"), (1.5, 1.5, "box"), (4.0, 1.0, ""), (50.0, 50.0, "")]


def test_bounds_of_a_selection(spark, shapes):
    assert total_bounds(shapes) == {"minx": 0.0, "miny": 0.0, "maxx": 130.0, "maxy": 60.0}
    assert spatial_params(shapes, include={"name": ["box"]}) == {"minx": 1.0, "miny": 1.0, "maxx": 3.0, "maxy": 3.0}
    with pytest.raises(ValueError):
        spatial_params(shapes, include={"name": ["none"]})
    assert box_polygon(spark, 0, 1, 2, 3).first()["location_id"] == "ID-000"


def test_area_of_interest(spark, shapes):
    bounds, areas = area_of_interest(spark, shapes.unionByName(shapes), exclude={"name": ["far"]})
    assert bounds == {"minx": 0.0, "miny": 0.0, "maxx": 4.0, "maxy": 4.0}
    assert {r["name"]: r["location_id"] for r in areas.collect()} == {"L": "ID-001", "box": "ID-002"}
    bounds, areas = area_of_interest(spark, bounds={"minx": 0.11, "miny": 0.0, "maxx": 0.55, "maxy": 1.0})
    assert bounds == {"minx": 0.1, "miny": 0.0, "maxx": 0.6, "maxy": 1.0} and areas.first()["location_id"] == "ID-000"
    with pytest.raises(ValueError):
        area_of_interest(spark)
    with pytest.raises(ValueError):
        area_of_interest(spark, shapes, include={"name": ["none"]})


def raster(spark, z, lons=None, lats=None):
    lons = lons if lons is not None else np.arange(z.shape[1]) * 0.5
    lats = lats if lats is not None else -np.arange(z.shape[0]) * 0.5
    rows = [(lons[j], lats[i], z[i, j]) for i in range(z.shape[0]) for j in range(z.shape[1])]
    return points(spark, rows, "lon double, lat double, altitude double")


def grid_of(df, name, shape):
    out = df.orderBy(F.desc("lat"), "lon").select(name).collect()
    return np.array([np.nan if r[0] is None else r[0] for r in out]).reshape(shape)


@pytest.mark.parametrize("shape", [(9, 12), (1, 7), (6, 1), (3, 3)])
def test_box_features_equal_brute_force(spark, shape):
    z = np.random.default_rng(4).uniform(100, 900, shape).round(1)
    out = terrain(raster(spark, z), tpi_windows=(3, 5, 15), tdi_windows=(5,)).persist()
    for w in (3, 5, 15):
        np.testing.assert_allclose(grid_of(out, f"TPI_{w}", shape), z - brute.box(z, w, np.mean), atol=1e-9)
    spread = (brute.box(z, 5, np.max) - brute.box(z, 5, np.min)) / brute.box(z, 5, np.mean)
    np.testing.assert_allclose(grid_of(out, "TDI_5", shape), spread, atol=1e-9)


@pytest.mark.parametrize("absent", [True, False])
def test_terrain_beside_a_missing_cell(spark, absent):
    z = np.full((5, 6), 7.0)
    z[2, 2] = np.nan
    gap = F.isnan("altitude")
    cells = raster(spark, z)
    cells = cells.where(~gap) if absent else cells.withColumn("altitude", F.when(~gap, F.col("altitude")))
    out = terrain(cells, tpi_windows=(3,), tdi_windows=(3,), slope=True, aspect=True).orderBy(F.desc("lat"), "lon").collect()
    assert len(out) == 29 + (not absent)
    near = [r for r in out if r["TPI_3"] is None]
    assert len(near) == 8 + (not absent) and all(r["TDI_3"] is None for r in near)
    assert all(r["aspect"] is None for r in near if r["altitude"] is not None)  # it does not look at its own cell
    assert all(r["TPI_3"] == 0 and r["TDI_3"] == 0 for r in out if r not in near)
    assert sum(r["slope"] is None for r in out) == 4 + (not absent)


def test_zero_mean_box_and_even_window(spark):
    z = np.array([[1.0, -1.0, 0.0]] * 3)
    out = terrain(raster(spark, z), tdi_windows=(3,))
    assert grid_of(out, "TDI_3", z.shape)[1, 1] == 0.0
    with pytest.raises(ValueError):
        terrain(raster(spark, z), tpi_windows=(4,))


def test_slope_on_uneven_axes(spark):
    rng = np.random.default_rng(8)
    lons, lats = np.array([0, 0.5, 1.5, 1.75, 3.0]), np.array([2.0, 1.0, 0.75, -1.0])
    z = rng.uniform(0, 10, (4, 5))
    gy, gx = np.gradient(z, lats, lons)
    out = terrain(raster(spark, z, lons, lats), slope=True, z_factor=0.1)
    np.testing.assert_allclose(grid_of(out, "slope", z.shape), np.degrees(np.arctan(0.1 * np.hypot(gx, gy))), atol=1e-9)
    compat = terrain(raster(spark, z, lons, lats), slope=True, z_factor=0.1, compat_gradient=True)
    np.testing.assert_allclose(grid_of(compat, "slope", z.shape), np.degrees(np.arctan(0.1 * np.hypot(gx / z, gy))), atol=1e-9)


def test_aspect_of_planes(spark):
    j, i = np.meshgrid(np.arange(4.0), np.arange(4.0))
    flat = grid_of(terrain(raster(spark, 0 * i + 5), aspect=True), "aspect", (4, 4))
    assert flat[1, 1] == -1 and math.isnan(flat[0, 1])
    # Ground falling to the east faces east, falling to the south faces south.
    assert grid_of(terrain(raster(spark, 10 - j), aspect=True), "aspect", (4, 4))[1, 1] == pytest.approx(90)
    assert grid_of(terrain(raster(spark, 10 - i), aspect=True), "aspect", (4, 4))[1, 1] == pytest.approx(180)


def test_terrain_features_on_360_degree_longitudes(spark):
    z = np.random.default_rng(3).uniform(1, 9, (5, 5))
    cells = raster(spark, z, 290 + np.arange(5) * 0.5).withColumnsRenamed({"lon": "longitude", "lat": "latitude", "altitude": "h"})
    out = terrain_features(cells, (5,), (5,)).orderBy("lon").first()
    assert out["lon"] == -70.0 == out["longitude"]


def test_column_rules(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    assert [r["v"] for r in C.include_exclude(df, exclude={"k": ["a"]}).collect()] == [2, 3]
    assert [r["v"] for r in C.include_exclude(df, include={"k": ["a"]}).collect()] == [1]
    with pytest.warns(UserWarning):
        assert C.include_exclude(df, include={"zzz": [1]}).count() == 3
    assert C.select_locations(df.withColumn("location_id", F.lit(0)), "k").columns == ["location_id", "v", "location_id_orig"]
    with pytest.raises(ValueError):
        C.select_locations(df, None)
    with pytest.raises(KeyError):
        C.select_locations(df, "nope")
    with pytest.raises(KeyError):
        C.canonical_names(df, "wind")
    with pytest.raises(KeyError):
        C.canonical_names(df, "t2m")
    with pytest.raises(ValueError):
        C.drop_constant_columns(df, ["v"])
    assert C.drop_constant_columns(df.withColumn("one", F.lit(1)), ["one"]).columns == ["k", "v"]
    with pytest.warns(UserWarning):
        assert dict(C.as_categories(df, ["v", "absent"]).dtypes)["v"] == "string"
    assert C.find_coordinates(spark.createDataFrame([(1, 2)], "X int, valid_time int")) == {"lon": "X", "lat": None, "time": "valid_time"}


def test_product_coordinates_stored_as_float(spark):
    grid = GridSpec(-69.6, -10.0, 10, 10, 10)
    days = Calendar("2000-01-01", "2000-01-02")
    stations = spark.sql("select 1 as station_id, -69.31D as lon, -10.28D as lat, date'2000-01-01' as time")
    product = spark.sql("select cast(-69.3 as float) as lon, cast(-10.3 as float) as lat, date'2000-01-01' as time, 5D as v union all select cast(-69.25 as float), cast(-10.3 as float), date'2000-01-01', 9D")
    out = attach_product(stations, stations, product, grid, "v", "product", days).collect()
    assert [r["product"] for r in out] == [5.0]

"""Feature alignment: native-grid merge against regridding every set on its own."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from perilspark.functions.temporal import Calendar
from perilspark.operators.grid import GridSpec
from perilspark.plans.master import FeatureSet, align_features, training_table

NATIVE, COARSE = GridSpec(0, 3, 4, 4, 1), GridSpec(0, 3, 2, 2, 1)
TARGET = GridSpec(0, 3, 7, 7, 2)
DAYS = Calendar("2024-01-01", "2024-01-04")


def day(i: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


@pytest.fixture(scope="module")
def sets(spark):
    rng = np.random.default_rng(2)
    cells = [(float(x), float(y)) for x in range(4) for y in range(4)]
    leads = [(x, y, day(d), s, float(rng.integers(0, 50))) for x, y in cells for d in (0, 1, 9) for s in (1, 2, 3) if (x, y) != (1.0, 1.0)]
    rain = [(x, y, day(d), float(rng.integers(0, 50))) for x, y in cells for d in (1, 2) if x < 2]
    coarse = [(float(x), float(y), day(1), 5.0 * x + y) for x in (0, 1) for y in (2, 3)]
    static = [(x, y, 100 * x + y) for x, y in cells if x > 0]
    return (
        leads, rain, coarse, static,
        [
            FeatureSet(spark.createDataFrame(leads, "lon double, lat double, time date, step int, t double"), NATIVE),
            FeatureSet(spark.createDataFrame(rain, "lon double, lat double, time date, r double"), NATIVE),
            FeatureSet(spark.createDataFrame(coarse, "lon double, lat double, time date, c double"), COARSE),
            FeatureSet(spark.createDataFrame(static, "lon double, lat double, z double")),
        ],
    )


def nearest(value: float, lines) -> float:
    return min(sorted(lines, reverse=True), key=lambda line: round(abs(line - value), 9))


def expected(leads, rain, coarse, static, with_coarse=True):
    """Every set placed on the target grid on its own, then merged by key."""
    out: dict = {}
    sx, sy = sorted({s[0] for s in static}), sorted({s[1] for s in static})
    for i in range(7):
        for j in range(7):
            x, y = round(i / 2, 6), round(3 - j / 2, 6)
            fine = nearest(x, range(4)), nearest(y, range(4))
            rough = nearest(x, (0, 1)), nearest(y, (2, 3))
            z = {s[:2]: s[2] for s in static}.get((nearest(x, sx), nearest(y, sy)))
            for d in range(4):
                t = [r[4] for r in leads if r[:2] == fine and r[2] == day(d) and r[3] in (2, 3)]
                r = [v[3] for v in rain if v[:2] == fine and v[2] == day(d)]
                c = [v[3] for v in coarse if v[:2] == rough and v[2] == day(d)] if with_coarse else []
                if t or r or c or z is not None:
                    out[x, y, day(d)] = (sum(t) / len(t) if t else None, r[0] if r else None, c[0] if c else None, z)
    return out


def shown(df):
    columns = [c if c in df.columns else None for c in "trcz"]
    return {(r["lon"], r["lat"], r["time"]): tuple(r[c] if c else None for c in columns) for r in df.collect()}


def test_alignment(sets):
    *tables, given = sets
    df = align_features(given, TARGET, DAYS, [2, 3])
    assert shown(df) == expected(*tables) and df.count() == len(expected(*tables))


def test_days_without_a_dynamic_set_keep_their_static_row(sets):
    *tables, given = sets
    got = shown(align_features([given[0], given[3]], TARGET, DAYS, [2, 3]))
    assert {k: (v[0], v[3]) for k, v in got.items()} == {
        k: (v[0], v[3]) for k, v in expected(tables[0], [], [], tables[3], False).items()
    }
    only = shown(align_features([given[3]], TARGET, DAYS, [2, 3]))
    assert set(only.values()) <= {(None, None, None, s[2]) for s in tables[3]} and len(only) == 49 * 4


def test_one_exchange_for_sets_of_one_grid(sets):
    plan = align_features(sets[4][:2], TARGET, DAYS, [2, 3])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_same_value_in_two_sets(spark, sets):
    """The first set that has a value counts, as for values of one name on two grids."""
    leads = sets[4][0]
    other = FeatureSet(spark.createDataFrame([(1.0, 1.0, day(0), 7.0)], "lon double, lat double, time date, t double"), NATIVE)
    got = shown(align_features([leads, other], NATIVE, DAYS, [2, 3]))
    assert got[1.0, 1.0, day(0)][0] == 7.0
    want = expected(*sets[:4], with_coarse=False)
    assert all(got[k][0] == v[0] for k, v in want.items() if v[0] is not None and k in got)


def test_training_table_equals_features_at_stations(spark, sets):
    *tables, given = sets
    target = spark.createDataFrame(
        [(0.1, 2.9, day(0), 1, "a"), (0.2, 2.9, day(1), 0, "b"), (2.4, 1.2, day(3), 1, "c"), (2.4, 1.2, day(2), None, "d"), (0.1, 2.9, day(9), 1, "e")],
        "lon double, lat double, time date, y int, name string",
    )
    df = training_table(given, target, "y", TARGET, DAYS, [2, 3])
    features = expected(*tables)
    want = {}
    for lon, lat, t, y, name in target.collect():
        node = min([i / 2 for i in range(7)], key=lambda v: abs(v - lon)), min([i / 2 for i in range(7)], key=lambda v: abs(v - lat))
        if y is not None and (*node, t) in features:
            want[name] = (lon, lat, t, *features[(*node, t)], y)
    got = {r["name"]: (r["lon"], r["lat"], r["time"], r["t"], r["r"], r["c"], r["z"], r["y"]) for r in df.collect()}
    assert got == want and set(want) == {"a", "b", "c"}

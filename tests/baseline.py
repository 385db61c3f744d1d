"""Time the plain single-thread twins against the operators on equal input.

Usage: python tests/baseline.py [folder] [stations]

The day-of-year operators run on the given tables and, to see growth, on
sixteen years of daily values for a number of stations.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

import brute  # noqa: E402
import numpy as np  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from checks.spatial_queries import part_raster  # noqa: E402
from checks.target_queries import nation_records  # noqa: E402
from perilspark.functions.temporal import Calendar  # noqa: E402
from perilspark.operators.climatology import doy_moments, doy_percentile  # noqa: E402
from perilspark.operators.terrain import terrain  # noqa: E402
from perilspark.session import build_session, materialise  # noqa: E402


def clock(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 2)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def station_years(spark, stations: int):
    days = Calendar("1995-01-01", "2010-12-31").expand(spark.range(stations).withColumnRenamed("id", "station_id"))
    return materialise(days.withColumn("v", F.round(F.abs(F.hash("station_id", "time") % 1000) / 10, 1)), "baseline-years")


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    stations = int(sys.argv[2]) if len(sys.argv) > 2 else 200
    spark = build_session("baseline", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    pairs = {}
    for kind, series in (("orders", materialise(nation_records(spark, folder, "v"), "baseline-series")), ("16 years", station_years(spark, stations))):
        local = series.toPandas()
        pairs[f"day-of-year percentile, {kind}, {len(local)} rows"] = (
            lambda p=local: brute.doy_percentile(p, "v", "station_id", 3), lambda d=series: run(doy_percentile(d, "v", ["station_id"], 3)))
        pairs[f"day-of-year moments, {kind}, {len(local)} rows"] = (
            lambda p=local: brute.doy_moments(p, "v", "station_id", 7), lambda d=series: run(doy_moments(d, "v", ["station_id"], 7)))
    cells = materialise(part_raster(spark, folder), "baseline-raster")
    z = cells.toPandas().sort_values(["lat", "lon"], ascending=[False, True])["altitude"].to_numpy().reshape(-1, 50)
    pairs[f"terrain boxes 5, 15, 25, {z.size} cells"] = (
        lambda: [brute.box(z, w, np.mean) for w in (5, 15, 25)], lambda: run(terrain(cells, (5, 15, 25))))
    for name, (plain, ours) in pairs.items():
        ours()  # the JVM compiles the plan once
        print(f"{name}: plain {clock(plain)} s, operator {clock(ours)} s")


if __name__ == "__main__":
    main()

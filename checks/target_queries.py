"""Whole target tables: stations, gridded product, polygons and grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from perilspark.functions.temporal import Calendar
from perilspark.operators.bias import with_monthly_bias
from perilspark.operators.calendar import daily_series
from perilspark.operators.grid import GridSpec
from perilspark.plans.targets import ColdParams, RainParams, TargetArea, attach_product, create_target, station_series

from . import rounded, table
from .climate_queries import TWO_SOURCES, two_sources
from .series_queries import _ahead, doy_moments_sql, percentile_sql
from .spatial_queries import _X, _Y, AREA_EDGES, hits_sql, nation_areas

PERIOD = Calendar("1995-01-01", "2001-12-31")
PRODUCT_GRID = GridSpec(-69.6, -10.0, 10, 10, 1)
BOUNDS = {"minx": -69.0, "miny": -22.5, "maxx": -57.0, "maxy": -10.0}


def nation_records(spark, folder, value):
    """Daily order value per nation, at a point in or next to its area."""
    n = F.col("c_nationkey")
    x, y = F.round(-69.61 + (n % 5) * 2.4, 4), F.round(-22.91 + F.floor(n / 5) * 2.6, 4)
    orders = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    keyed = orders.withColumns(
        {"station_id": n, "lon": F.round(x + 0.5 + (n % 3) * 0.7, 4), "lat": F.round(y + 0.7 + (n % 2) * 1.0, 4)}
    )
    return daily_series(keyed, ["station_id", "lon", "lat"], "o_orderdate", **{value: F.round(F.sum("o_totalprice") / 1000, 2)})


def product_cells(spark, folder, value):
    """Daily shipped value per supplier cell of the product grid."""
    k = F.col("l_suppkey")
    items = table(spark, folder, "lineitem").select(
        F.round(F.lit(-69.6) + k % 10, 6).alias("lon"), F.round(F.lit(-10.0) - F.floor(k / 10) % 10, 6).alias("lat"),
        F.to_date("l_shipdate").alias("time"), "l_extendedprice",
    )
    return items.groupBy("lon", "lat", "time").agg(F.round(F.sum("l_extendedprice") / 1000, 2).alias(value))


def target_area(spark, folder):
    return TargetArea(BOUNDS, GridSpec.from_bounds(-69.7, -23.0, -57.5, -9.8, 10), PRODUCT_GRID, nation_areas(spark, folder), ["n_nationkey"])


def coldspell_target(spark, folder):
    out = create_target(
        "tmin", nation_records(spark, folder, "tmin"), product_cells(spark, folder, "tmin"), PERIOD, target_area(spark, folder),
        ColdParams([0.5, 1], [3]),
    )
    flags = [f"{p}_{t}sd{d}_final" for t in ("0.5", "1") for p, d in (("flag_tmin", ""), ("n", "_next3d"), ("target", "_3d"))]
    shown = rounded(out, 5, "tmin", "tmin_chirts_adj")
    return shown.select(
        "station_id", "n_nationkey", "time", "lon_station", "lat_station", "lon", "lat", "tmin_lfa", "tmin_chirts", "tmin_chirts_adj", "tmin",
        *[F.col(f"`{c}`").cast("bigint").alias(c.replace(".", "_")) for c in flags],
    )


def rainfall_target(spark, folder):
    out = create_target(
        "prcp", nation_records(spark, folder, "prcp"), product_cells(spark, folder, "prcp"), PERIOD, target_area(spark, folder),
        RainParams([90, 95], [3]), exclude={"station_id": [3]},
    )
    shown = rounded(rounded(out, 5, "prcp", "bias_factor"), 3, "perc_prcp_next3d_final", "prcp_next3d_final")
    return shown.select(
        "station_id", "n_nationkey", "time", "time_orig", "lon_station", "lat_station", "lon", "lat", "prcp_lfa", "prcp_chirps", "bias_factor", "prcp",
        F.col("prcp_next3d_final").alias("next3d"), F.col("perc_prcp_next3d_final").alias("perc3d"),
        *[F.col(f"target_P{p}_3d_final").cast("bigint").alias(f"target_P{p}") for p in (90, 95)],
    )


def source_merge(spark, folder):
    """Stations with records and product, on records only (no gap filling)."""
    series, areas = station_series(nation_records(spark, folder, "obs"), PERIOD, target_area(spark, folder), gap_fill=False)
    merged = attach_product(series, areas, product_cells(spark, folder, "cell"), PRODUCT_GRID, "cell", "product", PERIOD)
    return merged.join(areas.select("station_id", "n_nationkey"), "station_id").select("station_id", "n_nationkey", "time", "lon", "lat", "obs", "product")


def monthly_bias_in_place(spark, folder):
    out = with_monthly_bias(two_sources(spark, folder), ["station_id"], "observed", "product", "adjusted")
    return rounded(out, 4, "bias_factor", "adjusted").select("station_id", "time", "bias_factor", "adjusted")


QUERIES = {
    "coldspell_target": coldspell_target,
    "rainfall_target": rainfall_target,
    "source_merge": source_merge,
    "monthly_bias_in_place": monthly_bias_in_place,
}


#: A station's value of a day, from all orders.
_DAY = "round(sum(o_totalprice) / 1000, 2)"


def _base_sql(value: str, shift: bool, closed: bool, exclude: str, fill: bool = True, daily: str = _DAY) -> str:
    """CTEs up to ``merged``: station days with observed and product value."""
    box = "lon between -69.0e0 and -57.0e0 and lat between -22.5e0 and -10.0e0" if closed else "lon > -69.0e0 and lon < -57.0e0 and lat > -22.5e0 and lat < -10.0e0"
    day = "cast(time - interval 1 day as date)" if shift else "time"
    node_x = "round(-69.6e0 + greatest(0, least(9, ceil(round(lon + 69.6e0, 6) - 0.5))), 6)"
    node_y = "round(-10e0 - greatest(0, least(9, floor(round(-10e0 - lat, 6) + 0.5))), 6)"
    days = f"stations cross join (select cast(unnest(generate_series(date '1995-01-01', date '2001-12-31', interval 1 day)) as date) as time) d"
    source = f"(select stations.*, d.time from {days}) s left join obs o on o.station_id = s.station_id and o.time = s.time" if fill else \
        "(select stations.*, obs.time from stations join obs using (station_id)) s join obs o on o.station_id = s.station_id and o.time = s.time"
    return f"""
        edges as ({AREA_EDGES}),
        keyed as (select n_nationkey, o_orderdate, o_totalprice, round({_X} + 0.5e0 + (n_nationkey % 3) * 0.7e0, 4) as lon,
                         round({_Y} + 0.7e0 + (n_nationkey % 2) * 1.0e0, 4) as lat
                  from (select c_nationkey as n_nationkey, o_orderdate, o_totalprice from orders join customer on o_custkey = c_custkey)),
        daily as (select n_nationkey as station_id, lon, lat, cast(o_orderdate as date) as time, {daily} as v from keyed group by all),
        inside as (select * from daily where {box} and time between date '1995-01-01' and date '2001-12-31' {exclude}),
        spots as (select distinct station_id, lon, lat from inside),
        located as ({hits_sql('spots', 'station_id')}),
        stations as (select spots.* from spots where station_id in (select station_id from located)),
        obs as (select station_id, {day} as time, time as time_orig, v from inside),
        cells as (select round(-69.6e0 + l_suppkey % 10, 6) as lon, round(-10e0 - (l_suppkey // 10) % 10, 6) as lat, cast(l_shipdate as date) as time,
                         round(sum(l_extendedprice) / 1000, 2) as product from lineitem group by 1, 2, 3),
        merged0 as (select s.station_id, s.lon, s.lat, s.time, o.time_orig, o.v as obs, {node_x} as px, {node_y} as py from {source}),
        merged as (select m.*, c.product from merged0 m left join cells c on c.lon = px and c.lat = py and c.time = m.time)
    """


_NODE = """round(-69.7e0 + greatest(0, least(121, ceil(round((lon + 69.7e0) * 10, 6) - 0.5))) / 10e0, 6) as lon,
    round(-9.8e0 - greatest(0, least(131, floor(round((-9.8e0 - lat) * 10, 6) + 0.5))) / 10e0, 6) as lat"""
_M = "over (partition by station_id, month(time))"


def _cold_sql(daily: str = _DAY) -> str:
    flags = ", ".join(f"case when b.tmin <= c.m - {t} * c.sd then 1 else 0 end as f{i}" for i, t in enumerate((0.5, 1)))
    cols = ", ".join(
        f"""cast(f{i} as bigint) as "flag_tmin_{t}sd_final", cast({_ahead(f'sum(f{i})', 3)} as bigint) as "n_{t}sd_next3d_final",
            cast(case when {_ahead(f'sum(f{i})', 3)} >= 3 then 1 else 0 end as bigint) as "target_{t}sd_3d_final" """
        for i, t in enumerate(("0_5", "1"))
    )
    return f"""
        with {_base_sql('tmin', False, True, '', daily=daily)},
        scaled as (select *, avg(obs) {_M} + stddev_samp(obs) {_M} / nullif(stddev_samp(product) {_M}, 0) * (product - avg(product) {_M}) as adj from merged),
        b as (select *, (coalesce(obs, adj) + coalesce(adj, obs)) / 2 as tmin, dayofyear(time) as doy from scaled),
        src as (select station_id, time, doy, tmin as value from b), clim as ({doy_moments_sql('src', 7)}),
        flagged as (select b.*, {flags} from b left join clim c on c.station_id = b.station_id and c.doy = b.doy),
        runs as (select *, {cols} from flagged)
        select r.station_id, l.n_nationkey, time, r.lon as lon_station, r.lat as lat_station, {_NODE.replace('(lon', '(r.lon').replace('- lat', '- r.lat')},
               obs as tmin_lfa, product as tmin_chirts, round(adj, 5) as tmin_chirts_adj, round(tmin, 5) as tmin,
               {', '.join(f'"{p}_{t}sd{d}_final"' for t in ('0_5', '1') for p, d in (('flag_tmin', ''), ('n', '_next3d'), ('target', '_3d')))}
        from runs r join located l on l.station_id = r.station_id"""


def _rain_sql(daily: str = _DAY) -> str:
    return f"""
        with {_base_sql('prcp', True, False, 'and station_id <> 3', daily=daily)},
        monthly as (select station_id, year(time) as y, month(time) as month, coalesce(sum(product), 0) as p, coalesce(sum(obs), 0) as o
                    from merged group by 1, 2, 3 having count(obs) >= 26),
        f as (select station_id, month, case when avg(p) = 0 then 1 else avg(o) / avg(p) end as bf from monthly group by 1, 2),
        b as (select m.*, coalesce(bf, 1) as bias_factor, 0.5 * coalesce(obs, 0) + 0.5 * product * coalesce(bf, 1) as prcp, dayofyear(m.time) as doy
              from merged m left join f on f.station_id = m.station_id and f.month = month(m.time)),
        s as (select *, round({_ahead('sum(prcp)', 3)}, 6) as next3d from b),
        p as ({percentile_sql('s', 'next3d', 3)})
        select s.station_id, l.n_nationkey, s.time, time_orig, s.lon as lon_station, s.lat as lat_station, {_NODE.replace('(lon', '(s.lon').replace('- lat', '- s.lat')},
               obs as prcp_lfa, product as prcp_chirps, round(bias_factor, 5) as bias_factor, round(prcp, 5) as prcp, round(next3d, 3) as next3d, round(p.perc, 3) as perc3d,
               cast(case when p.perc >= 90 then 1 else 0 end as bigint) as "target_P90", cast(case when p.perc >= 95 then 1 else 0 end as bigint) as "target_P95"
        from s join located l on l.station_id = s.station_id left join p on p.station_id = s.station_id and p.time = s.time"""


ORACLES = {
    "coldspell_target": _cold_sql(),
    "rainfall_target": _rain_sql(),
    "source_merge": f"""
        with {_base_sql('obs', False, True, '', fill=False)}
        select m.station_id, n_nationkey, time, lon, lat, obs, product from merged m join located l on l.station_id = m.station_id""",
    "monthly_bias_in_place": f"""
        with {TWO_SOURCES}, monthly as (
            select station_id, year(time) as y, month(time) as month, coalesce(sum(product), 0) as p,
                   coalesce(sum(observed), 0) as o, count(observed) as n from src group by 1, 2, 3 having count(observed) >= 26),
        f as (select station_id, month, case when avg(p) = 0 then 1 else avg(o) / avg(p) end as bf from monthly group by 1, 2)
        select src.station_id, src.time, round(coalesce(bf, 1), 4) as bias_factor, round(product * coalesce(bf, 1), 4) as adjusted
        from src left join f on f.station_id = src.station_id and f.month = month(src.time)""",
}

"""Polygon tables and areas of interest, repeated station readings, and the plainer steps of a run."""

from __future__ import annotations

from pyspark.sql import functions as F

from perilspark.functions.temporal import Calendar, resolve_period
from perilspark.operators.columns import as_categories, categorical_columns
from perilspark.operators.forecast import lead_days, select_leads
from perilspark.operators.spatial import area_of_interest, edges_of_ring, with_bounds
from perilspark.plans.targets import ColdParams, RainParams, create_target
from perilspark.session import run_dir
from perilspark.sources.geometries import join_polygons, read_polygons, write_polygons
from perilspark.sources.tables import extract

from . import rounded, table
from .climate_queries import LEADS, lead_table
from .spatial_queries import AREA_EDGES, nation_areas
from .target_queries import PERIOD, _cold_sql, _rain_sql, product_cells, target_area

# Parcels: one box per part; some are listed twice, from another corner or the other way round.
OWNERS = ["Brand#1", "Brand#2", "Agent"]


def parcels(spark, folder):
    k = F.col("p_partkey")
    x, y = F.round(-69.63 + (k % 50) * 0.25, 4), F.round(-10.01 - F.floor(k / 50) * 0.25, 4)
    corner = lambda dx, dy: F.struct(F.round(x + dx, 4).alias("x"), F.round(y + dy, 4).alias("y"))
    ring = [corner(0, 0), corner(0.25, 0), corner(0.25, 0.25), corner(0, 0.25)]
    part = table(spark, folder, "part")
    listed = part.select(F.col("p_brand").alias("owner"), "p_partkey", edges_of_ring(F.array(*ring)).alias("edges"))
    turned = part.where(k % 3 == 0).select(
        F.when(k % 2 == 0, "Agent").otherwise("Zone").alias("owner"), "p_partkey", edges_of_ring(F.array(*ring[2:], *ring[:2])).alias("edges")
    )
    reverse = part.where(k % 5 == 0).select(F.lit(None).cast("string").alias("owner"), "p_partkey", edges_of_ring(F.array(*ring[::-1])).alias("edges"))
    return with_bounds(listed.unionByName(turned).unionByName(reverse))


_PARCELS = """
    select p_partkey, round(-69.63e0 + (p_partkey % 50) * 0.25e0, 4) as minx, round(-10.01e0 - (p_partkey // 50) * 0.25e0, 4) as miny,
           case when p_partkey % 5 = 0 then null when p_partkey % 6 = 0 then least(p_brand, 'Agent') when p_partkey % 3 = 0 then least(p_brand, 'Zone')
                else p_brand end as owner from part
"""


def area_ids(spark, folder):
    """Distinct parcels with ids, those of some owners, and the area's bounds on every row."""
    grown, areas = area_of_interest(spark, parcels(spark, folder), include={"owner": OWNERS})
    ends = {f"area_{name}": F.lit(value) for name, value in grown.items()}
    return areas.select("location_id", "owner", "p_partkey", "minx", "miny", F.size("edges").cast("bigint").alias("n_edges"), *[c.alias(n) for n, c in ends.items()])


SCAN = {"minx": -66.0, "miny": -19.0, "maxx": -60.2, "maxy": -10.2}


def polygon_scan(spark, folder):
    """Parcels written as a polygon table; those that meet some bounds are read back."""
    path = run_dir(spark, "parcels")
    write_polygons(parcels(spark, folder), path)
    return read_polygons(spark, path, SCAN).select("owner", "p_partkey", "minx", "miny", "maxx", "maxy", F.size("edges").cast("bigint").alias("n_edges"))


#: A coast has this many corners on its jagged side.
COAST = 9_997


def coasts(spark, folder):
    """A coast per region: 10,000 edges, a square hole and a three-cornered one."""
    west = F.round(-69.6 + F.col("r_regionkey") * 2.4, 4)
    at = lambda x, y: F.struct(F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))
    hole = lambda *corners: edges_of_ring(F.array(*[at(west + dx, F.lit(y)) for dx, y in corners]))
    shore = F.transform(F.sequence(F.lit(0), F.lit(COAST - 1)), lambda i: at(west + 2.3 - (i * 7919 % 101) / 1000, -22.0 + i * 0.001))
    ring = F.concat(F.array(at(west, F.lit(-22.5)), at(west + 2.3, F.lit(-22.5))), shore, F.array(at(west, F.lit(-12.0))))
    holes = F.concat(hole((0.4, -20.0), (1.2, -20.0), (1.2, -18.5), (0.4, -18.5)), hole((0.5, -15.0), (1.0, -13.5), (1.7, -15.2)))
    return table(spark, folder, "region").select(F.col("r_name").alias("name"), F.concat(edges_of_ring(ring), holes).alias("edges"))


def order_points(spark, folder):
    k = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.round(-69.59 + (k * 37 % 997) * 0.0121, 4).alias("lon"), F.round(-22.89 + (k * 53 % 991) * 0.0131, 4).alias("lat")
    )


def polygon_table(spark, folder):
    """Coasts and areas stored by tile and joined with points of some bounds."""
    path = run_dir(spark, "areas")
    areas = nation_areas(spark, folder).select(F.col("n_name").alias("name"), "edges")
    write_polygons(coasts(spark, folder).unionByName(areas), path)
    points = order_points(spark, folder).where(F.col("lon").between(SCAN["minx"], SCAN["maxx"]) & F.col("lat").between(SCAN["miny"], SCAN["maxy"]))
    return join_polygons(points, path, ["name"], how="left", bounds=SCAN).select("o_orderkey", "name")


_CORNERS = f"""
    coast as (
        select r_name as name, 0 as ring, 0 as i, west as x, -22.5e0 as y from west union all
        select r_name, 0, 1, round(west + 2.3e0, 4), -22.5e0 from west union all
        select r_name, 0, 2 + i, round(west + 2.3e0 - (i * 7919 % 101) / 1000e0, 4), round(-22e0 + i * 0.001e0, 4) from west, generate_series(0, {COAST - 1}) g(i) union all
        select r_name, 0, {COAST + 2}, west, -12e0 from west union all
        select r_name, ring, i, round(west + dx, 4), y from west,
            (values (1, 0, 0.4e0, -20e0), (1, 1, 1.2e0, -20e0), (1, 2, 1.2e0, -18.5e0), (1, 3, 0.4e0, -18.5e0),
                    (2, 0, 0.5e0, -15e0), (2, 1, 1e0, -13.5e0), (2, 2, 1.7e0, -15.2e0)) h(ring, i, dx, y)),
    sides as (
        select name, x as x1, y as y1, coalesce(lead(x) over w, first_value(x) over w) as x2, coalesce(lead(y) over w, first_value(y) over w) as y2
        from coast window w as (partition by name, ring order by i)
        union all select n_name, x1, y1, x2, y2 from ({AREA_EDGES}))
"""


def readings(spark, folder, value):
    """Order values as readings at hours of the day, several a day, at a nation's station."""
    n = F.col("c_nationkey")
    x, y = F.round(-69.61 + (n % 5) * 2.4, 4), F.round(-22.91 + F.floor(n / 5) * 2.6, 4)
    orders = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    hour = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") * 7 % 24).cast("int"))
    return orders.select(
        n.alias("station_id"), F.round(x + 0.5 + (n % 3) * 0.7, 4).alias("lon"), F.round(y + 0.7 + (n % 2) * 1.0, 4).alias("lat"),
        (F.date_trunc("day", "o_orderdate") + hour).alias("time"), F.round(F.col("o_totalprice") / 1000, 2).alias(value),
    )


def coldspell_readings(spark, folder):
    """Cold spells of repeated readings (a day's minimum counts), with cluster labels."""
    clusters = table(spark, folder, "nation").select(F.col("n_nationkey").alias("station_id"), (F.col("n_regionkey") % 3).alias("cluster"))
    out = create_target(
        "tmin", readings(spark, folder, "tmin"), product_cells(spark, folder, "tmin"), PERIOD, target_area(spark, folder), ColdParams([0.5, 1], [3]),
        clusters=clusters,
    )
    flags = [f"{p}_{t}sd{d}_final" for t in ("0.5", "1") for p, d in (("flag_tmin", ""), ("n", "_next3d"), ("target", "_3d"))]
    return rounded(out, 5, "tmin", "tmin_chirts_adj").select(
        "station_id", "n_nationkey", "time", "lon_station", "lat_station", "lon", "lat", "tmin_lfa", "tmin_chirts", "tmin_chirts_adj", "tmin", "cluster",
        *[F.col(f"`{c}`").cast("bigint").alias(c.replace(".", "_")) for c in flags],
    )


def rainfall_readings(spark, folder):
    """Extreme rain of repeated readings (a day's sum counts)."""
    out = create_target(
        "prcp", readings(spark, folder, "prcp"), product_cells(spark, folder, "prcp"), PERIOD, target_area(spark, folder), RainParams([90, 95], [3]),
        exclude={"station_id": [3]},
    )
    shown = rounded(rounded(rounded(out, 5, "prcp", "bias_factor"), 3, "perc_prcp_next3d_final", "prcp_next3d_final"), 2, "prcp_lfa")
    return shown.select(
        "station_id", "n_nationkey", "time", "time_orig", "lon_station", "lat_station", "lon", "lat", "prcp_lfa", "prcp_chirps", "bias_factor", "prcp",
        F.col("prcp_next3d_final").alias("next3d"), F.col("perc_prcp_next3d_final").alias("perc3d"),
        *[F.col(f"target_P{p}_3d_final").cast("bigint").alias(f"target_P{p}") for p in (90, 95)],
    )


def categories(spark, folder):
    """Text, boolean and named number columns as categories."""
    c = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", (F.col("c_acctbal") > 0).alias("in_credit"))
    return as_categories(c, [*categorical_columns(c), "c_nationkey"])


def lead_intervals(spark, folder):
    """Leads given as intervals, in days, and the wanted ones of them."""
    leads = lead_table(spark, folder).withColumn("step", F.make_dt_interval(F.col("step").cast("int")))
    days = leads.withColumn("step", lead_days("step"))
    return select_leads(days, [2, 3, 4]).withColumn("step", F.col("step").cast("bigint"))


def period_keys(spark, folder):
    """Rows of a resolved period under the key of its range."""
    start, end = resolve_period(end_year=1998, window=2)
    rows, _ = extract(spark, f"{folder}/orders.parquet", Calendar(f"{start}-01-01", f"{end}-12-31"), "o_orderdate", by_range=True)
    return rows.select("o_orderkey", "key")


QUERIES = {
    "area_ids": area_ids,
    "polygon_scan": polygon_scan,
    "polygon_table": polygon_table,
    "coldspell_readings": coldspell_readings,
    "rainfall_readings": rainfall_readings,
    "categories": categories,
    "lead_intervals": lead_intervals,
    "period_keys": period_keys,
}

_READING = "round(o_totalprice / 1000, 2)"

ORACLES = {
    "area_ids": f"""
        with p as ({_PARCELS}),
        n as (select *, row_number() over (order by minx, miny desc) as i, count(*) over () as total from p),
        chosen as (select * from n where owner in ('Brand#1', 'Brand#2', 'Agent'))
        select 'ID-' || lpad(cast(i as varchar), cast(greatest(length(cast(total as varchar)), 3) as int), '0') as location_id, owner, p_partkey, minx, miny,
               cast(4 as bigint) as n_edges, (select floor(min(minx) * 10) / 10 from chosen) as area_minx, (select floor(min(miny) * 10) / 10 from chosen) as area_miny,
               (select ceil(max(round(minx + 0.25e0, 4)) * 10) / 10 from chosen) as area_maxx, (select ceil(max(round(miny + 0.25e0, 4)) * 10) / 10 from chosen) as area_maxy
        from chosen""",
    "polygon_scan": f"""
        with p as (select p_partkey, p_brand, round(-69.63e0 + (p_partkey % 50) * 0.25e0, 4) as minx, round(-10.01e0 - (p_partkey // 50) * 0.25e0, 4) as miny from part),
        listed as (select p_brand as owner, * exclude p_brand from p
                   union all select case when p_partkey % 2 = 0 then 'Agent' else 'Zone' end, * exclude p_brand from p where p_partkey % 3 = 0
                   union all select null, * exclude p_brand from p where p_partkey % 5 = 0)
        select owner, p_partkey, minx, miny, round(minx + 0.25e0, 4) as maxx, round(miny + 0.25e0, 4) as maxy, cast(4 as bigint) as n_edges from listed
        where round(minx + 0.25e0, 4) >= {SCAN['minx']}e0 and minx <= {SCAN['maxx']}e0 and round(miny + 0.25e0, 4) >= {SCAN['miny']}e0 and miny <= {SCAN['maxy']}e0""",
    "polygon_table": f"""
        with west as (select r_name, round(-69.6e0 + r_regionkey * 2.4e0, 4) as west from region), {_CORNERS},
        p as (select * from (select o_orderkey, round(-69.59e0 + (o_orderkey * 37 % 997) * 0.0121e0, 4) as lon, round(-22.89e0 + (o_orderkey * 53 % 991) * 0.0131e0, 4) as lat from orders)
              where lon between {SCAN['minx']}e0 and {SCAN['maxx']}e0 and lat between {SCAN['miny']}e0 and {SCAN['maxy']}e0),
        spans as (select *, least(y1, y2) as low, greatest(y1, y2) as high from sides where y1 <> y2),
        hits as (select p.o_orderkey, e.name from p join spans e on e.low <= p.lat and p.lat < e.high
                 where p.lon < (e.x2 - e.x1) * ((p.lat - e.y1) / (e.y2 - e.y1)) + e.x1 group by 1, 2 having count(*) % 2 = 1)
        select p.o_orderkey, name from p left join hits using (o_orderkey)""",
    "coldspell_readings": f"""
        select q.*, n_regionkey % 3 as cluster from ({_cold_sql(f'min({_READING})')}) q join nation on nation.n_nationkey = q.station_id""",
    "rainfall_readings": f"select * replace (round(prcp_lfa, 2) as prcp_lfa) from ({_rain_sql(f'sum({_READING})')})",
    "categories": """
        select c_custkey, cast(c_nationkey as varchar) as c_nationkey, c_mktsegment, cast(c_acctbal > 0 as varchar) as in_credit from customer""",
    "lead_intervals": f"""
        select cell, cast(time + interval 2 day as date) as time, step, price, quantity from ({LEADS}) where step in (2, 3, 4)""",
    "period_keys": """
        select o_orderkey, '19960101_19981231' as key from orders where cast(o_orderdate as date) between date '1996-01-01' and date '1998-12-31'""",
}

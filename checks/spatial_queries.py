"""Columns and filters, grids, nearest points, polygons and terrain."""

from __future__ import annotations

from pyspark.sql import functions as F

from perilspark.functions.numeric import lon_to_180, lon_to_360, normalise_longitudes, snap_down, snap_nearest, snap_up
from perilspark.operators.columns import (
    canonical_names,
    drop_constant_columns,
    drop_missing,
    in_box,
    in_period,
    include_exclude,
    prefix_groups,
    select_locations,
)
from perilspark.operators.grid import (
    GridSpec,
    enclosing_slice,
    match_to_grid,
    number_locations,
    regrid_linear,
    regrid_nearest,
    select_points,
    spatial_params,
    total_bounds,
)
from perilspark.operators.nearest import nearest_points
from perilspark.operators.quality import RAIN_SCORES, TEMPERATURE_SCORES, clean_rain, clean_temperature
from perilspark.operators.spatial import edges_of_ring, polygon_join, with_bounds
from perilspark.operators.terrain import terrain, terrain_features

from . import lat_sql, lon_sql, point_lat, point_lon, rounded, table


def customer_points(spark, folder):
    c = table(spark, folder, "customer")
    return c.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal", point_lon("c_custkey").alias("lon"), point_lat("c_custkey").alias("lat"))


CUSTOMER_POINTS = f"""
    select c_custkey, c_nationkey, c_mktsegment, c_acctbal, {lon_sql('c_custkey')} as lon, {lat_sql('c_custkey')} as lat from customer
"""


def supplier_points(spark, folder):
    k = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        "s_suppkey",
        F.round(-69.6 + (k * 37 % 97) * 0.12, 4).alias("lon"),
        F.round(-22.9 + (k * 53 % 89) * 0.14, 4).alias("lat"),
    )


SUPPLIER_POINTS = """
    select s_suppkey, round(-69.6e0 + (s_suppkey * 37 % 97) * 0.12e0, 4) as lon,
           round(-22.9e0 + (s_suppkey * 53 % 89) * 0.14e0, 4) as lat from supplier
"""

# Corners of one L-shaped area, relative to its lower left corner.
RING = [(0.0, 0.0), (2.4, 0.0), (2.4, 1.3), (1.2, 1.3), (1.2, 2.6), (0.0, 2.6)]


def nation_areas(spark, folder):
    """An L-shaped polygon per nation."""
    n = F.col("n_nationkey")
    x, y = F.round(-69.61 + (n % 5) * 2.4, 4), F.round(-22.91 + F.floor(n / 5) * 2.6, 4)
    ring = F.array(*[F.struct(F.round(x + dx, 4).alias("x"), F.round(y + dy, 4).alias("y")) for dx, dy in RING])
    areas = table(spark, folder, "nation").withColumn("edges", edges_of_ring(ring))
    return with_bounds(areas.withColumn("mun", F.when(n == 7, "OTRO").otherwise(F.col("n_name"))))


_X, _Y = "round(-69.61e0 + (n_nationkey % 5) * 2.4e0, 4)", "round(-22.91e0 + (n_nationkey // 5) * 2.6e0, 4)"
AREA_EDGES = " union all ".join(
    f"select n_nationkey, n_name, round({_X} + {a[0]}e0, 4) as x1, round({_Y} + {a[1]}e0, 4) as y1, "
    f"round({_X} + {b[0]}e0, 4) as x2, round({_Y} + {b[1]}e0, 4) as y2 from nation"
    for a, b in zip(RING, [*RING[1:], RING[0]])
)


def hits_sql(points: str, key: str) -> str:
    """Pairs (key, n_nationkey) of points inside areas, by the ray rule."""
    return f"""
        select p.{key}, e.n_nationkey from {points} p join edges e
          on (e.y1 > p.lat) <> (e.y2 > p.lat)
         and p.lon < (e.x2 - e.x1) * ((p.lat - e.y1) / nullif(e.y2 - e.y1, 0)) + e.x1
        group by 1, 2 having count(*) % 2 = 1
    """


def part_raster(spark, folder):
    """Part prices as an elevation raster, 50 cells wide."""
    k = F.col("p_partkey")
    return table(spark, folder, "part").select(
        F.round(-69.6 + (k % 50) * 0.25, 4).alias("lon"),
        F.round(-10 - F.floor(k / 50) * 0.25, 4).alias("lat"),
        F.round(F.col("p_retailprice") - 900 + (k * 7919 % 113), 1).alias("altitude"),
    )


PART_RASTER = """
    select p_partkey % 50 as c, p_partkey // 50 as r, round(-69.6e0 + (p_partkey % 50) * 0.25e0, 4) as lon,
           round(-10e0 - (p_partkey // 50) * 0.25e0, 4) as lat,
           round(p_retailprice - 900 + (p_partkey * 7919 % 113), 1) as altitude from part
"""


def lon_convert(spark, folder):
    c = table(spark, folder, "customer").select("c_custkey", ((F.col("c_custkey") % 720) * 0.5).alias("lon"))
    both = c.withColumns({"to180": lon_to_180("lon"), "to360": lon_to_360(lon_to_180("lon"))})
    return normalise_longitudes(both.withColumn("raw", F.col("lon")), "lon")


def snapping(spark, folder):
    p = customer_points(spark, folder)
    ends = {f"{c}_{n}": f(c, 10) for c in ("lon", "lat") for n, f in (("down", snap_down), ("up", snap_up))}
    return p.select("c_custkey", *[c.alias(n) for n, c in ends.items()], snap_nearest(F.col("lon") + 0.013, 10).alias("near"))


def include_excludes(spark, folder):
    c = table(spark, folder, "customer").withColumn("location_id", F.col("c_name"))
    segments = F.when(F.col("c_custkey") % 9 > 0, F.col("c_mktsegment"))
    chosen = select_locations(
        c.withColumn("seg", segments), "c_custkey", "location_id",
        include={"c_nationkey": [1, 2, 3, 4, 5]}, exclude={"seg": ["HOUSEHOLD", "MACHINERY"]},
    )
    return include_exclude(chosen, exclude={"location_id_orig": ["Customer#000000001"]}).select("location_id", "location_id_orig", "seg", "c_nationkey")


def bbox_filter(spark, folder):
    p = customer_points(spark, folder)
    box = {"minx": -69.0, "miny": -22.9, "maxx": -60.0, "maxy": -20.92}
    inner = p.where(in_box("lon", "lat", **box)).withColumn("kind", F.lit("closed"))
    outer = p.where(in_box("lon", "lat", **box, inclusive=False)).withColumn("kind", F.lit("open"))
    return inner.unionByName(outer).select("c_custkey", "lon", "lat", "kind")


def period_filter(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("time"))
    return o.where(in_period("time", "1996-02-29", "1997-12-31"))


def _scores(names, spark, folder, value, flags):
    """Quality codes spread over the line items."""
    base = table(spark, folder, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.sum("l_quantity").alias("q"), F.max("l_partkey").alias("part"), F.max("l_suppkey").alias("supp")
    )
    codes = {n: ((F.col("part") * (3 + i) + F.col("supp") * (i + 1) + F.col("l_linenumber")) % 7 - F.when(F.col("part") % (11 + i) == 0, 104).otherwise(0)).cast("double") for i, n in enumerate(names)}
    marks = {n: ((F.col("supp") + F.col("l_linenumber") * (i + 1)) % 5 == 0).cast("int") for i, n in enumerate(flags)}
    return base.withColumns({**codes, **marks, value: F.col("q") - F.when(F.col("part") % 50 == 0, 149.5).otherwise(0)})


TN_FLAGS = ["TNUP", "DTLO", "TNLO", "TNXL", "TNJU", "UPTN", "LOTN"]
PR_FLAGS = ["PCUP", "SUCU2", "PCGA"]


def _scores_sql(names, value, flags):
    code = ", ".join(
        f"cast((part * {3 + i} + supp * {i + 1} + l_linenumber) % 7 - case when part % {11 + i} = 0 then 104 else 0 end as double) as \"{n}\""
        for i, n in enumerate(n for n in names if n != value)
    )
    mark = ", ".join(f"cast((supp + l_linenumber * {i + 1}) % 5 = 0 as int) as \"{n}\"" for i, n in enumerate(flags))
    return f"""
        base as (select l_orderkey, l_linenumber, sum(l_quantity) as q, max(l_partkey) as part, max(l_suppkey) as supp
                 from lineitem group by 1, 2),
        raw as (select l_orderkey, l_linenumber, {code}, {mark},
                       q - case when part % 50 = 0 then 149.5 else 0 end as "{value}" from base)
    """


def qc_temperature(spark, folder):
    out = clean_temperature(_scores(TEMPERATURE_SCORES, spark, folder, "TN", TN_FLAGS))
    return out.select("l_orderkey", "l_linenumber", "flagNA", "flagNA_2", "TN_clean")


def qc_rain(spark, folder):
    out = clean_rain(_scores([s for s in RAIN_SCORES if s != "PRCP"], spark, folder, "PRCP", PR_FLAGS))
    return out.select("l_orderkey", "l_linenumber", "flagNA", "flagNA_2", "PRCP_clean")


def drop_missings(spark, folder):
    c = table(spark, folder, "customer")
    gaps = c.select("c_custkey", F.when(F.col("c_custkey") % 4 > 0, F.col("c_acctbal")).alias("bal"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("seg"))
    return drop_missing(gaps, ["bal", "seg"])


def rename_alias(spark, folder):
    """Aliases of a variable and its coordinates, then a grouped prefix."""
    raw = part_raster(spark, folder).withColumnsRenamed({"lon": "Longitude", "lat": "y", "altitude": "h"})
    named, _ = prefix_groups(canonical_names(raw, "altitude"), {"surf": {"alt": "altitude"}, "atmos": None})
    return named


def enclosing(spark, folder):
    bounds = total_bounds(nation_areas(spark, folder).where(F.col("n_nationkey").isin(6, 7)))
    return enclosing_slice(part_raster(spark, folder), bounds)


def drop_constants(spark, folder):
    c = table(spark, folder, "customer").withColumns({"band": F.lit(1), "spatial_ref": F.lit(None).cast("int")})
    return drop_constant_columns(c, ["band", "spatial_ref", "c_custkey"], keep=["c_custkey"])


def part_boxes(spark, folder):
    """Raster cells as boxes, with the brand for selection."""
    k = F.col("p_partkey")
    x, y = F.round(-69.63 + (k % 50) * 0.25, 4), F.round(-10.01 - F.floor(k / 50) * 0.25, 4)
    boxes = {"minx": x, "maxx": F.round(x + 0.25, 4), "miny": y, "maxy": F.round(y + 0.25, 4)}
    return table(spark, folder, "part").select("p_brand", *[c.alias(n) for n, c in boxes.items()])


def grid_points(spark, folder):
    rules = {"include": {"p_brand": ["Brand#1", "Brand#2", "Brand#3"]}, "exclude": {"p_brand": ["Brand#3"]}}
    bounds = spatial_params(part_boxes(spark, folder), **rules)
    return GridSpec.from_bounds(**bounds, nodes_per_degree=10).points(spark)


def location_ids(spark, folder):
    both = customer_points(spark, folder).select("lon", "lat", F.lit("c").alias("kind")).unionByName(
        supplier_points(spark, folder).select("lon", "lat", F.lit("s").alias("kind"))
    )
    return number_locations(both)


STATION_GRID = GridSpec.from_bounds(-69.6, -22.9, -57.6, -9.8, 10)


def nearest_grid(spark, folder):
    return match_to_grid(customer_points(spark, folder), STATION_GRID, "lon", "lat", "node_lon", "node_lat").select(
        "c_custkey", "node_lon", "node_lat"
    )


def nearest_k(spark, folder):
    out = nearest_points(customer_points(spark, folder), supplier_points(spark, folder), k=3)
    return rounded(out, 9, "distance").withColumn("rank", F.col("rank").cast("bigint"))


def point_select(spark, folder):
    wanted = part_raster(spark, folder).select("lon", "lat")
    stations = match_to_grid(customer_points(spark, folder), GridSpec(-69.6, -10, 50, 40, 4), "lon", "lat")
    return select_points(part_raster(spark, folder).select("lon", "lat", "altitude"), stations.join(wanted, ["lon", "lat"], "left_semi"))


def _raster_grid(cells, nodes):
    box = cells.agg(F.min("lon"), F.min("lat"), F.max("lon"), F.max("lat")).first()
    return GridSpec.from_bounds(box[0] - 0.3, box[1] - 0.3, box[2] + 0.3, box[3] + 0.3, nodes)


def regrid_near(spark, folder):
    cells = part_raster(spark, folder)
    return regrid_nearest(cells, _raster_grid(cells, 10))


def regrid_lin(spark, folder):
    cells = part_raster(spark, folder)
    return rounded(regrid_linear(cells, _raster_grid(cells, 10), ["altitude"]), 6, "altitude")


def admin_join(spark, folder):
    out = polygon_join(customer_points(spark, folder), nation_areas(spark, folder), ["n_nationkey", "mun"])
    return out.select("c_custkey", "n_nationkey", "mun")


def admin_left_join(spark, folder):
    out = polygon_join(customer_points(spark, folder), nation_areas(spark, folder), ["n_nationkey"], how="left")
    return out.select("c_custkey", "n_nationkey")


def tpi(spark, folder):
    return rounded(terrain(part_raster(spark, folder), tpi_windows=(5, 15, 25)), 6, "TPI_5", "TPI_15", "TPI_25")


def tdi(spark, folder):
    return rounded(terrain(part_raster(spark, folder), tdi_windows=(5, 15)), 6, "TDI_5", "TDI_15")


def slope(spark, folder):
    right = terrain(part_raster(spark, folder), slope=True, z_factor=1 / 111).withColumn("kind", F.lit("plain"))
    compat = terrain(part_raster(spark, folder), slope=True, z_factor=1 / 111, compat_gradient=True).withColumn("kind", F.lit("compat"))
    return rounded(right.unionByName(compat), 6, "slope")


def aspect(spark, folder):
    return rounded(terrain(part_raster(spark, folder), aspect=True), 6, "aspect")


def terrain_all(spark, folder):
    cells = part_raster(spark, folder).withColumnRenamed("altitude", "height")
    picks = part_raster(spark, folder).where(F.col("altitude") > 60)
    out = terrain_features(cells, (5,), (5,), points=picks)
    return rounded(out, 6, "slope", "aspect", "TPI_5", "TDI_5")


QUERIES = {
    "lon_convert": lon_convert,
    "snap_bounds": snapping,
    "include_exclude": include_excludes,
    "bbox_filter": bbox_filter,
    "period_filter": period_filter,
    "qc_temperature": qc_temperature,
    "qc_rain": qc_rain,
    "drop_missing": drop_missings,
    "rename_alias": rename_alias,
    "enclosing_slice": enclosing,
    "drop_constant": drop_constants,
    "grid_points": grid_points,
    "location_ids": location_ids,
    "nearest_grid": nearest_grid,
    "nearest_k": nearest_k,
    "point_select": point_select,
    "regrid_nearest": regrid_near,
    "regrid_linear": regrid_lin,
    "admin_join": admin_join,
    "admin_left_join": admin_left_join,
    "tpi": tpi,
    "tdi": tdi,
    "slope": slope,
    "aspect": aspect,
    "terrain_features": terrain_all,
}


def _box_sql(sizes, pick: str) -> str:
    """Brute-force stencil: every cell against its clamped neighbours."""
    ctes = [f"raster as materialized ({PART_RASTER})", "dims as (select max(c) as mc, max(r) as mr from raster)"]
    for w in sizes:
        h = w // 2
        ctes.append(f"""
            want{w} as materialized (
                select lon, lat, greatest(0, least(mc, c + dc)) as bc, greatest(0, least(mr, r + dr)) as br from raster cross join dims
                cross join (select unnest(generate_series(-{h}, {h})) as dc) cross join (select unnest(generate_series(-{h}, {h})) as dr)),
            box{w} as (
                select a.lon, a.lat, avg(b.altitude) as m, min(b.altitude) as lo, max(b.altitude) as hi
                from want{w} a join raster b on b.c = a.bc and b.r = a.br group by 1, 2)""")
    joins = " ".join(f"join box{w} on box{w}.lon = raster.lon and box{w}.lat = raster.lat" for w in sizes)
    values = ", ".join(pick.replace("WW", str(w)) for w in sizes)
    return f"with {', '.join(ctes)} select raster.lon, raster.lat, raster.altitude, {values} from raster {joins}"


_TPI = "round(raster.altitude - boxWW.m, 6) as \"TPI_WW\""
_TDI = "round(case when boxWW.m <> 0 then (boxWW.hi - boxWW.lo) / boxWW.m else 0 end, 6) as \"TDI_WW\""
_SHIFTS = [("nw", -1, -1), ("n", 0, -1), ("ne", 1, -1), ("w", -1, 0), ("e", 1, 0), ("sw", -1, 1), ("s", 0, 1), ("se", 1, 1)]
_NEIGHBOURS = f"""
    raster as ({PART_RASTER}),
    around as (select a.*, {', '.join(f'{n}.altitude as {n}, {n}.lon as {n}_lon, {n}.lat as {n}_lat' for n, _, _ in _SHIFTS)}
        from raster a {' '.join(f'left join raster {n} on {n}.c = a.c + {dc} and {n}.r = a.r + {dr}' for n, dc, dr in _SHIFTS)}),
    grad as (select *, ((ne + 2 * e + se) - (nw + 2 * w + sw)) / 8 as hx, ((sw + 2 * s + se) - (nw + 2 * n + ne)) / 8 as hy,
        case when w is null then (e - altitude) / 0.25 when e is null then (altitude - w) / 0.25 else (e - w) / 0.5 end as gx,
        case when n is null then (s - altitude) / -0.25 when s is null then (altitude - n) / -0.25 else (s - n) / -0.5 end as gy
        from around)
"""
_ASPECT = "case when hx = 0 and hy = 0 then -1 else ((90 - degrees(atan2(hy, -hx))) % 360 + 360) % 360 end"


def _slope_sql(gx: str, z: str) -> str:
    return f"degrees(atan(sqrt(pow({gx} * {z}, 2) + pow(gy * {z}, 2))))"


_GRID = f"""
    raster as ({PART_RASTER}),
    box as (select min(lon) - 0.3e0 as x0, min(lat) - 0.3e0 as y0, max(lon) + 0.3e0 as x1, max(lat) + 0.3e0 as y1 from raster),
    tx as (select round(x0 + i / 10e0, 6) as t from box, generate_series(0, cast(ceil(round((x1 - x0) * 10, 6)) as bigint) - 1) g(i)),
    ty as (select round(y1 - i / 10e0, 6) as t from box, generate_series(0, cast(ceil(round((y1 - y0) * 10, 6)) as bigint) - 1) g(i)),
    ax as (select distinct lon as s from raster), ay as (select distinct lat as s from raster)
"""


def _nearest_axis(name: str, targets: str, axis: str) -> str:
    return f"""{name} as (select t, s from (select t, s, row_number() over (partition by t order by round(abs(t - s), 9), s desc) as k
        from {targets} cross join {axis}) where k = 1)"""


def _linear_axis(name: str, targets: str, axis: str) -> str:
    return f"""{name} as (
        with near as (select t, max(s) filter (s <= t) as lo, min(s) filter (s >= t) as hi from {targets} cross join {axis} group by 1)
        select t, lo as s, case when lo = hi then 1 else 1 - (t - lo) / nullif(hi - lo, 0) end as w from near where lo is not null and hi is not null
        union all select t, hi, (t - lo) / nullif(hi - lo, 0) from near where lo < hi)"""


_PART_BOX = """
    cells as (select p_brand, round(-69.63e0 + (p_partkey % 50) * 0.25e0, 4) as x, round(-10.01e0 - (p_partkey // 50) * 0.25e0, 4) as y from part),
    box as (select floor(min(x) * 10) / 10 as x0, floor(min(y) * 10) / 10 as y0, ceil(max(round(x + 0.25e0, 4)) * 10) / 10 as x1,
                   ceil(max(round(y + 0.25e0, 4)) * 10) / 10 as y1 from cells where p_brand in ('Brand#1', 'Brand#2'))
"""
_TN_FLAG = '("TNUP"=1 and "DTLO"=1) or ("TNLO"=1 and "DTLO"=1) or "TNXL"=1 or "TNJU"=1 or "UPTN"=1 or ("LOTN"=1 and "TNLO"=1)'
_TN_SCORE = """(s('othQualProb')>=2 and s('misTempInt')>=2) or (s('othQualProb')>=3 and s('grossInhoFreq')>=3)
    or (s('monOutlierAcmAll')>=1 and s('monOutlierAcmSel')>=1)"""
_PR_FLAG = '"PCUP"=1 and "SUCU2"=1 and "PCGA"=1'
_PR_SCORE = """s('prcpTru')>=2 or s('prcpTruAccum')<=10 or s('prcpGapLimit')>=4
    or (s('meaPrec')>=4 and s('othQualProb')>=3 and s('meaPrecInc')>=3 and s('meaPrecInd')>=3)
    or (s('monOutlierAcmAll')>=1 and s('monOutlierAcmSel')>=1)"""


def _qc_sql(names, value, flags, by_flag, by_score, masked_value):
    import re

    score = re.sub(r"s\('(\w+)'\)", r'(case when "\1" > -99 then "\1" end)', by_score)
    shown = f'case when "{value}" > -99 then "{value}" end' if masked_value else f'"{value}"'
    return f"""
        with {_scores_sql(names, value, flags)},
        flagged as (select *, case when {by_flag} then 1 else 0 end as "flagNA", case when {score} then 1 else 0 end as "flagNA_2" from raw)
        select l_orderkey, l_linenumber, "flagNA", "flagNA_2",
               case when "flagNA" = 0 and "flagNA_2" = 0 then {shown} end as "{value}_clean" from flagged"""


ORACLES = {
    "lon_convert": """
        with c as (select c_custkey, (c_custkey % 720) * 0.5e0 as raw from customer),
        k as (select *, (raw + 180) % 360 - 180 as to180 from c)
        select c_custkey, raw, to180, (to180 + 360) % 360 as to360,
               case when (select max(raw) > 180 or min(raw) < 0 from c) then to180 else raw end as lon from k""",
    "snap_bounds": f"""
        with p as ({CUSTOMER_POINTS})
        select c_custkey, floor(lon * 10) / 10 as lon_down, ceil(lon * 10) / 10 as lon_up, floor(lat * 10) / 10 as lat_down,
               ceil(lat * 10) / 10 as lat_up, round_even((lon + 0.013e0) * 10, 0) / 10 as near from p""",
    "include_exclude": """
        select c_custkey as location_id, c_name as location_id_orig, c_nationkey,
               case when c_custkey % 9 > 0 then c_mktsegment end as seg from customer
        where c_nationkey in (1, 2, 3, 4, 5)
          and coalesce(case when c_custkey % 9 > 0 then c_mktsegment end, '') not in ('HOUSEHOLD', 'MACHINERY')
          and c_name <> 'Customer#000000001'""",
    "bbox_filter": f"""
        with p as ({CUSTOMER_POINTS})
        select c_custkey, lon, lat, 'closed' as kind from p where lon between -69.0e0 and -60.0e0 and lat between -22.9e0 and -20.92e0
        union all
        select c_custkey, lon, lat, 'open' from p where lon > -69.0e0 and lon < -60.0e0 and lat > -22.9e0 and lat < -20.92e0""",
    "period_filter": """
        select o_orderkey, cast(o_orderdate as date) as time from orders
        where cast(o_orderdate as date) between date '1996-02-29' and date '1997-12-31'""",
    "qc_temperature": _qc_sql(TEMPERATURE_SCORES, "TN", TN_FLAGS, _TN_FLAG, _TN_SCORE, False),
    "qc_rain": _qc_sql(RAIN_SCORES, "PRCP", PR_FLAGS, _PR_FLAG, _PR_SCORE, True),
    "drop_missing": """
        select c_custkey, c_acctbal as bal, c_mktsegment as seg from customer where c_custkey % 4 > 0 and c_custkey % 3 > 0""",
    "rename_alias": f"select lon, lat, altitude as surf_alt from ({PART_RASTER})",
    "enclosing_slice": f"""
        with raster as ({PART_RASTER}), edges as ({AREA_EDGES}),
        b as (select min(x1) as x0, max(x1) as x1, min(y1) as y0, max(y1) as y1 from edges where n_nationkey in (6, 7)),
        l as (select coalesce(max(lon) filter (lon <= b.x0), min(lon)) as lx0, coalesce(min(lon) filter (lon >= b.x1), max(lon)) as lx1,
                     coalesce(max(lat) filter (lat <= b.y0), min(lat)) as ly0, coalesce(min(lat) filter (lat >= b.y1), max(lat)) as ly1
              from raster cross join b)
        select lon, lat, altitude from raster cross join l where lon between lx0 and lx1 and lat between ly0 and ly1""",
    "drop_constant": "select * from customer",
    "grid_points": f"""
        with {_PART_BOX}
        select round(x0 + i / 10e0, 6) as lon, round(y1 - j / 10e0, 6) as lat from box,
             generate_series(0, cast(ceil(round((x1 - x0) * 10, 6)) as bigint) - 1) a(i),
             generate_series(0, cast(ceil(round((y1 - y0) * 10, 6)) as bigint) - 1) b(j)""",
    "location_ids": f"""
        with pts as (select lon, lat, 'c' as kind from ({CUSTOMER_POINTS}) union all select lon, lat, 's' from ({SUPPLIER_POINTS})),
        d as (select lon, lat, min(kind) as kind from pts group by 1, 2),
        n as (select *, row_number() over (order by lon, lat desc) as i, count(*) over () as total from d)
        select lon, lat, kind, 'ID-' || lpad(cast(i as varchar), cast(greatest(length(cast(total as varchar)), 3) as int), '0') as location_id from n""",
    "nearest_grid": f"""
        with pts as ({CUSTOMER_POINTS}),
        nx as (select round(-69.6e0 + i / 10e0, 6) as nlon from generate_series(0, 119) a(i)),
        ny as (select round(-9.8e0 - j / 10e0, 6) as nlat from generate_series(0, 130) b(j)),
        best as (select c_custkey, min({{'d': round(pow(lon - nlon, 2) + pow(lat - nlat, 2), 9), 'lat': nlat, 'lon': nlon}}) as b
                 from pts cross join nx cross join ny group by 1)
        select c_custkey, b.lon as node_lon, b.lat as node_lat from best""",
    "nearest_k": f"""
        with c as (select distinct lon as target_lon, lat as target_lat from ({CUSTOMER_POINTS})),
        s as (select distinct lon, lat from ({SUPPLIER_POINTS})),
        d as (select *, sqrt(pow(lon - target_lon, 2) + pow(lat - target_lat, 2)) as distance from c cross join s),
        r as (select *, row_number() over (partition by target_lon, target_lat order by round(distance, 12), lat, lon) as rank from d)
        select target_lon, target_lat, lon, lat, round(distance, 9) as distance, rank from r where rank <= 3""",
    "point_select": f"""
        with raster as ({PART_RASTER}), c as ({CUSTOMER_POINTS}),
        snapped as (select greatest(0, least(49, cast(ceil(round((lon + 69.6e0) * 4, 6) - 0.5) as bigint))) as i,
                           greatest(0, least(39, cast(floor(round((-10 - lat) * 4, 6) + 0.5) as bigint))) as j from c)
        select lon, lat, altitude from raster where (c, r) in (select (i, j) from snapped)""",
    "regrid_nearest": f"""
        with {_GRID}, {_nearest_axis('mx', 'tx', 'ax')}, {_nearest_axis('my', 'ty', 'ay')}
        select mx.t as lon, my.t as lat, altitude from raster join mx on mx.s = raster.lon join my on my.s = raster.lat""",
    "regrid_linear": f"""
        with {_GRID}, {_linear_axis('mx', 'tx', 'ax')}, {_linear_axis('my', 'ty', 'ay')}
        select mx.t as lon, my.t as lat, round(sum(mx.w * my.w * altitude), 6) as altitude
        from raster join mx on mx.s = raster.lon join my on my.s = raster.lat group by 1, 2""",
    "admin_join": f"""
        with p as ({CUSTOMER_POINTS}), edges as ({AREA_EDGES}), hits as ({hits_sql('p', 'c_custkey')})
        select c_custkey, n_nationkey, case when n_nationkey = 7 then 'OTRO' else n_name end as mun from hits join nation using (n_nationkey)""",
    "admin_left_join": f"""
        with p as ({CUSTOMER_POINTS}), edges as ({AREA_EDGES}), hits as ({hits_sql('p', 'c_custkey')})
        select p.c_custkey, n_nationkey from p left join hits on hits.c_custkey = p.c_custkey""",
    "tpi": _box_sql((5, 15, 25), _TPI),
    "tdi": _box_sql((5, 15), _TDI),
    "slope": f"""
        with {_NEIGHBOURS}
        select lon, lat, altitude, 'plain' as kind, round({_slope_sql('gx', '(1e0/111)')}, 6) as slope from grad
        union all select lon, lat, altitude, 'compat', round({_slope_sql('(gx / nullif(altitude, 0))', '(1e0/111)')}, 6) from grad""",
    "aspect": f"with {_NEIGHBOURS} select lon, lat, altitude, round({_ASPECT}, 6) as aspect from grad",
    "terrain_features": f"""
        with {_NEIGHBOURS}, boxes as ({_box_sql((5,), _TPI + ', ' + _TDI)})
        select g.lon, g.lat, g.altitude, round({_slope_sql('gx', '(1e0/111000)')}, 6) as slope, round({_ASPECT}, 6) as aspect,
               b."TPI_5", b."TDI_5", g.lon as longitude, g.lat as latitude
        from grad g join boxes b on b.lon = g.lon and b.lat = g.lat where g.altitude > 60""",
}

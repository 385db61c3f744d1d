"""Alerts, table sources and sinks, streaming refresh.

Queries that write use fresh folders under the session's shared folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from perilspark.functions.flags import COLD_ALERTS, AlertThresholds
from perilspark.functions.temporal import Calendar
from perilspark.operators.climatology import anomaly_from_stored, weekly_climatology
from perilspark.operators.forecast import select_leads
from perilspark.plans.alerts import alert_kpis, alerts_with_admin, grid_pivot, grid_rows, with_alert_levels
from perilspark.session import run_dir
from perilspark.sources.tables import (
    append_table,
    export_csv,
    extract,
    overwrite_partitions,
    read_keyed,
    read_period,
    read_table,
    request_status,
    upsert,
    write_cells,
    write_table,
)
from perilspark.streaming.refresh import append_stream, dedupe_stream, forecast_stream, refresh_scores

from . import rounded, table
from .climate_queries import LEADS, lead_table, weekly_sql
from .spatial_queries import AREA_EDGES, CUSTOMER_POINTS, PART_RASTER, customer_points, hits_sql, nation_areas, part_raster


def predictions(spark, folder):
    """Customers as scored points: probability from the account balance."""
    p = customer_points(spark, folder)
    return p.select(
        "c_custkey", "c_nationkey", "lon", "lat", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 30).cast("int")).alias("time"),
        F.round((F.col("c_acctbal") + 1000) / 11000, 2).alias("pred_target"),
    )


PREDICTIONS = f"""
    select c_custkey, c_nationkey, lon, lat, cast(date '2024-01-01' + cast(c_custkey % 30 as int) as date) as time,
           round((c_acctbal + 1000) / 11000, 2) as pred_target from ({CUSTOMER_POINTS})
"""
LEVEL = "case when pred_target >= 0.6 then 'Red' when pred_target >= 0.12 then 'Orange' else 'None' end"


def alert_levels(spark, folder):
    return with_alert_levels(predictions(spark, folder), COLD_ALERTS)


def kpis(spark, folder):
    levels = with_alert_levels(predictions(spark, folder), AlertThresholds(0.4, 0.1))
    whole = alert_kpis(levels).withColumn("c_nationkey", F.lit(None).cast("int"))
    return whole.unionByName(alert_kpis(levels, ["c_nationkey"]))


def admin(spark, folder):
    return nation_areas(spark, folder).select(
        F.col("n_nationkey").cast("string").alias("idPolygon"), F.col("n_regionkey").cast("string").alias("dept"),
        F.col("n_name").alias("prov"), "mun", "edges", "minx", "miny", "maxx", "maxy",
    )


def alerts_admin(spark, folder):
    return alerts_with_admin(with_alert_levels(predictions(spark, folder), COLD_ALERTS), admin(spark, folder))


PIVOT_LONS = [round(-69.6 + i * 0.25, 4) for i in range(50)]


def pivoted(spark, folder):
    return grid_pivot(part_raster(spark, folder), "altitude", PIVOT_LONS)


def pivot_rows(spark, folder):
    out = grid_rows(part_raster(spark, folder), "altitude")
    return out.select("lat", F.size("cells").cast("bigint").alias("n"), F.array_join(F.transform("cells", lambda c: c["value"].cast("decimal(9,1)").cast("string")), " ").alias("line"))


def table_roundtrip(spark, folder):
    path = run_dir(spark, "roundtrip")
    suppliers = table(spark, folder, "supplier")
    write_table(suppliers, path, codec="gzip")
    append_table(suppliers.withColumn("s_suppkey", -F.col("s_suppkey") - 1), path)
    return read_table(spark, path, suppliers.schema)


def cell_table(spark, folder):
    """Yearly cell partitions, a column that came later, merged on read."""
    path = run_dir(spark, "cells")
    orders = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("time"), "o_totalprice")
    early, late = (orders.where(c) for c in (F.year("time") < 1998, F.year("time") >= 1998))
    write_cells(early, path)
    write_cells(late.withColumn("source", F.lit("late")), path)
    return read_table(spark, path, merge=True).withColumn("year", F.col("year").cast("bigint"))


def idempotent_sink(spark, folder):
    """Writing the same months twice leaves each row once."""
    path = run_dir(spark, "sink")
    orders = table(spark, folder, "orders").withColumn("yearmon", F.date_format("o_orderdate", "yyyyMM"))
    overwrite_partitions(orders.where(F.year("o_orderdate") < 1998), path)
    overwrite_partitions(orders.where(F.year("o_orderdate") >= 1997), path)
    return spark.read.parquet(path).groupBy(F.col("yearmon").cast("string").alias("yearmon")).agg(F.count(F.lit(1)).alias("n"))


def pruned_scan(spark, folder):
    path = run_dir(spark, "scan")
    orders = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("time"), "o_totalprice")
    overwrite_partitions(orders.withColumn("yearmon", F.date_format("time", "yyyyMM")), path)
    return read_period(spark, path, "1997-03-15", "1998-01-10")


def key_upsert(spark, folder):
    path = run_dir(spark, "upsert")
    orders = table(spark, folder, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("yearmon"), "o_totalprice")
    upsert(orders.where(F.col("o_orderkey") % 3 > 0), path, ["o_orderkey", "yearmon"])
    upsert(orders.where(F.col("o_orderkey") % 2 == 0).withColumn("o_totalprice", -F.col("o_totalprice")), path, ["o_orderkey", "yearmon"])
    return spark.read.parquet(path).withColumn("yearmon", F.col("yearmon").cast("string"))


def csv_export(spark, folder):
    path = run_dir(spark, "csv")
    alerts = alerts_with_admin(with_alert_levels(predictions(spark, folder), COLD_ALERTS), admin(spark, folder))
    export_csv(alerts, path)
    return spark.read.schema(alerts.schema).option("header", "true").csv(path)


def extract_range(spark, folder):
    rows, _ = extract(spark, f"{folder}/orders.parquet", Calendar("1996-06-01", "1998-02-28"), "o_orderdate")
    return rows.select("o_orderkey", "key")


def extract_status(spark, folder):
    path = f"{folder}/orders.parquet"
    _, inside = extract(spark, path, Calendar("1996-01-01", "1997-12-31"), "o_orderdate", by_range=True)
    _, beyond = extract(spark, path, Calendar("2000-01-01", "2003-12-31"), "o_orderdate", by_range=True)
    _, nothing = extract(spark, path, Calendar("2005-01-01", "2006-12-31"), "o_orderdate", by_range=True)
    out = request_status(inside).withColumn("request", F.lit("inside"))
    for audit, name in ((beyond, "beyond"), (nothing, "nothing")):
        out = out.unionByName(request_status(audit).withColumn("request", F.lit(name)))
    return out.withColumn("years_missing", F.col("years_missing").cast("bigint"))


def stream_score(spark, folder):
    """Shipped lines arrive as forecast files; alerts against stored normals."""
    out, checkpoint = run_dir(spark, "alerts"), run_dir(spark, "alerts-progress")
    leads = select_leads(lead_table(spark, folder), [2, 3])
    normals = weekly_climatology(leads, ["price"], ["cell", "step"], smooth=2)
    stored = run_dir(spark, "normals")
    write_table(normals, stored)
    static = read_table(spark, stored)
    raw = table(spark, folder, "lineitem").schema

    def score(batch):
        items = batch.select(F.col("l_returnflag").alias("cell"), F.to_date("l_shipdate").alias("time"), F.col("l_linenumber").alias("step"), "l_extendedprice")
        sums = items.groupBy("cell", "time", "step").agg(F.round(F.sum("l_extendedprice"), 2).alias("price"))
        anomalies = anomaly_from_stored(select_leads(sums, [2, 3]), static, ["price"], ["cell", "step"])
        scored = anomalies.where(F.col("anom_price").isNotNull()).withColumn("pred_target", F.round(1 / (1 + F.exp(2 - F.col("anom_price"))), 6))
        return with_alert_levels(scored, COLD_ALERTS).drop("anom_price").withColumn("yearmon", F.date_format("time", "yyyyMM"))

    stream = forecast_stream(spark, folder, raw, "lineitem.parquet")
    refresh_scores(stream, score, out, checkpoint, ["cell", "step", "time"])
    schema = "cell string, step int, time date, price double, pred_target double, alert_level string, yearmon string"
    return spark.read.schema(schema).parquet(out).select("cell", F.col("step").cast("bigint").alias("step"), "time", "price", "pred_target", "alert_level")


def stream_refresh(spark, folder):
    """Three files in three batches: repeated forecasts, an old one that comes late, all of it replayed."""
    landing, out = run_dir(spark, "landing"), run_dir(spark, "refreshed")
    items = table(spark, folder, "lineitem")
    days = items.groupBy((F.col("l_suppkey") % 50).alias("cell"), F.to_date("l_shipdate").alias("time")).agg(F.round(F.sum("l_extendedprice"), 2).alias("price"))
    issue = lambda n, every, by: days.where(F.col("cell") % every == 0).select("cell", "time", F.round(F.col("price") * by, 2).alias("price"), F.lit(n).alias("issue"))
    for i, file in enumerate((issue(1, 1, 1), issue(2, 2, 2), issue(3, 3, 3).unionByName(issue(0, 5, 100)))):
        file.coalesce(1).write.parquet(f"{landing}/{i}")
    schema = spark.read.parquet(f"{landing}/0").schema
    score = lambda batch: batch.withColumn("yearmon", F.date_format("time", "yyyyMM"))
    for run in ("first", "replay"):
        stream = forecast_stream(spark, f"{landing}/*", schema, per_batch=1)
        refresh_scores(stream, score, out, run_dir(spark, f"progress-{run}"), ["cell", "time", "yearmon"], issued="issue")
    return read_keyed(spark, out).select("cell", "time", "price", "issue")


def stream_dedupe(spark, folder):
    """One row per user and day from an event stream."""
    out, checkpoint = run_dir(spark, "dedupe"), run_dir(spark, "dedupe-progress")
    stream = forecast_stream(spark, folder, table(spark, folder, "events").schema, "events.parquet")
    keyed = stream.select("user_id", F.to_date("ts").alias("day"), "ts")
    append_stream(dedupe_stream(keyed, ["user_id", "day"], "ts", "40 days"), out, checkpoint)
    return spark.read.parquet(out).groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "alert_levels": alert_levels,
    "alert_kpis": kpis,
    "alerts_admin": alerts_admin,
    "grid_pivot": pivoted,
    "grid_rows": pivot_rows,
    "table_roundtrip": table_roundtrip,
    "cell_table": cell_table,
    "idempotent_sink": idempotent_sink,
    "pruned_scan": pruned_scan,
    "key_upsert": key_upsert,
    "csv_export": csv_export,
    "extract_range": extract_range,
    "extract_status": extract_status,
    "stream_score": stream_score,
    "stream_refresh": stream_refresh,
    "stream_dedupe": stream_dedupe,
}

_ALERTS = f"""
    with p as ({PREDICTIONS}), edges as ({AREA_EDGES}), hits as ({hits_sql('p', 'c_custkey')})
    select cast(n.n_nationkey as varchar) as "idPolygon", cast(n_regionkey as varchar) as dept, n_name as prov, n_name as mun,
           lon, lat, time, pred_target, {LEVEL} as alert_level
    from p join hits on hits.c_custkey = p.c_custkey join nation n on n.n_nationkey = hits.n_nationkey
    where {LEVEL} in ('Orange', 'Red') and n.n_nationkey <> 7
"""
_KPI = """count(*) as points, max(pred_target) as max_probability, count(*) filter (pred_target >= 0.1 and pred_target < 0.4) as orange,
    count(*) filter (pred_target >= 0.4) as red"""

ORACLES = {
    "alert_levels": f"select *, {LEVEL} as alert_level from ({PREDICTIONS})",
    "alert_kpis": f"""
        with p as ({PREDICTIONS}) select {_KPI}, null as c_nationkey from p union all select {_KPI}, c_nationkey from p group by c_nationkey""",
    "alerts_admin": _ALERTS,
    "grid_pivot": f"with r as ({PART_RASTER}) select lat, " + ", ".join(f"max(altitude) filter (c = {i}) as lon_{i}" for i in range(50)) + " from r group by lat",
    "grid_rows": f"""
        with r as ({PART_RASTER}) select lat, count(*) as n, string_agg(cast(cast(altitude as decimal(9, 1)) as varchar), ' ' order by lon) as line
        from r group by lat""",
    "table_roundtrip": """
        select s_suppkey, s_name, s_nationkey, s_acctbal from supplier
        union all select -s_suppkey - 1, s_name, s_nationkey, s_acctbal from supplier""",
    "cell_table": """
        select o_orderkey, cast(o_orderdate as date) as time, o_totalprice, year(o_orderdate) as year,
               case when year(o_orderdate) >= 1998 then 'late' end as source from orders""",
    "idempotent_sink": "select strftime(o_orderdate, '%Y%m') as yearmon, count(*) as n from orders group by 1",
    "pruned_scan": """
        select o_orderkey, cast(o_orderdate as date) as time, o_totalprice, strftime(o_orderdate, '%Y%m') as yearmon from orders
        where cast(o_orderdate as date) between date '1997-03-15' and date '1998-01-10'""",
    "key_upsert": """
        select o_orderkey, strftime(o_orderdate, '%Y%m') as yearmon, case when o_orderkey % 2 = 0 then -o_totalprice else o_totalprice end as o_totalprice
        from orders where o_orderkey % 3 > 0 or o_orderkey % 2 = 0""",
    "csv_export": _ALERTS,
    "extract_range": """
        select o_orderkey, cast(year(o_orderdate) as varchar) as key from orders
        where cast(o_orderdate as date) between date '1996-06-01' and date '1998-02-28'""",
    "extract_status": """
        with d as (select distinct cast(o_orderdate as date) as d from orders),
        r as (select * from (values ('inside', 1996, 1997), ('beyond', 2000, 2003), ('nothing', 2005, 2006)) v(request, y0, y1)),
        y as (select request, y, count(d.d) as n from (select request, unnest(generate_series(y0, y1)) as y from r) q
              left join d on year(d.d) = q.y group by 1, 2)
        select request, cast(sum(n) as bigint) as landed_days, count(*) filter (n = 0) as years_missing,
               case when sum(n) = 0 then 'failed' when count(*) filter (n = 0) > 0 then 'partial' else 'success' end as status from y group by 1""",
    "stream_score": f"""
        with src as (select cell, step, cast(time + interval 2 day as date) as time, price from ({LEADS}) where step in (2, 3)),
        {weekly_sql('src', ['price'], ['cell', 'step'], 2)},
        a as (select s.*, (price - clim_price) / nullif(std_price, 0) as anom from src s
              join normals c on c.cell = s.cell and c.step = s.step and c.week = weekofyear(s.time)),
        p as (select cell, step, time, price, round(1 / (1 + exp(2 - anom)), 6) as pred_target from a where anom is not null)
        select cell, cast(step as bigint) as step, time, price, pred_target, {LEVEL} as alert_level from p""",
    "stream_refresh": """
        with d as (select l_suppkey % 50 as cell, cast(l_shipdate as date) as time, round(sum(l_extendedprice), 2) as price from lineitem group by 1, 2),
        i as (select *, case when cell % 3 = 0 then 3 when cell % 2 = 0 then 2 else 1 end as issue from d)
        select cell, time, round(price * issue, 2) as price, issue from i""",
    "stream_dedupe": "select user_id, cast(ts as date) as day, count(distinct 1) as n from events group by 1, 2",
}

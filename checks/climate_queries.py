"""Climatologies, anomalies, forecast leads and bias correction."""

from __future__ import annotations

from pyspark.sql import functions as F

from perilspark.operators.bias import (
    apply_monthly_bias,
    blend,
    mean_variance_scaling,
    monthly_bias_factors,
    monthly_comparison,
    weekly_share,
    weekly_sum,
)
from perilspark.operators.climatology import (
    anomaly_features,
    anomaly_from_stored,
    attach_climatology,
    doy_moments,
    doy_percentile,
    raw_anomaly,
    weekly_climatology,
)
from perilspark.operators.calendar import daily_series
from perilspark.operators.forecast import (
    accumulate_between,
    first_per_key,
    forecast_feature_input,
    mean_over_leads,
    select_leads,
)
from perilspark.plans.targets import cold_percentile_target

from . import ORDERS_SERIES, off_tie_sql, orders_series, rounded, rounded_off_tie, table
from .series_queries import ORDERS_FILLED, _ahead, doy_moments_sql, percentile_sql

KEY = ["station_id"]


def lead_table(spark, folder, value=None):
    """Ship dates as a forecast: line number is the lead, return flag the cell."""
    items = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("cell"), F.to_date("l_shipdate").alias("time"), F.col("l_linenumber").alias("step"),
        "l_extendedprice", "l_quantity",
    )
    sums = items.groupBy("cell", "time", "step").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("price"), F.sum("l_quantity").alias("quantity")
    )
    return sums


LEADS = """
    select l_returnflag as cell, cast(l_shipdate as date) as time, l_linenumber as step,
           round(sum(l_extendedprice), 2) as price, sum(l_quantity) as quantity
    from lineitem group by 1, 2, 3
"""


def two_sources(spark, folder):
    """Orders and shipped lines of one priority as two sources of a series."""
    orders = orders_series(spark, folder).withColumnRenamed("value", "observed")
    items = table(spark, folder, "lineitem").join(
        table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    product = daily_series(
        items.withColumnRenamed("o_orderpriority", "station_id"), KEY, "l_shipdate",
        product=F.round(F.sum("l_extendedprice"), 2),
    )
    return product.join(orders, [*KEY, "time"], "left")


TWO_SOURCES = f"""
    orders_series as ({ORDERS_SERIES}),
    product as (select o_orderpriority as station_id, cast(l_shipdate as date) as time,
                       round(sum(l_extendedprice), 2) as product
                from lineitem join orders on l_orderkey = o_orderkey group by 1, 2),
    src as (select p.station_id, p.time, p.product, o.value as observed from product p
            left join orders_series o on o.station_id = p.station_id and o.time = p.time)
"""


def doy_percentiles(spark, folder):
    out = doy_percentile(orders_series(spark, folder), "value", KEY, 3)
    return out.select("station_id", "time", "value", "perc_value")


def doy_means(spark, folder):
    out = doy_moments(orders_series(spark, folder), "value", KEY, 7, digits=None)
    return rounded_off_tie(out, "clim_value_mean", "clim_value_std").select(
        "station_id", "time", F.col("clim_value_mean").alias("mean"), F.col("clim_value_std").alias("std")
    )


def cold_percentiles(spark, folder):
    out = cold_percentile_target(orders_series(spark, folder), "value", KEY, [3, 5, 10], [3], "final")
    return out.select(
        "station_id", "time", F.col("perc_tmin_next3d_final").alias("perc"),
        *[F.col(f"target_P{p}_3d_final").cast("bigint").alias(f"target_P{p}") for p in (3, 5, 10)],
    )


def weekly_normals(spark, folder):
    out = weekly_climatology(orders_series(spark, folder), ["value"], KEY, smooth=0)
    return rounded_off_tie(out, "clim_value", "std_value").withColumn("week", F.col("week").cast("bigint"))


def smoothed_normals(spark, folder):
    out = weekly_climatology(orders_series(spark, folder), ["value"], KEY, smooth=2)
    return rounded(out, 4, "clim_value", "std_value").withColumn("week", F.col("week").cast("bigint"))


def anomaly_train(spark, folder):
    leads, cell = forecast_feature_input(lead_table(spark, folder).withColumnRenamed("price", "t2m"), "t2m", [2, 3, 4], ["cell"])
    features, _ = anomaly_features(leads, ["t2m"], cell, smooth=2)
    return rounded(features, 6, "anom_t2m").select("cell", "step", "time", "t2m", "anom_t2m")


def anomaly_stored(spark, folder):
    """Daily path: first run per day against normals of the training years."""
    leads, cell = forecast_feature_input(lead_table(spark, folder).withColumnRenamed("price", "t2m"), "t2m", [2, 3], ["cell"])
    normals = weekly_climatology(leads, ["t2m"], cell, smooth=2)
    fresh = first_per_key(leads, [*cell, "time"], ["t2m"])
    out = anomaly_from_stored(fresh, normals, ["t2m"], cell)
    return rounded(out, 6, "anom_t2m").select("cell", "step", "time", "t2m", "anom_t2m")


def raw_anomalies(spark, folder):
    rain = accumulate_between(lead_table(spark, folder), ["price"], ["cell"], 1, 4, clip=True, suffix="_cum")
    normals = weekly_climatology(rain, ["price_cum"], ["cell"], smooth=1).drop("std_price_cum")
    out = raw_anomaly(rain, normals, ["price_cum"], ["cell"])
    return rounded(out, 4, "price_cum", "clim_price_cum", "anom_price_cum").select(
        "cell", "time", "price_cum", "clim_price_cum", "anom_price_cum"
    )


def multi_variable_anomaly(spark, folder):
    features, _ = anomaly_features(lead_table(spark, folder), ["price", "quantity"], ["cell", "step"], smooth=2)
    return rounded(features, 6, "anom_price", "anom_quantity").select("cell", "step", "time", "anom_price", "anom_quantity")


def climatology_lookup(spark, folder):
    """Weeks without a normal (53 on full years only) stay, with nulls."""
    series = orders_series(spark, folder)
    normals = weekly_climatology(series.where(F.weekofyear("time") < 53), ["value"], KEY, smooth=0)
    out = attach_climatology(series, normals, KEY)
    return rounded_off_tie(out, "clim_value", "std_value").select("station_id", "time", "clim_value", "std_value")


def lead_accumulate(spark, folder):
    leads = lead_table(spark, folder)
    plain = accumulate_between(leads, ["price"], ["cell"], 2, 7).withColumn("kind", F.lit("plain"))
    clipped = accumulate_between(leads, ["price"], ["cell"], 2, 7, clip=True).withColumn("kind", F.lit("clipped"))
    return rounded(plain.unionByName(clipped), 2, "price")


def lead_mean(spark, folder):
    out = mean_over_leads(lead_table(spark, folder), ["price", "quantity"], [2, 3, 4], ["cell", "time"])
    return rounded(out, 5, "price", "quantity")


def lead_select(spark, folder):
    return select_leads(lead_table(spark, folder), [2, 3, 4])


def first_run_per_day(spark, folder):
    events = table(spark, folder, "events").withColumn("time", F.to_date("ts"))
    return first_per_key(events.select("user_id", "time", "ts", "event_id", "value"), ["user_id", "time"], ["ts"])


def variance_scaling(spark, folder):
    out = mean_variance_scaling(two_sources(spark, folder), KEY, "observed", "product", "adjusted", "blended")
    return rounded(out, 4, "adjusted", "blended").select("station_id", "time", "adjusted", "blended")


def monthly_bias(spark, folder):
    src = two_sources(spark, folder)
    factors = monthly_bias_factors(src, KEY, "observed", "product", 26)
    out = apply_monthly_bias(src, factors, KEY, "product", "adjusted").withColumn("blended", blend("observed", "adjusted"))
    return rounded(out, 4, "bias_factor", "adjusted", "blended").select("station_id", "time", "bias_factor", "adjusted", "blended")


def weekly_shares(spark, folder):
    out = weekly_share(two_sources(spark, folder), KEY, "observed", "product", "share", "adjusted")
    return rounded(out, 6, "share").withColumn("adjusted", F.round("adjusted", 4)).select("station_id", "time", "share", "adjusted")


def weekly_sums(spark, folder):
    out = rounded(weekly_sum(orders_series(spark, folder), KEY, "value"), 2, "value")
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("year", "week")})


def monthly_compare(spark, folder):
    return rounded(monthly_comparison(two_sources(spark, folder), KEY, ["observed", "product"]), 2, "observed", "product")


QUERIES = {
    "doy_percentile": doy_percentiles,
    "doy_moments": doy_means,
    "cold_percentile_target": cold_percentiles,
    "weekly_climatology": weekly_normals,
    "smoothed_climatology": smoothed_normals,
    "climatology_lookup": climatology_lookup,
    "anomaly_train": anomaly_train,
    "anomaly_stored": anomaly_stored,
    "raw_anomaly": raw_anomalies,
    "multi_variable_anomaly": multi_variable_anomaly,
    "lead_accumulate": lead_accumulate,
    "lead_mean": lead_mean,
    "lead_select": lead_select,
    "first_run_per_day": first_run_per_day,
    "mean_variance_scaling": variance_scaling,
    "monthly_bias_factor": monthly_bias,
    "weekly_share": weekly_shares,
    "weekly_sum": weekly_sums,
    "monthly_compare": monthly_compare,
}


def weekly_sql(source: str, values: list[str], cell: list[str], smooth: int, extra: str = "true") -> str:
    """CTE chain ending in ``normals`` (cell, week, clim_v, std_v)."""
    keys = ", ".join(cell)
    same = " and ".join(f"a.{c} = b.{c}" for c in cell)
    stats = ", ".join(f"avg({v}) as clim_{v}, stddev_pop({v}) as std_{v}" for v in values)
    means = ", ".join(f"avg(b.{p}_{v}) as {p}_{v}" for v in values for p in ("clim", "std"))
    groups = ", ".join(f"a.{c}" for c in cell)
    raw = f"""
        full_years as (select year(time) as y from (select distinct time from {source} where {extra}) group by 1 having count(*) >= 360),
        raw_normals as (select {keys}, weekofyear(time) as week, {stats} from {source}
                        where {extra} and year(time) in (select y from full_years) group by {keys}, week)"""
    if not smooth:
        return raw + ", normals as (select * from raw_normals)"
    near = "least(abs(a.p - b.p), a.n - abs(a.p - b.p))"
    return raw + f""",
        placed as (select *, row_number() over (partition by {keys} order by week) as p,
                   count(*) over (partition by {keys}) as n from raw_normals),
        normals as (select {groups}, a.week, {means} from placed a join placed b on {same} and {near} <= {smooth}
                    group by {groups}, a.week)"""


def _anomaly_sql(source: str, values: list[str], cell: list[str]) -> str:
    same = " and ".join(f"s.{c} = c.{c}" for c in cell)
    anomalies = ", ".join(f"round((s.{v} - c.clim_{v}) / nullif(c.std_{v}, 0), 6) as anom_{v}" for v in values)
    return f"{anomalies} from {source} s left join normals c on {same} and c.week = weekofyear(s.time)"


def _lead_input(steps: str) -> str:
    return f"src as (select cell, step, cast(time + interval 2 day as date) as time, price as t2m from ({LEADS}) where step in ({steps}))"


_RAIN = f"""
    leads as ({LEADS}),
    rain as (select cell, cast(time + interval 1 day as date) as time,
                    case when hi - lo is not null then greatest(hi - lo, 0) end as price_cum
             from (select cell, time, max(price) filter (step = 1) as lo, max(price) filter (step = 4) as hi
                   from leads where step in (1, 4) group by 1, 2))
"""
_MONTH = "over (partition by station_id, month(time))"
_WEEK = "over (partition by station_id, year(time), weekofyear(time))"

ORACLES = {
    "doy_percentile": f"""
        with src as (select *, dayofyear(time) as doy from ({ORDERS_SERIES})), p as ({percentile_sql('src', 'value', 3)})
        select s.station_id, s.time, s.value, p.perc as perc_value from src s
        left join p on p.station_id = s.station_id and p.time = s.time""",
    "doy_moments": f"""
        with src as (select *, dayofyear(time) as doy from ({ORDERS_SERIES})),
        c as ({doy_moments_sql('src', 7, off_tie_sql)})
        select s.station_id, s.time, c.m as mean, c.sd as std from src s
        left join c on c.station_id = s.station_id and c.doy = s.doy""",
    "cold_percentile_target": f"""
        with src as (select *, dayofyear(time) as doy from ({ORDERS_SERIES})),
        means as (select station_id, time, doy, round({_ahead('avg(value)', 3)}, 6) as next3d from src),
        p as ({percentile_sql('means', 'next3d', 3)})
        select m.station_id, m.time, p.perc,
               cast(case when p.perc <= 3 then 1 else 0 end as bigint) as "target_P3",
               cast(case when p.perc <= 5 then 1 else 0 end as bigint) as "target_P5",
               cast(case when p.perc <= 10 then 1 else 0 end as bigint) as "target_P10"
        from means m left join p on p.station_id = m.station_id and p.time = m.time""",
    "weekly_climatology": f"""
        with src as ({ORDERS_SERIES}), {weekly_sql('src', ['value'], ['station_id'], 0)}
        select station_id, week, {off_tie_sql('clim_value')} as clim_value, {off_tie_sql('std_value')} as std_value from normals""",
    "smoothed_climatology": f"""
        with src as ({ORDERS_SERIES}), {weekly_sql('src', ['value'], ['station_id'], 2)}
        select station_id, week, round(clim_value, 4) as clim_value, round(std_value, 4) as std_value from normals""",
    "climatology_lookup": f"""
        with src as ({ORDERS_SERIES}), {weekly_sql('src', ['value'], ['station_id'], 0, 'weekofyear(time) < 53')}
        select s.station_id, s.time, {off_tie_sql('clim_value')} as clim_value, {off_tie_sql('std_value')} as std_value
        from src s left join normals c on s.station_id = c.station_id and c.week = weekofyear(s.time)""",
    "anomaly_train": f"""
        with {_lead_input('2, 3, 4')}, {weekly_sql('src', ['t2m'], ['cell', 'step'], 2)}
        select s.cell, s.step, s.time, s.t2m, {_anomaly_sql('src', ['t2m'], ['cell', 'step'])}""",
    "anomaly_stored": f"""
        with {_lead_input('2, 3')}, {weekly_sql('src', ['t2m'], ['cell', 'step'], 2)}
        select s.cell, s.step, s.time, s.t2m, {_anomaly_sql('src', ['t2m'], ['cell', 'step'])}""",
    "raw_anomaly": f"""
        with {_RAIN}, {weekly_sql('rain', ['price_cum'], ['cell'], 1)}
        select r.cell, r.time, round(r.price_cum, 4) as price_cum, round(c.clim_price_cum, 4) as clim_price_cum,
               round(r.price_cum - c.clim_price_cum, 4) as anom_price_cum
        from rain r left join normals c on r.cell = c.cell and c.week = weekofyear(r.time)""",
    "multi_variable_anomaly": f"""
        with src as ({LEADS}), {weekly_sql('src', ['price', 'quantity'], ['cell', 'step'], 2)}
        select s.cell, s.step, s.time, {_anomaly_sql('src', ['price', 'quantity'], ['cell', 'step'])}""",
    "lead_accumulate": f"""
        with leads as ({LEADS}),
        d as (select cell, cast(time + interval 2 day as date) as time,
                     max(price) filter (step = 7) - max(price) filter (step = 2) as price
              from leads where step in (2, 7) group by cell, leads.time)
        select cell, time, round(price, 2) as price, 'plain' as kind from d
        union all select cell, time, case when price is not null then round(greatest(price, 0), 2) end, 'clipped' from d""",
    "lead_mean": f"""
        select cell, time, round(avg(price), 5) as price, round(avg(quantity), 5) as quantity
        from ({LEADS}) where step in (2, 3, 4) group by 1, 2""",
    "lead_select": f"""
        select cell, cast(time + interval 2 day as date) as time, step, price, quantity from ({LEADS}) where step in (2, 3, 4)""",
    "first_run_per_day": """
        select user_id, time, ts, event_id, value from (
            select *, cast(ts as date) as time,
                   row_number() over (partition by user_id, cast(ts as date) order by ts, event_id) as rn from events)
        where rn = 1""",
    "mean_variance_scaling": f"""
        with {TWO_SOURCES}, scaled as (
            select *, avg(observed) {_MONTH} + stddev_samp(observed) {_MONTH} / nullif(stddev_samp(product) {_MONTH}, 0)
                      * (product - avg(product) {_MONTH}) as adjusted from src)
        select station_id, time, round(adjusted, 4) as adjusted,
               round((coalesce(observed, adjusted) + coalesce(adjusted, observed)) / 2, 4) as blended from scaled""",
    "monthly_bias_factor": f"""
        with {TWO_SOURCES}, monthly as (
            select station_id, year(time) as y, month(time) as month, coalesce(sum(product), 0) as p,
                   coalesce(sum(observed), 0) as o, count(observed) as n from src group by 1, 2, 3 having count(observed) >= 26),
        f as (select station_id, month, case when avg(p) = 0 then 1 else avg(o) / avg(p) end as bias_factor from monthly group by 1, 2),
        a as (select src.*, coalesce(bias_factor, 1) as bias_factor, product * coalesce(bias_factor, 1) as adjusted
              from src left join f on f.station_id = src.station_id and f.month = month(src.time))
        select station_id, time, round(bias_factor, 4) as bias_factor, round(adjusted, 4) as adjusted,
               round(0.5 * coalesce(observed, 0) + 0.5 * adjusted, 4) as blended from a""",
    "weekly_share": f"""
        with {TWO_SOURCES}, w as (
            select *, coalesce(sum(product) {_WEEK}, 0) as total, coalesce(sum(observed) {_WEEK}, 0) as observed_total from src),
        s as (select *, case when total = 0 then 0 else product / total end as share from w)
        select station_id, time, round(share, 6) as share, round(share * observed_total, 4) as adjusted from s""",
    "weekly_sum": f"""
        select station_id, year(time) as year, weekofyear(time) as week, round(coalesce(sum(value), 0), 2) as value
        from ({ORDERS_SERIES}) group by 1, 2, 3""",
    "monthly_compare": f"""
        with {TWO_SOURCES} select station_id, strftime(time, '%Y%m') as yearmon,
        round(coalesce(sum(observed), 0), 2) as observed, round(coalesce(sum(product), 0), 2) as product from src group by 1, 2""",
}

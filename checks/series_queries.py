"""Calendars, gap filling, forward windows and event flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from perilspark.functions.flags import flag
from perilspark.functions.temporal import Calendar, previous_day, with_time_parts
from perilspark.operators.calendar import coverage_audit, fill_gaps, missing_days, repeat_over_calendar, restrict_to_calendar
from perilspark.operators.climatology import doy_moments
from perilspark.operators.series import forward_mean, forward_sum, run_target
from perilspark.plans.targets import cold_day_target, rain_percentile_target

from . import EVENTS_SERIES, ORDERS_SERIES, events_series, lon_sql, orders_series, point_lon, table

MONTH = Calendar("2024-01-01", "2024-01-31")
YEARS = Calendar("1995-01-01", "2001-12-31")
KEY = ["station_id"]


def calendar_gapfill(spark, folder):
    series = events_series(spark, folder).withColumn("lon", point_lon("station_id"))
    return fill_gaps(series, KEY, MONTH, carry=["lon"]).select("station_id", "time", "lon", "value")


def coverage(spark, folder):
    orders = table(spark, folder, "orders")
    return coverage_audit(orders, YEARS, "o_orderdate").withColumn("year", F.col("year").cast("bigint"))


def uncovered_days(spark, folder):
    return missing_days(table(spark, folder, "orders"), YEARS, "o_orderdate")


def forward_sums(spark, folder):
    filled = fill_gaps(events_series(spark, folder), KEY, MONTH)
    out = filled.withColumns({f"next{d}d": F.round(forward_sum("value", KEY, d), 2) for d in (3, 5)})
    return out.select("station_id", "time", "next3d", "next5d")


def forward_means(spark, folder):
    filled = fill_gaps(events_series(spark, folder), KEY, MONTH)
    out = filled.withColumns({f"mean{d}d": F.round(forward_mean("value", KEY, d), 5) for d in (3, 5)})
    return out.select("station_id", "time", "mean3d", "mean5d")


def cold_run_target(spark, folder):
    filled = fill_gaps(events_series(spark, folder), KEY, MONTH)
    flagged = filled.withColumn("low", flag(F.col("value") <= 60))
    for days in (2, 3):
        flagged = run_target(flagged, "low", KEY, days, f"n_next{days}d", f"target_{days}d")
    return flagged.drop("value").withColumns(
        {c: F.col(c).cast("bigint") for c in ("low", "n_next2d", "n_next3d", "target_2d", "target_3d")}
    )


def event_flags(spark, folder):
    filled = fill_gaps(events_series(spark, folder), KEY, MONTH)
    v = F.col("value")
    return filled.select(
        "station_id", "time",
        flag(v <= 10).cast("bigint").alias("low_bin"),
        flag(v > 0).cast("bigint").alias("wet_bin"),
    )


def sd_target(spark, folder):
    """Runs of days below the day-of-year normal, on gap-filled series."""
    filled = fill_gaps(orders_series(spark, folder), KEY, YEARS)
    out = cold_day_target(filled, "value", KEY, sd_thresholds=[0.5, 1], run_days=[3, 5], suffix="final")
    keep = [c for c in out.columns if c.startswith(("flag_", "n_", "target_"))]
    renamed = out.select("station_id", "time", *[F.col(f"`{c}`").cast("bigint").alias(c.replace(".", "_")) for c in keep])
    return renamed


def sd_target_records(spark, folder):
    """The same on records only: "next days" means next records."""
    out = cold_day_target(orders_series(spark, folder), "value", KEY, sd_thresholds=[0.5], run_days=[3], suffix="rec")
    return out.select(
        "station_id", "time", F.col("`target_0.5sd_3d_rec`").cast("bigint").alias("target"),
        F.col("`n_0.5sd_next3d_rec`").cast("bigint").alias("run"),
    )


def percentile_target(spark, folder):
    filled = fill_gaps(orders_series(spark, folder), KEY, YEARS)
    out = rain_percentile_target(filled, "value", KEY, percentiles=[90, 95, 97], sum_days=[3, 5], suffix="final", name="prcp")
    return out.select(
        "station_id", "time",
        *[F.round(f"prcp_next{d}d_final", 2).alias(f"next{d}d") for d in (3, 5)],
        *[F.col(f"perc_prcp_next{d}d_final").alias(f"perc{d}d") for d in (3, 5)],
        *[F.col(f"target_P{p}_{d}d_final").cast("bigint").alias(f"target_P{p}_{d}d") for d in (3, 5) for p in (90, 95, 97)],
    )


def calendar_semi_join(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("time"))
    weekly = restrict_to_calendar(orders, Calendar("1996-01-01", "1999-12-31", 7))
    monthly = restrict_to_calendar(orders, Calendar("1996-01-01", "1999-12-31", 1, "month"))
    return weekly.withColumn("step", F.lit("7 days")).unionByName(monthly.withColumn("step", F.lit("1 month")))


def time_parts(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("time"))
    parts = ["dayofyear", "week", "month", "year"]
    out = with_time_parts(orders, [*parts, "yearmon"])
    return out.withColumns({p: F.col(p).cast("bigint") for p in parts})


def day_shift(spark, folder):
    return previous_day(events_series(spark, folder)).select("station_id", "time", "time_orig", "value")


def static_repeat(spark, folder):
    points = table(spark, folder, "supplier").select("s_suppkey", point_lon("s_suppkey").alias("lon"))
    return repeat_over_calendar(points, Calendar("2024-01-01", "2024-01-10"))


QUERIES = {
    "calendar_gapfill": calendar_gapfill,
    "coverage_audit": coverage,
    "missing_days": uncovered_days,
    "forward_sum": forward_sums,
    "forward_mean": forward_means,
    "cold_run_target": cold_run_target,
    "event_flags": event_flags,
    "sd_target": sd_target,
    "sd_target_records": sd_target_records,
    "percentile_target": percentile_target,
    "calendar_semi_join": calendar_semi_join,
    "time_parts": time_parts,
    "day_shift": day_shift,
    "static_repeat": static_repeat,
}

_DAYS = "select cast(unnest(generate_series(date '{0}', date '{1}', interval 1 day)) as date) as time"
_MONTH_DAYS = _DAYS.format("2024-01-01", "2024-01-31")
_YEAR_DAYS = _DAYS.format("1995-01-01", "2001-12-31")
EVENTS_FILLED = f"""
    series as ({EVENTS_SERIES}), days as ({_MONTH_DAYS}),
    filled as (
        select s.station_id, days.time, series.value
        from (select distinct station_id from series) s cross join days
        left join series on series.station_id = s.station_id and series.time = days.time)
"""
ORDERS_FILLED = f"""
    series as ({ORDERS_SERIES}), days as ({_YEAR_DAYS}),
    filled as (
        select s.station_id, days.time, series.value, dayofyear(days.time) as doy
        from (select distinct station_id from series) s cross join days
        left join series on series.station_id = s.station_id and series.time = days.time)
"""


def _ahead(expression: str, days: int) -> str:
    frame = f"(partition by station_id order by time rows between current row and {days - 1} following)"
    return f"case when count(*) over {frame} = {days} then {expression} over {frame} end"


def doy_moments_sql(source: str, window: int, finish=lambda e: f"round({e}, 4)") -> str:
    """CTE body: day-of-year mean and std over a circular window."""
    near = "least(abs(a.doy - b.doy), 365 - abs(a.doy - b.doy))"
    return f"""
        select a.station_id, a.doy, {finish('avg(b.value)')} as m, {finish('stddev_pop(b.value)')} as sd
        from (select distinct station_id, doy from {source} where doy <= 365) a
        join {source} b on a.station_id = b.station_id and b.doy <= 365 and {near} <= {window}
        group by 1, 2
    """


def _sd_sql(source_ctes: str, source: str, thresholds, days, suffix: str, plain: bool) -> str:
    flags = ", ".join(
        f"case when f.value <= c.m - {t} * c.sd then 1 else 0 end as \"flag_tmin_{str(t).replace('.', '_')}sd_{suffix}\""
        for t in thresholds
    )
    cols = []
    for t in thresholds:
        name = str(t).replace(".", "_")
        flag_col = f'"flag_tmin_{name}sd_{suffix}"'
        if not plain:
            cols.append(f"cast({flag_col} as bigint) as {flag_col}")
        for d in days:
            run = _ahead(f"sum({flag_col})", d)
            n, target = (f'"n_{name}sd_next{d}d_{suffix}"', f'"target_{name}sd_{d}d_{suffix}"') if not plain else ("run", "target")
            cols.append(f"cast({run} as bigint) as {n}")
            cols.append(f"cast(case when {run} >= {d} then 1 else 0 end as bigint) as {target}")
    return f"""
        with {source_ctes}, clim as ({doy_moments_sql(source, 7)}),
        flagged as (
            select f.station_id, f.time, {flags}
            from {source} f left join clim c on f.station_id = c.station_id and f.doy = c.doy)
        select station_id, time, {', '.join(cols)} from flagged
    """


def percentile_sql(source: str, value: str, window: int) -> str:
    near = "least(abs(a.doy - b.doy), 365 - abs(a.doy - b.doy))"
    return f"""
        select a.station_id, a.time,
               round((2 * count(*) filter (b.{value} < a.{value}) + count(*) filter (b.{value} = a.{value}) + 1)
                     / 2 / count(*) * 100, 4) as perc
        from {source} a join {source} b
          on a.station_id = b.station_id and a.doy <= 365 and b.doy <= 365 and {near} <= {window}
        where a.{value} is not null and b.{value} is not null
        group by 1, 2
    """


def _percentile_target_sql() -> str:
    picks = ", ".join(
        [f"s.next{d}d, p{d}.perc as perc{d}d" for d in (3, 5)]
        + [f"cast(case when p{d}.perc >= {p} then 1 else 0 end as bigint) as \"target_P{p}_{d}d\"" for d in (3, 5) for p in (90, 95, 97)]
    )
    joins = " ".join(f"left join p{d} on p{d}.station_id = s.station_id and p{d}.time = s.time" for d in (3, 5))
    return f"""
        with {ORDERS_FILLED},
        sums as (select station_id, time, doy, round({_ahead('sum(value)', 3)}, 2) as next3d,
                        round({_ahead('sum(value)', 5)}, 2) as next5d from filled),
        p3 as ({percentile_sql('sums', 'next3d', 3)}), p5 as ({percentile_sql('sums', 'next5d', 3)})
        select s.station_id, s.time, {picks} from sums s {joins}
    """


ORACLES = {
    "calendar_gapfill": f"with {EVENTS_FILLED} select station_id, time, {lon_sql('station_id')} as lon, value from filled",
    "coverage_audit": f"""
        with days as ({_YEAR_DAYS}), landed as (select distinct cast(o_orderdate as date) as time from orders),
        counts as (select year(days.time) as year, count(*) as expected_days, count(landed.time) as landed_days
                   from days left join landed on landed.time = days.time group by 1)
        select year, expected_days, landed_days, expected_days - landed_days as missing_days,
               case when landed_days >= 300 then 1 else 0 end as complete,
               case when landed_days = 0 then 'missing' when landed_days < expected_days then 'partial' else 'success' end as status
        from counts""",
    "missing_days": f"""
        select time from ({_YEAR_DAYS}) where time not in (select cast(o_orderdate as date) from orders)""",
    "forward_sum": f"""
        with {EVENTS_FILLED} select station_id, time, round({_ahead('sum(value)', 3)}, 2) as next3d,
        round({_ahead('sum(value)', 5)}, 2) as next5d from filled""",
    "forward_mean": f"""
        with {EVENTS_FILLED} select station_id, time, round({_ahead('avg(value)', 3)}, 5) as mean3d,
        round({_ahead('avg(value)', 5)}, 5) as mean5d from filled""",
    "cold_run_target": f"""
        with {EVENTS_FILLED}, flagged as (select station_id, time, case when value <= 60 then 1 else 0 end as low from filled),
        runs as (select *, {_ahead('sum(low)', 2)} as n2, {_ahead('sum(low)', 3)} as n3 from flagged)
        select station_id, time, cast(low as bigint) as low, cast(n2 as bigint) as n_next2d, cast(n3 as bigint) as n_next3d,
               cast(case when n2 >= 2 then 1 else 0 end as bigint) as target_2d,
               cast(case when n3 >= 3 then 1 else 0 end as bigint) as target_3d from runs""",
    "event_flags": f"""
        with {EVENTS_FILLED} select station_id, time, cast(case when value <= 10 then 1 else 0 end as bigint) as low_bin,
        cast(case when value > 0 then 1 else 0 end as bigint) as wet_bin from filled""",
    "sd_target": _sd_sql(ORDERS_FILLED, "filled", [0.5, 1], [3, 5], "final", False),
    "sd_target_records": _sd_sql(
        f"series as ({ORDERS_SERIES}), rec as (select *, dayofyear(time) as doy from series)", "rec", [0.5], [3], "rec", True
    ),
    "percentile_target": _percentile_target_sql(),
    "calendar_semi_join": """
        with o as (select o_orderkey, cast(o_orderdate as date) as time from orders)
        select o_orderkey, time, '7 days' as step from o where time in
          (select cast(unnest(generate_series(date '1996-01-01', date '1999-12-31', interval 7 day)) as date))
        union all select o_orderkey, time, '1 month' from o where time in
          (select cast(unnest(generate_series(date '1996-01-01', date '1999-12-31', interval 1 month)) as date))""",
    "time_parts": """
        select o_orderkey, cast(o_orderdate as date) as time, dayofyear(o_orderdate) as dayofyear, weekofyear(o_orderdate) as week,
        month(o_orderdate) as month, year(o_orderdate) as year, strftime(o_orderdate, '%Y%m') as yearmon from orders""",
    "day_shift": f"""
        select station_id, cast(time - interval 1 day as date) as time, time as time_orig, value from ({EVENTS_SERIES})""",
    "static_repeat": f"""
        select s_suppkey, {lon_sql('s_suppkey')} as lon, d.time from supplier cross join
        ({_DAYS.format('2024-01-01', '2024-01-10')}) d""",
}

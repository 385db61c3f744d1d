"""Forecast tables: lead selection, valid dates, accumulation between leads.

A forecast has one row per issue time, lead ``step`` (days) and cell.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCUMULATED = {"tp", "prcp"}  # fixed values: rain totals since issue time
NO_LEAD = {"tp_chirps", "prcp_chirps"}  # fixed values: gridded rain without leads


def lead_days(step: Column | str) -> Column:
    """A lead given as a day-time interval, in days."""
    s = F.col(step) if isinstance(step, str) else step
    return (F.unix_micros(F.timestamp_micros(F.lit(0)) + s) / 86_400_000_000).cast("double")


def valid_day(time: Column | str, lead_offset_days: int) -> Column:
    """Issue date moved to the first day the selected leads cover."""
    return F.date_add(F.to_date(F.col(time) if isinstance(time, str) else time), lead_offset_days)


def select_leads(df: DataFrame, steps: list[int], time: str = "time", step: str = "step") -> DataFrame:
    """Keep the wanted leads and relabel time by the smallest one."""
    return df.where(F.col(step).isin(*steps)).withColumn(time, valid_day(time, min(steps)))


def accumulate_between(
    df: DataFrame,
    values: list[str],
    cell: list[str],
    low: int,
    high: int,
    time: str = "time",
    step: str = "step",
    clip: bool = False,
    shift_hours: int | None = None,
    suffix: str = "",
) -> DataFrame:
    """Value at lead ``high`` minus value at lead ``low`` per cell and time.

    One aggregation with map-side combine; a missing side gives null.
    ``clip`` floors at 0. Time moves by ``low`` days, or by ``shift_hours``.
    """
    at = {"low": low, "high": high}
    picks = [F.max(F.when(F.col(step) == s, F.col(v))).alias(f"_{v}_{k}") for v in values for k, s in at.items()]
    issue = F.col(time)
    valid = valid_day(issue, low) if shift_hours is None else issue + F.lit(dt.timedelta(hours=shift_hours))
    # An issue time that lacks both leads has no difference to report.
    both = df.where(F.col(step).isin(low, high)).groupBy(*cell, issue).agg(*picks)

    def difference(v: str) -> Column:
        raw = F.col(f"_{v}_high") - F.col(f"_{v}_low")
        return F.when(raw.isNotNull(), F.greatest(raw, F.lit(0.0))) if clip else raw

    return both.select(*cell, valid.alias(time), *[difference(v).alias(f"{v}{suffix}") for v in values])


def forecast_feature_input(df: DataFrame, variable: str, steps: list[int], cell: list[str], time: str = "time") -> tuple[DataFrame, list[str]]:
    """Bring one variable to (cell[, step], day, value); returns its cell keys."""
    if variable in ACCUMULATED:
        return accumulate_between(df, [variable], cell, min(steps), max(steps), time), cell
    if variable in NO_LEAD:
        return df.select(*cell, F.to_date(time).alias(time), variable), cell
    leads = select_leads(df.select(*cell, time, "step", variable), steps, time)
    return leads, [*cell, "step"]


def mean_over_leads(df: DataFrame, values: list[str], steps: list[int], keys: list[str], step: str = "step") -> DataFrame:
    return df.where(F.col(step).isin(*steps)).groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values])


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    An aggregate, not a window: repeated runs of one day are reduced before
    the shuffle, however many copies a key has.
    """
    rest = [c for c in df.columns if c not in keys]
    # Order by the stated columns, then by the others so that ties repeat exactly.
    named = {c for c in order if isinstance(c, str)}
    ranked = F.struct(*order, *[c for c in rest if c not in named])
    return df.groupBy(*keys).agg(F.min(ranked).alias("_first")).select(*[
        c if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns
    ])

"""Bias correction and blending of a station and a gridded series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import mean_of_available


def mean_variance_scaling(df: DataFrame, station: list[str], observed: str, product: str, adjusted: str, blended: str) -> DataFrame:
    """Scale the product to the observed mean and sample std per month.

    The blend is the mean of whichever of the two values is present. A
    station-month holds at most 31 rows per year.
    """
    month = Window.partitionBy(*station, F.month("time"))
    ratio = F.try_divide(F.stddev_samp(observed).over(month), F.stddev_samp(product).over(month))
    centred = F.col(product) - F.avg(product).over(month)
    scaled = df.withColumn(adjusted, F.avg(observed).over(month) + ratio * centred)
    return scaled.withColumn(blended, mean_of_available(observed, adjusted))


def monthly_bias_factors(df: DataFrame, station: list[str], observed: str, product: str, min_days: int = 26) -> DataFrame:
    """Ratio of mean monthly totals per station and calendar month.

    Only months with at least ``min_days`` observed days count.
    """
    monthly = (
        df.groupBy(*station, F.year("time").alias("year"), F.month("time").alias("month"))
        .agg(
            F.coalesce(F.sum(product), F.lit(0.0)).alias("product_total"),
            F.coalesce(F.sum(observed), F.lit(0.0)).alias("observed_total"),
            F.count(observed).alias("day_count"),
        )
        .where(F.col("day_count") >= min_days)
    )
    means = monthly.groupBy(*station, "month").agg(
        F.avg("product_total").alias("product_mean"), F.avg("observed_total").alias("observed_mean")
    )
    factor = F.when(F.col("product_mean") == 0, 1.0).otherwise(
        F.try_divide(F.col("observed_mean"), F.col("product_mean"))
    )
    return means.withColumn("bias_factor", factor)


def with_monthly_bias(
    df: DataFrame, station: list[str], observed: str, product: str, adjusted: str, min_days: int = 26
) -> DataFrame:
    """Add ``bias_factor`` and the product multiplied by it, in place.

    The same factors as ``monthly_bias_factors`` (1 where there is none), as
    windows within a station: on a series partitioned by station this costs no
    shuffle and no join.
    """
    year_month = Window.partitionBy(*station, F.year("time"), F.month("time"))
    month = Window.partitionBy(*station, F.month("time"))
    totals = df.withColumns(
        {
            "_p": F.coalesce(F.sum(product).over(year_month), F.lit(0.0)),
            "_o": F.coalesce(F.sum(observed).over(year_month), F.lit(0.0)),
            # One row speaks for its month, if the month has enough days.
            "_once": (F.row_number().over(year_month.orderBy("time")) == 1) & (F.count(observed).over(year_month) >= min_days),
        }
    )
    mean = {c: F.avg(F.when(F.col("_once"), F.col(c))).over(month) for c in ("_p", "_o")}
    factor = F.when(mean["_p"] == 0, 1.0).otherwise(F.coalesce(F.try_divide(mean["_o"], mean["_p"]), F.lit(1.0)))
    scaled = totals.withColumn("bias_factor", factor).withColumn(adjusted, F.col(product) * F.col("bias_factor"))
    return scaled.drop("_p", "_o", "_once")


def apply_monthly_bias(df: DataFrame, factors: DataFrame, station: list[str], product: str, adjusted: str) -> DataFrame:
    """Multiply the product by its month's factor (1 where there is none)."""
    lookup = factors.select(*station, "month", "bias_factor")
    joined = df.withColumn("month", F.month("time")).join(lookup, [*station, "month"], "left")
    factor = F.coalesce("bias_factor", F.lit(1.0))
    return joined.withColumns({"bias_factor": factor, adjusted: F.col(product) * factor}).drop("month")


def blend(observed: Column | str, adjusted: Column | str, weight: float = 0.5) -> Column:
    """Weighted sum with a missing observation counted as 0."""
    o = F.col(observed) if isinstance(observed, str) else observed
    a = F.col(adjusted) if isinstance(adjusted, str) else adjusted
    return weight * F.coalesce(o, F.lit(0.0)) + (1 - weight) * a


def weekly_share(df: DataFrame, station: list[str], observed: str, product: str, share: str, adjusted: str) -> DataFrame:
    """Spread the observed weekly total by the product's daily share."""
    week = Window.partitionBy(*station, F.year("time"), F.weekofyear("time"))
    total = F.coalesce(F.sum(product).over(week), F.lit(0.0))
    part = F.when(total == 0, 0.0).otherwise(F.try_divide(F.col(product), total))
    observed_total = F.coalesce(F.sum(observed).over(week), F.lit(0.0))
    return df.withColumns({share: part, adjusted: part * observed_total})


def weekly_sum(df: DataFrame, station: list[str], value: str) -> DataFrame:
    keys = [*station, F.year("time").alias("year"), F.weekofyear("time").alias("week")]
    return df.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(value))


def monthly_comparison(df: DataFrame, station: list[str], values: list[str]) -> DataFrame:
    """Monthly totals of several sources side by side."""
    keys = [*station, F.date_format("time", "yyyyMM").alias("yearmon")]
    return df.groupBy(*keys).agg(*[F.coalesce(F.sum(v), F.lit(0.0)).alias(v) for v in values])

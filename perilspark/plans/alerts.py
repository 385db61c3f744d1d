"""Alerts: levels on scores, administrative names, key figures, maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.flags import AlertThresholds, alert_level, is_actionable
from ..operators.spatial import polygon_join

ALERT_COLUMNS = ["idPolygon", "dept", "prov", "mun", "lon", "lat", "time", "pred_target", "alert_level"]
UNNAMED = "OTRO"  # fixed value: polygons outside the named municipalities


def with_alert_levels(scored: DataFrame, thresholds: AlertThresholds, probability: str = "pred_target") -> DataFrame:
    return scored.withColumn("alert_level", alert_level(probability, thresholds))


def alerts_with_admin(predictions: DataFrame, admin: DataFrame) -> DataFrame:
    """Orange and red points with their department, province, municipality.

    Points outside every named polygon are dropped, so the join is inner.
    """
    alerts = predictions.where(is_actionable("alert_level"))
    named = admin.where(F.col("mun").isNotNull() & (F.col("mun") != UNNAMED))
    return polygon_join(alerts, named, ["idPolygon", "dept", "prov", "mun"]).select(*ALERT_COLUMNS)


def alert_kpis(predictions: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Grid points, highest probability, orange and red counts."""
    return predictions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("points"),
        F.max("pred_target").alias("max_probability"),
        F.count_if(F.col("alert_level") == "Orange").alias("orange"),
        F.count_if(F.col("alert_level") == "Red").alias("red"),
    )


def grid_pivot(cells: DataFrame, value: str, lons: list[float]) -> DataFrame:
    """One row per latitude, one column per listed longitude.

    For maps on screen. The longitudes come from the grid definition, so
    Spark needs no extra pass to find them.
    """
    wide = cells.groupBy("lat").pivot("lon", lons).agg(F.first(value, ignorenulls=True))
    return wide.withColumnsRenamed({str(x): f"lon_{i}" for i, x in enumerate(lons)})


def grid_rows(cells: DataFrame, value: str) -> DataFrame:
    """One row per latitude with its (lon, value) pairs in order.

    The form for wide grids; a row is bounded by the length of the lon axis.
    """
    pairs = F.sort_array(F.collect_list(F.struct("lon", F.col(value).alias("value"))))
    return cells.groupBy("lat").agg(pairs.alias("cells"))

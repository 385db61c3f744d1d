"""0/1 flags and alert levels. A comparison with a missing value gives 0."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["AlertThresholds", "COLD_ALERTS", "RAIN_ALERTS", "alert_level", "flag", "is_actionable", "threshold_name"]


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


@dataclass(frozen=True)
class AlertThresholds:
    red: float
    orange: float


# Alert probabilities per hazard.
COLD_ALERTS = AlertThresholds(red=0.60, orange=0.12)
RAIN_ALERTS = AlertThresholds(red=0.40, orange=0.10)


def alert_level(probability: Column | str, thresholds: AlertThresholds) -> Column:
    """'Red', 'Orange' or 'None'; a threshold itself belongs to its level."""
    p = F.col(probability) if isinstance(probability, str) else probability
    return F.when(p >= thresholds.red, "Red").when(p >= thresholds.orange, "Orange").otherwise("None")


def is_actionable(level: Column | str) -> Column:
    return (F.col(level) if isinstance(level, str) else level).isin("Orange", "Red")


def threshold_name(value: float) -> str:
    """Text of a threshold inside a column name: 1.0 -> '1', 1.5 -> '1.5'."""
    return f"{value:g}"

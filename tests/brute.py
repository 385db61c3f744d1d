"""Slow, plain twins of the operators, for small fixtures and the baseline."""

from __future__ import annotations

import numpy as np
import pandas as pd


def circle(day: int, window: int) -> list[int]:
    return [(day + k - 1) % 365 + 1 for k in range(-window, window + 1)]


def doy_percentile(series: pd.DataFrame, value: str, station: str, window: int) -> pd.Series:
    """One filter and rank per day of year."""
    doy = pd.to_datetime(series["time"]).dt.dayofyear
    out = pd.Series(np.nan, index=series.index)
    for day in range(1, 366):
        near = series[doy.isin(circle(day, window))]
        rank = near.groupby(station)[value].rank(method="average", pct=True) * 100
        own = rank.index[doy.loc[rank.index] == day]
        out.loc[own] = rank.loc[own].round(4)
    return out


def doy_moments(series: pd.DataFrame, value: str, station: str, window: int) -> pd.DataFrame:
    doy = pd.to_datetime(series["time"]).dt.dayofyear
    out = pd.DataFrame(np.nan, index=series.index, columns=["mean", "std"])
    for day in range(1, 366):
        near = series[doy.isin(circle(day, window))].groupby(station)[value]
        own = series.index[doy == day]
        stats = pd.DataFrame({"mean": near.mean(), "std": near.std(ddof=0)})
        out.loc[own] = stats.reindex(series.loc[own, station]).to_numpy()
    return out


def box(z: np.ndarray, size: int, f) -> np.ndarray:
    half = size // 2
    padded = np.pad(z, half, mode="edge")
    return np.array([[f(padded[i : i + size, j : j + size]) for j in range(z.shape[1])] for i in range(z.shape[0])])


def auc(y: np.ndarray, p: np.ndarray) -> float:
    gap = p[y == 1][:, None] - p[y == 0][None, :]
    return float(((gap > 0) + 0.5 * (gap == 0)).mean())


def ks(y: np.ndarray, p: np.ndarray) -> float:
    return max(abs((p[y == 1] <= t).mean() - (p[y == 0] <= t).mean()) for t in np.unique(p))


def precision_at_recall(y: np.ndarray, p: np.ndarray, recall: float) -> float:
    best = 0.0
    for t in np.unique(p):
        hit = p >= t
        if y[hit].sum() / y.sum() >= recall:
            best = max(best, y[hit].mean())
    return float(best)


def quantile_class(scores: list[float], q: int) -> list[int]:
    """Ranks cut at interpolated quantiles of the ranks."""
    ranks = pd.Series(scores).rank(method="first", ascending=False)
    return (1 + pd.qcut(ranks, q, labels=False)).tolist()


def inside(x: float, y: float, ring: list[tuple[float, float]]) -> bool:
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * ((y - y1) / (y2 - y1)) + x1:
            odd = not odd
    return odd


def nearest(targets: np.ndarray, points: np.ndarray, k: int) -> dict:
    found = {}
    for t in targets:
        d = np.hypot(points[:, 0] - t[0], points[:, 1] - t[1]).round(12)
        order = np.lexsort((points[:, 0], points[:, 1], d))[:k]
        found[tuple(t)] = [tuple(points[i]) for i in order]
    return found

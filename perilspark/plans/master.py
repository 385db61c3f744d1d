"""Master table: every feature set on one grid and one time axis."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import Calendar, with_time_parts
from ..operators.calendar import repeat_over_calendar, restrict_to_calendar
from ..operators.columns import drop_missing
from ..operators.forecast import mean_over_leads
from ..operators.grid import GridSpec, match_to_grid, node_cells, regrid_nearest
from ..operators.joins import broadcast_if_small
from ..session import materialise

KEYS = ["lon", "lat", "time"]


@dataclass(frozen=True)
class FeatureSet:
    """Features in long form and, if known, the grid they are given on.

    Columns lon, lat, optionally time and step, and the feature values. A
    named ``grid`` saves reading the distinct coordinates of the table.
    """

    table: DataFrame
    grid: GridSpec | None = None


def _values(table: DataFrame) -> list[str]:
    return [c for c in table.columns if c not in (*KEYS, "step")]


def _merged(members: list[DataFrame], spine: DataFrame | None, calendar: Calendar, steps: list[int]) -> DataFrame:
    """Sets of one native grid, one row per cell and day, in one exchange.

    Lead means and the merge are the same aggregation. ``spine`` adds cells and
    days that need a row whether or not a set has one; ``_given`` tells them
    from rows of a set.
    """
    dated = [restrict_to_calendar(t, calendar) for t in members]
    # A value that several sets hold is averaged over leads within its set first.
    shared = {v for i, t in enumerate(dated) for u in dated[:i] for v in set(_values(t)) & set(_values(u))}
    rows, means = [], set()
    for t in dated:
        values = _values(t)
        if "step" in t.columns and shared & set(values):
            t = mean_over_leads(t, values, steps, KEYS)
        elif "step" in t.columns:
            t = t.where(F.col("step").isin(*steps)).drop("step")
            means |= set(values)
        rows.append(t.withColumn("_given", F.lit(True)))
    if spine is not None:
        rows.append(spine.withColumn("_given", F.lit(False)))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return _folded(stacked, KEYS, means)


def _folded(stacked: DataFrame, keys: list[str], means: set[str] = frozenset()) -> DataFrame:
    """One row per key with what its rows hold: a mean, or the one value that is there."""
    rest = [c for c in stacked.columns if c not in keys]
    how = {c: F.max(c) if c == "_given" else F.avg(c) if c in means else F.first(c, ignorenulls=True) for c in rest}
    return stacked.groupBy(*keys).agg(*[how[c].alias(c) for c in rest])


def _static_rows(static: list[FeatureSet], grid: GridSpec, nodes: DataFrame | None) -> DataFrame | None:
    """All static sets as one row per grid node."""
    if not static:
        return None
    placed = [regrid_nearest(f.table, grid, nodes=nodes, source=f.grid) for f in static]
    return _folded(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), placed), ["lon", "lat"])


def align_features(
    feature_sets: Sequence[FeatureSet | DataFrame],
    grid: GridSpec,
    calendar: Calendar,
    steps: list[int],
    nodes: DataFrame | None = None,
) -> DataFrame:
    """Outer merge of feature sets on (lon, lat, time) with time parts added.

    Sets on one native grid are merged there, by one aggregation that also
    takes lead means: what is shuffled is native cells times days, however
    fine the target grid is. Merged cells then go to the target nodes by a
    broadcast of axis maps, and static sets, folded to one row per node, join
    last; days on which only they have a node come from a spine of native cells.
    Only sets on different native grids meet in a second aggregation.

    A (lon, lat, time) is unique within a set, a (lon, lat) within a static one.
    ``nodes`` limits the work to some grid nodes from the first step on.
    """
    sets = [f if isinstance(f, FeatureSet) else FeatureSet(f) for f in feature_sets]
    static = _static_rows([f for f in sets if "time" not in f.table.columns], grid, nodes)
    groups: dict = {}
    for i, f in enumerate(sets):
        if "time" in f.table.columns:
            groups.setdefault(f.grid or i, []).append(f)
    if not groups:
        return with_time_parts(repeat_over_calendar(static, calendar), ["month", "week", "yearmon"])

    placed = []
    for i, members in enumerate(groups.values()):
        tables, source = [f.table for f in members], members[0].grid or members[0].table
        spine, needed = None, nodes is not None or (static is not None and i == 0)
        picks = node_cells(tables[0], grid, nodes, source=source) if needed else None
        if needed:
            cells = picks.select(F.col("_s_lon").alias("lon"), F.col("_s_lat").alias("lat")).distinct()
        if nodes is not None:
            wanted = grid.broadcast_nodes(cells)
            tables = [t.join(wanted, ["lon", "lat"], "left_semi") for t in tables]
        if static is not None and i == 0:
            spine = calendar.expand(cells)
        placed.append(regrid_nearest(_merged(tables, spine, calendar, steps), grid, nodes=nodes, source=source))
    merged = placed[0]
    if len(placed) > 1:
        merged = _folded(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), placed), KEYS)
    if static is not None:
        both = [v for v in _values(static) if v in merged.columns]
        renamed = static.withColumnsRenamed({v: f"_static_{v}" for v in both}).withColumn("_node", F.lit(True))
        merged = merged.join(grid.broadcast_nodes(renamed), ["lon", "lat"], "left").where(F.col("_given") | F.col("_node"))
        merged = merged.withColumns({v: F.coalesce(v, f"_static_{v}") for v in both}).drop("_node", *[f"_static_{v}" for v in both])
    return with_time_parts(merged.drop("_given"), ["month", "week", "yearmon"])


def station_nodes(stations: DataFrame, grid: GridSpec) -> DataFrame:
    """Distinct station coordinates with their grid node, written once."""
    distinct = stations.select("lon", "lat").distinct()
    return materialise(match_to_grid(distinct, grid, "lon", "lat", "node_lon", "node_lat"), "station-nodes")


def at_stations(grid_features: DataFrame, places: DataFrame) -> DataFrame:
    """Features of each station's nearest node, at the station's coordinates.

    ``places`` comes from ``station_nodes``.
    """
    nodes = grid_features.withColumnsRenamed({"lon": "node_lon", "lat": "node_lat"})
    return nodes.join(broadcast_if_small(places), ["node_lon", "node_lat"]).drop("node_lon", "node_lat")


def training_table(
    feature_sets: Sequence[FeatureSet | DataFrame],
    target_table: DataFrame,
    target: str,
    grid: GridSpec,
    calendar: Calendar,
    steps: list[int],
) -> DataFrame:
    """Features at the stations joined with observed targets."""
    places = station_nodes(target_table, grid)
    nodes = places.select(F.col("node_lon").alias("lon"), F.col("node_lat").alias("lat"))
    features = align_features(feature_sets, grid, calendar, steps, nodes)
    observed = drop_missing(target_table.where(calendar.between("time")), [target])
    rest = [c for c in observed.columns if c not in KEYS]
    # Targets go to their nodes, not the features of a node to all its stations and days.
    placed = observed.join(broadcast_if_small(places), ["lon", "lat"])
    features = features.withColumnsRenamed({"lon": "node_lon", "lat": "node_lat"})
    joined = placed.join(features, ["node_lon", "node_lat", "time"])
    return joined.select(*KEYS, *[c for c in features.columns if c not in ("node_lon", "node_lat", "time")], *rest)


def inference_table(feature_sets: Sequence[FeatureSet | DataFrame], grid: GridSpec, calendar: Calendar, steps: list[int]) -> DataFrame:
    """Features for every grid node."""
    return align_features(feature_sets, grid, calendar, steps)

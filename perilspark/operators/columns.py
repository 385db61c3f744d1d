"""Naming, selection and cleaning of table columns."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted spellings of coordinates and variables.
COORDINATE_ALIASES = {
    "lon": ["lon", "Lon", "longitude", "Longitude", "x", "X"],
    "lat": ["lat", "Lat", "latitude", "Latitude", "y", "Y"],
    "time": ["time", "valid_time", "Time", "date", "Date"],
}
VARIABLE_ALIASES = {
    "swc": ["swc", "swvl1", "soil_water_content", "sm", "soil_moisture"],
    "tp_chirps": ["prcp", "tp", "total_precipitation", "precipitation", "precip", "prc", "pcp"],
    "t2m": ["tmin", "t2m", "2t", "t", "mn2t6", "mn2t", "mn2t24", "minimum_2_m_temperature_in_the_last_6_hours"],
    "tmax": ["tmax", "t2m", "2t", "t", "mx2t6", "mx2t", "mx2t24", "maximum_2_m_temperature_in_the_last_6_hours"],
    "msl": ["msl", "mean_sea_level_pressure"],
    "u10": ["10u", "u10", "10_m_u_component_of_wind"],
    "v10": ["10v", "v10", "10_m_v_component_of_wind"],
    "tp": ["tp", "prcp", "total_precipitation", "precipitation", "precip", "prc", "pcp"],
    "q": ["q", "specific_humidity"],
    "altitude": ["altitude", "height", "h"],
}


def find_coordinates(df: DataFrame) -> dict[str, str | None]:
    """Which column plays lon, lat and time, by the accepted spellings."""
    present = set(df.columns)
    return {role: next((a for a in names if a in present), None) for role, names in COORDINATE_ALIASES.items()}


def canonical_names(df: DataFrame, variable: str | None) -> DataFrame:
    """Rename a variable and its coordinates to their canonical names."""
    if variable is None or variable not in VARIABLE_ALIASES:
        raise KeyError(f"no aliases are registered for variable {variable!r}")
    source = next((a for a in VARIABLE_ALIASES[variable] if a in df.columns), None)
    if source is None:
        raise KeyError(f"no column of the table can serve as {variable!r}")
    renames = {found: role for role, found in find_coordinates(df).items() if found}
    return df.withColumnsRenamed({**renames, source: variable})


def prefix_groups(df: DataFrame, groups: dict[str, dict[str, str] | None]) -> tuple[DataFrame, dict[str, str]]:
    """Rename ``{group: {short: column}}`` to ``<group>_<short>``; skip absentees."""
    renames = {
        column: f"{group}_{short}"
        for group, members in groups.items()
        for short, column in (members or {}).items()
        if column in df.columns
    }
    return df.withColumnsRenamed(renames), renames


def include_exclude(df: DataFrame, include: dict[str, list] | None = None, exclude: dict[str, list] | None = None) -> DataFrame:
    """Keep and drop rows by value lists; an unknown column is skipped.

    A row whose value is missing is not excluded.
    """
    for rules, keep in ((include, True), (exclude, False)):
        for column, values in (rules or {}).items():
            if column not in df.columns:
                warnings.warn(f"column {column!r} is not in the table; filter skipped", stacklevel=2)
                continue
            member = F.coalesce(F.col(column).isin(*values), F.lit(False))
            df = df.where(member if keep else ~member)
    return df


def select_locations(
    df: DataFrame,
    location_column: str | None,
    name: str = "location_id",
    include: dict[str, list] | None = None,
    exclude: dict[str, list] | None = None,
) -> DataFrame:
    """Filter rows and make ``location_column`` the location key.

    A column already called ``name`` is kept as ``<name>_orig``.
    """
    if location_column is None:
        raise ValueError("a location column is required")
    if location_column not in df.columns:
        raise KeyError(f"column {location_column!r} is not in the table")
    kept = include_exclude(df, include, exclude)
    if location_column == name:
        return kept
    return kept.withColumnsRenamed({name: f"{name}_orig", location_column: name})


def in_box(lon: str, lat: str, minx: float, miny: float, maxx: float, maxy: float, inclusive: bool = True) -> Column:
    """Bounding-box test; temperature includes the border, rain does not."""
    x, y = F.col(lon), F.col(lat)
    if inclusive:
        return x.between(minx, maxx) & y.between(miny, maxy)
    return (x > minx) & (x < maxx) & (y > miny) & (y < maxy)


def in_period(time: str, start, end) -> Column:
    return F.col(time).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns) if columns else df


def drop_constant_columns(df: DataFrame, candidates: list[str], keep: list[str] = ()) -> DataFrame:
    """Drop columns with at most one value; error if another one varies.

    Min and max decide, so the check is one aggregate without a distinct set.
    """
    tested = [c for c in candidates if c in df.columns and c not in keep]
    if not tested:
        return df
    spans = df.agg(*[F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(c) for c in tested]).first()
    varying = [c for c in tested if not spans[c]]
    if varying:
        raise ValueError(f"columns {varying} vary and cannot be dropped")
    return df.drop(*tested)


def split_columns(df: DataFrame, descriptive: list[str], target: str | None = None) -> tuple[list[str], list[str], str | None]:
    """Column roles: features, descriptive columns present, label."""
    features = [c for c in df.columns if c not in descriptive and c != target]
    return features, [c for c in df.columns if c in descriptive], target


def categorical_columns(df: DataFrame, ignore: list[str] = ()) -> list[str]:
    """Text and boolean columns outside ``ignore``."""
    return [name for name, kind in df.dtypes if kind in ("string", "boolean") and name not in ignore]


def as_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mark columns as categorical by casting them to text (indexed at training).

    Absent columns are skipped with a warning.
    """
    present = [c for c in columns if c in df.columns]
    for absent in set(columns) - set(present):
        warnings.warn(f"column {absent!r} is not in the table", stacklevel=2)
    return df.withColumns({c: F.col(c).cast("string") for c in present}) if present else df

"""Keys that order rows in a way that repeats anywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*columns: Column | str) -> Column:
    """MD5 of the columns as text, joined by bars: the same order in any engine."""
    return F.md5(F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]))

"""Running totals and ranks that never put one group into one task.

A plain ``Window.partitionBy(key).orderBy(score)`` sorts all rows of a key in
one task. These operators cut the order into buckets of about equal size
first and exchange rows once by (key, bucket). Windows run inside a bucket;
bucket totals, read from that same exchange, supply what lies before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructField, StructType

BUCKET = "_bucket"
_ORDER = "_order"
_BOUNDS = "_bounds"
#: Sampled rows per bucket where bounds come from a sample.
SAMPLE = 20


def bucket_count(df: DataFrame) -> int:
    """More buckets than shuffle partitions, so that their hashes spread evenly."""
    return max(8, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_place(df: DataFrame, value: str, bounds: str, n: int, name: str) -> DataFrame:
    """Add ``name``: how many of the sorted ``bounds``, an array of at most ``n``, lie below a value.

    A binary search, one projection a step, all within generated code.
    """
    df, step = df.withColumn(name, F.lit(0)), 1 << max(0, n.bit_length() - 1)
    while step:
        below = F.get(bounds, F.col(name) + (step - 1)) < F.col(value)
        df = df.withColumn(name, F.col(name) + F.when(below, step).otherwise(0))
        step >>= 1
    return df


def _with_bucket(df: DataFrame, value: str, bounds: Column, n: int) -> DataFrame:
    """Add ``_bucket``; ``bounds`` is a scalar subquery."""
    return with_place(df.withColumn(_BOUNDS, bounds), value, _BOUNDS, n, BUCKET).drop(_BOUNDS)


def _all(df: DataFrame) -> Column:
    """A hash of all columns. Plans that name the same columns share an exchange."""
    return F.xxhash64(*[f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)])


def with_level_bucket(levels: DataFrame, value: Column, buckets: int | None = None) -> DataFrame:
    """Add ``_bucket``: monotone in ``value``, about equal numbers of rows.

    Bounds are quantiles over the table itself, a subquery of the plan: a table
    that ends in an exchange (level counts) is computed and shuffled once for
    both.
    """
    n = buckets or bucket_count(levels)
    order = value.cast("double")
    # The hash is there for the shared exchange alone; bounds may be any.
    named = levels.select(F.when(_all(levels) != 0, order).alias(_ORDER))
    bounds = named.agg(F.percentile_approx(_ORDER, [i / n for i in range(1, n)], 10 * n))
    return _with_bucket(levels.withColumn(_ORDER, order), _ORDER, bounds.scalar(), n - 1).drop(_ORDER)


def with_row_bucket(df: DataFrame, by: list[Column], buckets: int | None = None) -> DataFrame:
    """Add ``_order`` (struct of ``by``) and ``_bucket``: monotone in it, about equal numbers of rows.

    Bounds are rows of a uniform sample, taken in one pass and held as
    constants, so rows that tie in the first columns are still cut by the
    others.
    """
    n = buckets or bucket_count(df)
    tagged = df.withColumn(_ORDER, F.struct(*[c.alias(f"o{i}") for i, c in enumerate(by)]))
    sample = tagged.select(_ORDER).orderBy(F.rand(7)).limit(SAMPLE * n).agg(F.sort_array(F.collect_list(_ORDER)).alias("s"))
    bounds = sample.select(F.filter("s", lambda _, i: i % SAMPLE == SAMPLE - 1).alias("s")).first()["s"]
    if not bounds:
        return tagged.withColumn(BUCKET, F.lit(0))
    kind = ArrayType(tagged.schema[_ORDER].dataType)
    held = df.sparkSession.createDataFrame([(bounds,)], StructType([StructField("b", kind)]))
    return _with_bucket(tagged, _ORDER, held.scalar(), len(bounds))


def _with_totals(tagged: DataFrame, local: DataFrame, keys: list[str], sums: dict[str, Column], direction) -> DataFrame:
    """``local`` joined with ``_before_<s>`` and ``total_<s>``: sums of a key before a bucket and over all of it.

    ``local`` is ``tagged`` with window columns; totals read the same exchange.
    """
    totals = tagged.groupBy(*keys, BUCKET).agg(*[c.alias(f"_t_{s}") for s, c in sums.items()], F.max(_all(tagged)).alias("_all"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    ahead = group.orderBy(direction(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.where(F.col("_all").isNotNull()).select(
        *[F.col(k).alias(f"_k_{k}") for k in [*keys, BUCKET]],
        *[F.coalesce(F.sum(f"_t_{s}").over(ahead), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(group).alias(f"total_{s}") for s in sums],
    )
    match = reduce(lambda a, b: a & b, [local[k].eqNullSafe(totals[f"_k_{k}"]) for k in [*keys, BUCKET]])
    return local.join(totals, match)


def running_sums(
    levels: DataFrame,
    keys: list[str],
    order: str,
    sums: list[str],
    descending: bool = False,
    value: Column | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Add ``cum_<s>`` (up to and including the row) and ``total_<s>`` per key.

    ``levels`` holds one row per (keys, order). ``value`` is the numeric form
    of ``order`` used for bucketing, where ``order`` itself is not numeric.
    """
    tagged = with_level_bucket(levels, F.col(order) if value is None else value, buckets).repartition(*keys, BUCKET)
    direction = F.desc if descending else F.asc
    inside = Window.partitionBy(*keys, BUCKET).orderBy(direction(order))
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.withColumns({f"cum_{s}": F.sum(s).over(inside) for s in sums})
    return _with_totals(tagged, local, keys, {s: F.sum(s) for s in sums}, direction).select(
        *levels.columns, *[(F.col(f"cum_{s}") + F.col(f"_before_{s}")).alias(f"cum_{s}") for s in sums], *[f"total_{s}" for s in sums]
    )


def ordered_row_number(df: DataFrame, keys: list[str], by: list[Column], name: str = "row_number", buckets: int | None = None) -> DataFrame:
    """``row_number`` per key, ascending by the columns ``by``, free of hot tasks.

    A bucket is cut by all of ``by``, so a key and a value may hold any share of
    the rows; only rows alike in all of them stay together, in the order of a
    hash of the row. Adds ``<name>`` and ``<name>_of`` (rows of the key).
    """
    tagged = with_row_bucket(df, by, buckets).repartition(*keys, BUCKET)
    inside = Window.partitionBy(*keys, BUCKET).orderBy(_ORDER, _all(tagged))
    local = tagged.withColumn("_in", F.row_number().over(inside))
    both = _with_totals(tagged, local, keys, {"n": F.count(F.lit(1))}, F.asc)
    return both.select(*df.columns, (F.col("_in") + F.col("_before_n")).alias(name), F.col("total_n").alias(f"{name}_of"))


def dense_rank_levels(df: DataFrame, order: str, name: str, descending: bool = False) -> DataFrame:
    """Table (order, dense rank) over the whole frame, missing values last."""
    levels = df.groupBy(order).agg(F.lit(1).alias("_one"))
    present = running_sums(levels.where(F.col(order).isNotNull()), [], order, ["_one"], descending)
    ranked = present.select(order, F.col("cum__one").alias(name), (F.col("total__one") + 1).alias("_last"))
    last = F.coalesce(present.agg(F.max("total__one")).scalar() + 1, F.lit(1))
    missing = levels.where(F.col(order).isNull()).select(order, last.alias(name))
    return ranked.select(order, name).unionByName(missing)

"""Grouped statistics.

All of these are plain ``groupBy().agg()`` plans, so Spark plans them as a
partial aggregate before the exchange and a final one after it: a key that
holds a third of all rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

DENSE_IDS = 256  # ids that a bitmap of 4 KB must stand for to be smaller than their (key, id) rows


def avg_count(
    df: DataFrame,
    keys: Sequence[str | Column],
    value: str = "rating",
    avg_name: str = "avg_rating",
    n_name: str = "n",
) -> DataFrame:
    """Average and number of non-NULL values per key."""
    return df.groupBy(*keys).agg(F.avg(value).alias(avg_name), F.count(value).alias(n_name))


def sum_count(
    df: DataFrame,
    keys: Sequence[str | Column],
    value: str = "rating",
    sum_name: str = "rating_sum",
    n_name: str = "rating_n",
) -> DataFrame:
    """Mergeable (sum, count of non-NULL values) per key, for pre-aggregating before a join."""
    return df.groupBy(*keys).agg(
        F.sum(value).alias(sum_name),
        F.count(value).alias(n_name),
    )


def merge_sum_count(
    df: DataFrame,
    keys: Sequence[str | Column],
    sum_col: str = "rating_sum",
    n_col: str = "rating_n",
    avg_name: str = "avg_rating",
    n_name: str = "n",
) -> DataFrame:
    """Combine partial (sum, count) rows into (average, count) per key."""
    return df.groupBy(*keys).agg(
        F.try_divide(F.sum(sum_col), F.sum(n_col)).alias(avg_name),
        F.sum(n_col).alias(n_name),
    )


def conditional_stats(
    df: DataFrame,
    keys: Sequence[str | Column],
    category: str | Column,
    categories: Sequence[tuple[str, str]],
    value: str = "rating",
    missing_avg: float | None = None,
    ignore_case: bool = False,
) -> DataFrame:
    """One row per key with ``<prefix>_avg`` / ``<prefix>_n`` for each (value, prefix).

    This is a pivot over a fixed category list written as conditional
    aggregates: one exchange instead of the two a ``pivot`` plans. A category
    with no rows gives avg NULL (or ``missing_avg``) and n = 0. Rows of other
    categories still make their key appear.
    """
    cat = F.col(category) if isinstance(category, str) else category
    if ignore_case:
        cat = F.upper(cat)
    aggs = []
    for cat_value, prefix in categories:
        match = cat == F.lit(cat_value.upper() if ignore_case else cat_value)
        avg = F.avg(F.when(match, F.col(value)))
        if missing_avg is not None:
            avg = F.coalesce(avg, F.lit(float(missing_avg)))
        aggs.append(avg.alias(f"{prefix}_avg"))
        aggs.append(F.count(F.when(match, F.col(value))).alias(f"{prefix}_n"))
    return df.groupBy(*keys).agg(*aggs)


def conditional_sums(
    df: DataFrame,
    keys: Sequence[str | Column],
    category: str | Column,
    categories: Sequence[tuple[str, str]],
    value: str = "rating",
    ignore_case: bool = False,
) -> DataFrame:
    """Mergeable form of :func:`conditional_stats`: ``<prefix>_sum`` and ``<prefix>_n`` per key."""
    cat = F.col(category) if isinstance(category, str) else category
    if ignore_case:
        cat = F.upper(cat)
    aggs = []
    for cat_value, prefix in categories:
        picked = F.when(cat == F.lit(cat_value.upper() if ignore_case else cat_value), F.col(value))
        aggs += [F.sum(picked).alias(f"{prefix}_sum"), F.count(picked).alias(f"{prefix}_n")]
    return df.groupBy(*keys).agg(*aggs)


def merge_conditional(
    df: DataFrame, keys: Sequence[str | Column], prefixes: Sequence[str], missing_avg: float | None = None
) -> DataFrame:
    """Combines :func:`conditional_sums` rows into ``<prefix>_avg`` and ``<prefix>_n`` per key."""
    aggs = []
    for p in prefixes:
        avg = F.try_divide(F.sum(f"{p}_sum"), F.sum(f"{p}_n"))
        if missing_avg is not None:
            avg = F.coalesce(avg, F.lit(float(missing_avg)))
        aggs += [avg.alias(f"{p}_avg"), F.sum(f"{p}_n").alias(f"{p}_n")]
    return df.groupBy(*keys).agg(*aggs)


def count_non_null(df: DataFrame, keys: Sequence[str | Column], counted: str, name: str) -> DataFrame:
    """Group and count the rows whose ``counted`` column is not NULL.

    This is the counting rule of a bag COUNT: tuples whose first field is
    NULL are not counted, but their group still exists (with 0).
    """
    return df.groupBy(*keys).agg(F.count(F.col(counted)).alias(name))


def count_distinct_ids(df: DataFrame, key: str, ids: str, name: str) -> DataFrame:
    """Number of distinct non-NULL integer ids per key, by exact bitmaps where ids lie densely.

    A task sends one bitmap of 32,768 bits per key and id range instead of
    every (key, id); bitmaps are merged by OR and counted. That pays while a
    bitmap stands for ``DENSE_IDS`` ids or more, which one pass over the two
    columns (range of the ids, number of rows and of keys) tells. Sparse ids,
    and ids that are no integers, are counted by :func:`count_distinct_by`;
    the result is the same.
    """
    if not isinstance(df.schema[ids].dataType, IntegralType):
        return count_distinct_by(df, key, ids, name)
    seen = df.agg(F.min(ids).alias("low"), F.max(ids).alias("high"), F.count(ids).alias("n"), F.approx_count_distinct(key).alias("keys")).first()
    ranges = ((seen["high"] or 0) - (seen["low"] or 0)) // 32_768 + 1
    if seen["n"] < DENSE_IDS * ranges * max(seen["keys"], 1):
        return count_distinct_by(df, key, ids, name)
    place = F.col(ids).cast("bigint")
    bitmaps = df.groupBy(key, F.bitmap_bucket_number(place).alias("__range")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__ids"))
    return bitmaps.groupBy(key).agg(F.sum(F.bitmap_count("__ids")).alias(name))


def count_distinct_by(df: DataFrame, key: str, counted: str, name: str) -> DataFrame:
    """Number of distinct non-NULL ``counted`` values per key (distinct, then count)."""
    return df.groupBy(key).agg(F.count_distinct(F.col(counted)).alias(name))

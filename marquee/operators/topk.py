"""Top-k per group, global top-1, and ranked ordering.

``top_k_per_group`` uses ``row_number`` under a window with ``<= k``; Spark
plans a partial ``WindowGroupLimit`` before the exchange, so each task sends
at most k rows per group into the shuffle even when a group (a topic, a
sentiment) holds a large share of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialized


def top_k_per_group(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column],
    k: int,
    rank_col: str | None = None,
) -> DataFrame:
    """Keep the first ``k`` rows of every group under a total order.

    ``order_cols`` must end in a unique tie-breaker for the result to be
    deterministic.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    window = Window.partitionBy(*group_cols).orderBy(*order_cols)
    tmp = rank_col or "__rank"
    ranked = df.withColumn(tmp, F.row_number().over(window)).where(F.col(tmp) <= k)
    return ranked if rank_col else ranked.drop(tmp)


def top_one(df: DataFrame, order_cols: Sequence[Column]) -> DataFrame:
    """The first row under ``order_cols``; no row when ``df`` is empty.

    Planned as ``TakeOrderedAndProject``: every task keeps its own best row
    and only those meet in the final step.
    """
    return df.orderBy(*order_cols).limit(1)


def with_order_rank(df: DataFrame, order_cols: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """Globally sort and number the rows 1..N in that order.

    ``row_number`` over an un-partitioned window would move every row into a
    single task. Instead the frame is range-partitioned by the sort and
    tagged with ``monotonically_increasing_id`` (partition index in the high
    bits, position in the low bits), then written to the shared scratch
    folder, so partition numbers cannot change between the two uses below. Per-partition row counts (one row per partition) give each
    partition's offset; the rank is offset + position + 1.
    """
    tagged = materialized(df.orderBy(*order_cols).withColumn("__mid", F.monotonically_increasing_id()), "ranked")
    low_bits = (1 << 33) - 1
    tagged = tagged.withColumn("__part", F.shiftright("__mid", 33)).withColumn(
        "__pos", F.col("__mid").bitwiseAND(F.lit(low_bits))
    )
    sizes = tagged.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    offsets = sizes.select(
        "__part",
        F.coalesce(
            F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("__offset"),
    )
    return (
        tagged.join(F.broadcast(offsets), "__part")
        .withColumn(rank_col, F.col("__offset") + F.col("__pos") + F.lit(1))
        .drop("__part", "__pos", "__offset", "__mid")
    )

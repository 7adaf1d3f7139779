"""Connected components of an edge table, by alternating star contractions.

Each round replaces edges by edges to smaller neighbours (large star, then
small star) until every node is joined to the smallest node of its component.
A node may have very many edges: its smallest neighbour is found with map-side
aggregation, and brought back to the edges by a join salted ``SALTS`` ways.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import materialized

SALTS = 16


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges ``u``, ``v`` with ``m``, the smallest of ``u`` and its neighbours."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    # a node is sent to the salts that its edges have, so there are never more rows than edges
    least = salted.groupBy("u").agg(F.min("v").alias("m"), F.collect_set("salt").alias("salts"))
    return salted.join(least.select("u", F.least("u", "m").alias("m"), F.explode("salts").alias("salt")), ["u", "salt"])


def _large_star(edges: DataFrame) -> DataFrame:
    both_ways = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = _with_least(both_ways)
    return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    joined = _with_least(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    ends = F.explode(F.array("u", "v")).alias("u")
    return joined.select(ends, F.col("m").alias("v")).where(F.col("u") != F.col("v"))


def _unsettled(edges: DataFrame) -> DataFrame:
    """Nodes that point to several nodes, or point and are pointed to."""
    out = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    into = edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    ways = out.unionAll(into).groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return ways.where("out > 1 or (out = 1 and into = 1)")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges ``u``, ``v``; the component is its smallest node."""
    now = edges.where(F.col("u") != F.col("v")).select("u", "v").distinct()
    while True:
        large = materialized(_large_star(now).distinct(), "large-star")
        now = materialized(_small_star(large).distinct(), "small-star")
        if _unsettled(now).isEmpty():
            break
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)

"""Bounded training samples of document statistics.

A sample is chosen by a hash of the id (lowest hashes first), so it is the
same on every run and its ids are at most ``bound`` rows: they are broadcast
to one scan of the documents, and only their feature rows reach the driver.
An id that repeats in the documents gives one row, that of its text with the
smallest hash, so no id can push out another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import docstats


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id's text modulo 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def hash_sample(ids: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` distinct non-null ids of ``ids`` (other columns: smallest value), by hash."""
    others = [F.min(c).alias(c) for c in ids.columns if c != "doc_id"]
    distinct = ids.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    distinct = distinct.agg(*others) if others else distinct.agg(F.lit(1).alias("one")).drop("one")
    return distinct.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def text_features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array(list(docstats.stats(texts)[1]), pa.list_(pa.float64()))


def sample_features(docs: DataFrame, sample: DataFrame) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(features, other columns of ``sample``), one row per id of the sample that ``docs`` hold, in an order fixed by the rows."""
    others = [c for c in sample.columns if c != "doc_id"]
    picked = sample.withColumnRenamed("doc_id", "__id")
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("__id"))
    featured = rows.withColumn("x", text_features("text")).select("doc_id", F.xxhash64("text").alias("h"), "x", *others)
    one = featured.groupBy("doc_id").agg(F.min(F.struct("h", "x", *others)).alias("one"))
    found = one.select("doc_id", "one.x", *[f"one.{c}" for c in others]).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    x = np.array(found["x"].to_pylist(), dtype=np.float64).reshape(-1, len(docstats.FEATURES))
    return x, {c: found[c].to_numpy() for c in others}

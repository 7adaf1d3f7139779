"""Join shapes used by the reports.

No broadcast hints: Spark's size statistics
(``spark.sql.autoBroadcastJoinThreshold``) and AQE's runtime sizes decide
between broadcast and shuffle joins, and AQE splits skewed join partitions.
Where a fact key may hold a large share of all rows, ``split_heavy_join``
finds such keys and splits them alone; ``salted_join`` splits every key.
Wide facts of which few have a partner go through ``prefiltered_left_join``.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 16
FILTER_BITS = 1 << 27  # 16 MB: the most that a filter of keys takes when it is broadcast
HEAVY_LIMIT = 1000  # most heavy keys that a sketch reports
HEAVY_TRACKED = 10_000  # keys that a sketch keeps
POSITION = "position"  # order of lines, from a scan with positions


def word_list_frame(spark: SparkSession, words: Sequence[str], column: str = "word") -> DataFrame:
    """A one-column frame from a local word list (duplicates kept).

    Made from Arrow, it is a local relation, so the planner knows its size.
    """
    return spark.createDataFrame(pa.table({column: pa.array(words, pa.string())}))


def last_per_key(dim: DataFrame, key: str, order: str = POSITION) -> DataFrame:
    """``dim`` with one row per key, the last one by ``order``, as a map filled line by line keeps it.

    The order column is dropped. Partial aggregation leaves one row per key
    and task before the exchange, however often a key is repeated.
    """
    others = [c for c in dim.columns if c not in (key, order)]
    last = dim.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("__last"))
    return last.select(key, *[F.col("__last")[c].alias(c) for c in others])


def listed_once(dim: DataFrame, key: str, *fields: str) -> DataFrame:
    """(key, fields) of a dimension: the last line per key if the lines' positions are known, else all of it."""
    if POSITION in dim.columns:
        return last_per_key(dim.select(key, *fields, POSITION), key)
    return dim.select(key, *fields)


def one_per_key(dim: DataFrame, key: str, value: str) -> DataFrame:
    """``dim`` as (key, value) with one row per key: that of the last line, if
    the lines' positions are known, else the largest value in text order."""
    if POSITION in dim.columns:
        return listed_once(dim, key, value)
    return dim.groupBy(key).agg(F.max(value).alias(value))


def lookup_with_fallback(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    value: str,
    out: str | None = None,
) -> DataFrame:
    """Left lookup of ``dim.value`` by ``key``; a missing entry falls back to the key.

    A key listed more than once is looked up as in :func:`one_per_key`, so
    ``facts`` never multiply.
    """
    out = out or value
    d = one_per_key(dim, key, value).select(F.col(key), F.col(value).alias("__lookup"))
    return (
        facts.join(d, key, "left")
        .withColumn(out, F.coalesce(F.col("__lookup"), F.col(key).cast("string")))
        .drop("__lookup")
    )


def salted_join(facts: DataFrame, dim: DataFrame, key: str, salt_by: str | Column, salts: int = SALTS) -> DataFrame:
    """Inner join in which every fact key is dealt over ``salts`` join partitions.

    The rows of one key are split by a hash of ``salt_by``; the dimension is
    repeated once per salt. A key with a third of all facts then fills
    ``salts`` tasks instead of one.
    """
    spread_by = F.col(salt_by) if isinstance(salt_by, str) else salt_by
    left = facts.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    right = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "__salt"]).drop("__salt")


def heavy_keys(facts: DataFrame, key: str, limit: int = HEAVY_LIMIT, tracked: int = HEAVY_TRACKED) -> list:
    """Keys that hold more rows than an average join partition, at most ``limit`` of them.

    One pass with a frequent-items sketch of fixed size (``tracked`` keys per
    task and merge), whatever the number of keys. A key above that share is in
    the sketch unless more than ``tracked`` are; a miss costs balance only.
    """
    spark = facts.sparkSession
    found = facts.select(key).agg(F.count(key).alias("n"), F.expr(f"approx_top_k(`{key}`, {limit}, {tracked})").alias("top")).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return [t["item"] for t in found["top"] or [] if t["item"] is not None and t["count"] * partitions > found["n"]]


def repeat_heavy(dim: DataFrame, key: str, heavy: list, salts: int = SALTS) -> DataFrame:
    """``dim`` with a ``__salt``: rows of heavy keys once per salt, all others once."""
    numbers = F.when(F.col(key).isin(heavy), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return dim.withColumn("__salt", F.explode(numbers))


def split_heavy_join(facts: DataFrame, dim: DataFrame, key: str, salt_by: str | Column, salts: int = SALTS) -> DataFrame:
    """Inner join in which only the keys that would fill a task are dealt over ``salts`` partitions.

    A dimension that the planner is going to broadcast needs none of this:
    nothing is dealt out by key then. Beyond that size, a sketch of the facts'
    keys names the heavy ones; their dimension rows are repeated per salt, and
    all other rows of both sides are shuffled once.
    """
    heavy = [] if _will_broadcast(dim) else heavy_keys(facts, key)
    if not heavy:
        return facts.join(dim, key)
    spread_by = F.col(salt_by) if isinstance(salt_by, str) else salt_by
    salt = F.when(F.col(key).isin(heavy), F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    return facts.withColumn("__salt", salt).join(repeat_heavy(dim, key, heavy, salts), [key, "__salt"]).drop("__salt")


def _will_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size estimate is under the broadcast threshold."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= threshold


def key_bits(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """A Bloom filter (one hash) of the non-NULL keys as rows (__bucket, __bits) of 32,768 bits.

    Its size is bounded by ``bits`` whatever the number of keys, so it may be
    broadcast; with more keys it lets more through. Built by partial
    aggregation: a task sends its bitmaps, not its keys.
    """
    place = _filter_place(key, bits)
    hashed = keys.where(F.col(key).isNotNull()).select(F.bitmap_bucket_number(place).alias("__bucket"), F.bitmap_bit_position(place).alias("__at"))
    return hashed.groupBy("__bucket").agg(F.bitmap_construct_agg("__at").alias("__bits"))


def _filter_place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def may_match(facts: DataFrame, keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``facts`` whose key may be among ``keys``: all that are, and few others."""
    return _with_maybe(facts, keys, key, bits).where("__maybe").drop("__maybe")


def _with_maybe(facts: DataFrame, keys: DataFrame, key: str, bits: int) -> DataFrame:
    """``facts`` with ``__maybe``: whether the key may be among ``keys``; false is certain."""
    place = _filter_place(key, bits)
    found = facts.withColumn("__bucket", F.bitmap_bucket_number(place)).join(F.broadcast(key_bits(keys, key, bits)), "__bucket", "left")
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, (at % 8).cast("int")) == 1
    return found.withColumn("__maybe", F.coalesce(bit & F.col(key).isNotNull(), F.lit(False))).drop("__bucket", "__bits")


def prefiltered_left_join(facts: DataFrame, dim: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """Left outer join of wide facts with a dimension that holds few of their keys.

    Only facts whose key passes a Bloom filter of the dimension's keys are
    shuffled to meet it; all others get NULLs where they are read, at the cost
    of a second scan. A condition that needs a dimension column drops that
    second branch. A dimension that the planner will broadcast is joined
    plainly: no fact is shuffled then.
    """
    if _will_broadcast(dim):
        return facts.join(dim, key, "left")
    marked = _with_maybe(facts, dim.select(key), key, bits)
    met = may_match(facts, dim.select(key), key, bits).join(dim, key, "left")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema.fields if f.name != key]
    others = marked.where(~F.col("__maybe")).drop("__maybe")
    return met.unionByName(others.select(*others.columns, *missing))


def anti_join(df: DataFrame, exclude: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` value is not in ``exclude``.

    Written as ``left_anti``: Catalyst does not turn a left outer join plus
    ``IS NULL`` into an anti join. A NULL key never matches, so it is kept;
    duplicates in ``exclude`` do not duplicate output.
    """
    return df.join(exclude.select(on), on, "left_anti")


def left_outer(df: DataFrame, other: DataFrame, on: str, other_alias: str) -> DataFrame:
    """Left outer join keeping both key columns (the right one renamed)."""
    right = other.select(F.col(on).alias(other_alias))
    return df.join(right, df[on] == right[other_alias], "left")

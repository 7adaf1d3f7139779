"""Sharding over fixed virtual slots, with a versioned slot-to-shard map.

Every record is hashed into one of ``n_slots`` virtual slots, for good. Which
shard holds a slot is said by a map of ``n_slots`` rows, kept as one parquet
folder per version. Balancing measures bytes and rows per slot and *edits* the
map: slots move, records are never rehashed. All of it is DataFrame work.

An id (null included) that repeats until it holds more than an eighth of a
shard's equal share is hot: one slot would then outweigh what a map can even
out. The records of a hot id are dealt by their id, size and text checksum,
and equal ones round robin from that slot on. At most ``HOT_PARTS * n_shards``
ids can be hot; they are found by counting the records of overfull slots only.

Defined cases:

* null key: hashed as the empty string; null text: no bytes, size 1;
* repeated rows: in one slot unless their id is hot, each counted and numbered on its own;
* a very long text counts with all its bytes; slots of equal size are placed
  in order of their number;
* empty table: every slot keeps its shard, no rows come out;
* an input column named like an output column is replaced by the output.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.session import materialized, scratch_path

N_SLOTS = 4096
MAX_SLOTS = 65536  # the map is broadcast: at most this many rows of 40 bytes
HOT_PARTS = 8  # a hot id holds more than one of this many parts of a shard's share
COPY_BLOCK = 1 << 16  # equal records of a hot id numbered by one row


def slot_of(key: Column, n_slots: int = N_SLOTS) -> Column:
    """Virtual slot of a record: the first 32 bits of the key's MD5, modulo ``n_slots``."""
    head = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(n_slots)).cast("int")


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text, plus one for the record itself."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + F.lit(1)


def slim_records(docs: DataFrame, n_slots: int = N_SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, vslot): what placing needs of a document, written once, so that texts are read once."""
    records = docs.select(
        F.col(key).alias("key"),
        record_size(F.col(text)).alias("size"),
        F.crc32(F.col(text).cast("binary")).alias("text_crc32"),
        slot_of(F.col(key), n_slots).alias("vslot"),
    )
    return materialized(records, "records")


def hot_keys(records: DataFrame, n_shards: int) -> DataFrame:
    """(hot_key, hot): the repeated keys beyond one part of a shard's share; fewer than ``HOT_PARTS * n_shards`` rows."""
    total = F.sum("bytes").over(Window.partitionBy(F.lit(0)))  # over at most ``n_slots`` loads
    beyond = f"n_rows > 1 and bytes * {HOT_PARTS * n_shards} > total"
    overfull = slot_loads(records).withColumn("total", total).where(beyond).select("vslot", "total")
    by_key = records.join(F.broadcast(overfull), "vslot").groupBy("key")
    counted = by_key.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"), F.max("total").alias("total"))
    return materialized(counted.where(beyond).select(F.col("key").alias("hot_key"), F.lit(True).alias("hot")), "hot-keys")


def dealt_slot(key: Column, size: Column, checksum: Column, copy: Column, n_slots: int) -> Column:
    """Virtual slot of one of several equal records of a hot key."""
    return F.pmod(slot_of(F.concat_ws("/", key, size, checksum), n_slots) + copy, F.lit(n_slots)).cast("int")


def spread_hot(records: DataFrame, hot: DataFrame, n_slots: int) -> DataFrame:
    """``records`` with those of hot keys dealt over the slots.

    Equal records are interchangeable, so they are counted and numbered from
    their count, in blocks; no task holds all records of a key.
    """
    if hot.isEmpty():
        return records
    marked = records.join(F.broadcast(hot), F.col("key").eqNullSafe(F.col("hot_key")), "left")
    same = ["key", "size", "text_crc32"]
    counted = marked.where("hot").groupBy(*same).agg(F.count(F.lit(1)).alias("n"))
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = counted.withColumn("block", F.expr(f"explode(sequence(0, (n - 1) div {COPY_BLOCK}))")).repartition(parts, *same, "block")
    last = f"least(n, (block + 1) * {COPY_BLOCK}) - 1"
    copies = blocks.withColumn("copy", F.expr(f"explode(sequence(block * {COPY_BLOCK}, {last}))"))
    slot = dealt_slot(F.col("key"), F.col("size"), F.col("text_crc32"), F.col("copy"), n_slots)
    return marked.where("hot is null").select(*same, "vslot").unionByName(copies.select(*same, slot.alias("vslot")))


def initial_map(spark: SparkSession, n_shards: int, n_slots: int = N_SLOTS) -> DataFrame:
    """Slots dealt round robin: (vslot, shard)."""
    if not 0 < n_slots <= MAX_SLOTS:
        raise ValueError(f"n_slots must be between 1 and {MAX_SLOTS}")
    return spark.range(n_slots, numPartitions=1).select(
        F.col("id").cast("int").alias("vslot"), F.pmod("id", F.lit(n_shards)).cast("int").alias("shard")
    )


def slot_loads(records: DataFrame) -> DataFrame:
    """(vslot, bytes, n_rows) of records that carry ``vslot`` and ``size``."""
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))


def _loaded(slot_map: DataFrame, loads: DataFrame) -> DataFrame:
    return slot_map.select("vslot", "shard").join(loads, "vslot", "left").fillna(0, ["bytes", "n_rows"])


def _over(loaded: DataFrame, n_shards: int) -> DataFrame:
    """Adds ``fits``: whether the slot, largest first, is within an equal share of all bytes.

    The windows are over the map's fixed number of slots, never over records.
    """
    before = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot")
    total = Window.partitionBy(F.lit(0))
    return loaded.withColumn("fits", F.sum("bytes").over(before) * n_shards <= F.sum("bytes").over(total))


def rebalance(slot_map: DataFrame, loads: DataFrame, n_shards: int) -> DataFrame:
    """The map with the slots beyond a shard's equal share moved to the least loaded shards.

    Slots that fit stay where they are. The others are taken largest first,
    each to the shard with the fewest bytes so far (lowest number on a tie).
    This is a fold over at most ``n_slots`` structs.
    """
    marked = _over(_loaded(slot_map, loads), n_shards)
    pool = F.array_sort(F.collect_list(F.when(~F.col("fits"), F.struct((-F.col("bytes")).alias("less"), "vslot"))))
    kept = F.collect_list(F.when(F.col("fits"), F.struct("shard", "bytes")))
    zero = F.lit(0).cast("bigint")
    loads_now = F.transform(
        F.sequence(F.lit(0), F.lit(n_shards - 1)),
        lambda s: F.aggregate("kept", zero, lambda acc, k: acc + F.when(k["shard"] == s, k["bytes"]).otherwise(zero)),
    )
    state = F.struct(
        F.col("start").alias("loads"),
        F.expr("cast(array() as array<struct<vslot:int,shard:int>>)").alias("moves"),
    )

    def place(acc: Column, item: Column) -> Column:
        least = F.array_position(acc["loads"], F.array_min(acc["loads"])).cast("int") - 1
        return F.struct(
            F.transform(acc["loads"], lambda v, i: F.when(i == least, v - item["less"]).otherwise(v)).alias("loads"),
            F.concat(acc["moves"], F.array(F.struct(item["vslot"].alias("vslot"), least.alias("shard")))).alias("moves"),
        )

    moved = (
        marked.agg(pool.alias("pool"), kept.alias("kept"))
        .withColumn("start", loads_now)
        .select(F.explode(F.aggregate("pool", state, place)["moves"]).alias("m"))
        .select("m.vslot", F.col("m.shard").alias("to"))
    )
    return slot_map.join(F.broadcast(moved), "vslot", "left").select(
        "vslot", F.coalesce("to", "shard").alias("shard")
    )


def add_shard(slot_map: DataFrame, loads: DataFrame, n_shards: int) -> DataFrame:
    """The map for ``n_shards + 1`` shards; slots move only into the new shard ``n_shards``."""
    marked = _over(_loaded(slot_map, loads), n_shards + 1)
    return marked.select("vslot", F.when(F.col("fits"), F.col("shard")).otherwise(F.lit(n_shards)).alias("shard"))


def write_map(slot_map: DataFrame, folder: str, version: int) -> DataFrame:
    """Stores one version of the map and returns it as read back."""
    slot_map.coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, f"version={version}"))
    return read_map(slot_map.sparkSession, folder, version)


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"version={version}"))


def balanced_map(records: DataFrame, n_shards: int, n_slots: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """Writes version 0 (round robin) and version 1 (edited by bytes); (version 1, loads)."""
    spark = records.sparkSession
    first = write_map(initial_map(spark, n_shards, n_slots), folder, 0)
    loads_path = os.path.join(folder, "loads")
    slot_loads(records).coalesce(1).write.mode("overwrite").parquet(loads_path)
    loads = spark.read.parquet(loads_path)
    return write_map(rebalance(first, loads, n_shards), folder, 1), loads


def assign_shards(
    docs: DataFrame, n_shards: int, n_slots: int = N_SLOTS, key: str = "doc_id", text: str = "text", folder: str | None = None
) -> DataFrame:
    """``docs`` with ``vslot`` and ``shard``, balanced by bytes. The documents themselves are not shuffled.

    Rows of a hot key take a slot by their place in the input, all others by their key. The loads are
    measured on the same slots; over an input that doesn't come in stable partitions, hot rows are near them.
    """
    folder = folder or scratch_path(docs.sparkSession, "slot-map")
    records = slim_records(docs, n_slots, key, text)
    hot = hot_keys(records, n_shards)
    vslot = slot_of(F.col(key), n_slots)
    marked, measured = docs, records
    if not hot.isEmpty():
        named = F.broadcast(hot.select(F.col("hot_key").alias("__key"), F.col("hot").alias("__hot")))
        copy = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_slots))
        dealt = dealt_slot(F.col(key), record_size(F.col(text)), F.crc32(F.col(text).cast("binary")), copy, n_slots)
        marked = docs.join(named, F.col(key).eqNullSafe(F.col("__key")), "left")
        vslot = F.when(F.col("__hot"), dealt).otherwise(vslot)
        measured = marked.select(vslot.alias("vslot"), record_size(F.col(text)).alias("size"))
    current, _ = balanced_map(measured, n_shards, n_slots, folder)
    placed = F.broadcast(current.withColumnRenamed("vslot", "__vslot").withColumnRenamed("shard", "__shard"))
    kept = [c for c in docs.columns if c.lower() not in ("vslot", "shard")]
    return (
        marked.withColumn("__vslot", vslot)
        .join(placed, "__vslot")
        .select(*kept, F.col("__vslot").alias("vslot"), F.col("__shard").alias("shard"))
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard; every task writes its own file for each shard it has rows of."""
    assigned.write.mode("overwrite").partitionBy("shard").parquet(path)


def place_in_shards(records: DataFrame, slot_map: DataFrame, loads: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``shard`` and ``slot``, the row's gapless place in its shard.

    Rows are numbered inside their virtual slot; the rows of the shard's
    earlier virtual slots, known from the loads, are added.
    """
    earlier = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _loaded(slot_map, loads).select(
        "vslot", "shard", F.coalesce(F.sum("n_rows").over(earlier), F.lit(0).cast("bigint")).alias("before")
    )
    inside = Window.partitionBy("vslot").orderBy(*order)
    return (
        records.withColumn("place", F.row_number().over(inside))
        .join(F.broadcast(offsets), "vslot")
        .withColumn("slot", F.col("before") + F.col("place").cast("bigint") - 1)
        .drop("before", "place")
    )


def shard_report(docs: DataFrame, n_shards: int = 16, n_slots: int = N_SLOTS) -> DataFrame:
    """The shard of every document under the law ``bytes``: shards hold near equal bytes."""
    records = slim_records(docs, n_slots)
    spread = spread_hot(records, hot_keys(records, n_shards), n_slots)
    current, loads = balanced_map(spread, n_shards, n_slots, scratch_path(docs.sparkSession, "slot-map"))
    return place_in_shards(spread, current, loads, ["key", "text_crc32", "size"]).select(
        F.col("key").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
    )

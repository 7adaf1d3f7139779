"""Near-duplicate documents by MinHash bands, verified through odd sketches.

A document's set holds its distinct ``SHINGLE``-word shingles. What counts as
similar is a parameter (``Similar``): ``SIMILAR``, 0.85, is op8's contract;
``STAGE_SIMILAR``, 0.8, is the pipeline's rule. MinHash samples (one minimum
per hash function) give the band keys. The odd
sketch folds the bottom MinHash samples (the ``SKETCH_SAMPLES`` smallest
hashes, the whole set if it is smaller) into a parity bitmap: every sample
toggles one bit, so the XOR of two sketches holds the samples in which two
documents differ, and its population count never exceeds their number. For
sets of up to ``SKETCH_SAMPLES`` shingles no similar pair can fail the test,
and nearly no other passes; beyond, the limit allows for six deviations.

1. Documents with equal sets become one class, represented by its smallest id.
2. Representatives that share a band key are candidates. In every bucket they
   are first compared with one leader only; of a document's leaders that pass
   the sketch test, the best is verified on the full sets.
3. Where a bucket still holds more than one component, the documents outside
   its largest component are compared, by sketch, with the documents of other
   components; passing pairs are verified, best first, until every pair is
   verified or lies within one component. No group is ever expanded into all
   its pairs, and no similar pair is dropped.
   Before that, shingles that only one component has are counted. They are in
   no link still to be found, so they bound the size of a partner
   (``_with_reach``): documents that no partner can reach leave the buckets,
   and those that could only link to a smaller one aren't compared with each
   other. So a family that shares boilerplate but differs in its own words
   costs no pairs.
4. Components of the verified links; the smallest id names a component.

With 32 bands of 6 rows, a pair of similarity 0.85 shares no band with
probability 3e-7, and a higher one less; with 38 bands of 5 rows that holds
from 0.8 on.

Defined cases:

* null or wordless text: an empty set, linked with nothing;
* fewer words than a shingle: the whole sequence is the one shingle;
* null id: never linked, component null, kept;
* rows that repeat an id are one document: all kept or all dropped;
* a very long text has all its shingles in its set; of equally good documents
  the one with the smallest id stays;
* extra columns aren't read, and ``drop_near_copies`` keeps them;
* empty table: no rows.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import words as W
from marquee.llm.components import components
from marquee.session import materialized

SHINGLE = 5


class Similar(NamedTuple):
    """Least similarity ``high / of`` of a link, and the bands and rows that find it."""

    high: int
    of: int
    bands: int
    rows: int


SIMILAR = Similar(85, 100, 32, 6)
STAGE_SIMILAR = Similar(80, 100, 38, 5)
SAMPLES = 192  # most bands times rows
SKETCH_SAMPLES = 1024
SKETCH_BITS = 2048
SKETCH_WORDS = SKETCH_BITS // 64
STAR_ROUNDS = 2  # rounds against one leader per bucket

_rng = np.random.default_rng(20240501)
_MULTIPLY = _rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)


def max_differing(n_a: Column, n_b: Column, similar: Similar = SIMILAR) -> Column:
    """Most samples in which two similar sets of these sizes may differ.

    Exact while both sets are sampled whole. Otherwise the shared samples are
    a draw of ``SKETCH_SAMPLES`` from the larger set; six deviations are allowed.
    """
    high, of = similar.high, similar.of
    k = F.lit(SKETCH_SAMPLES)
    most = F.greatest(n_a, n_b)
    whole = F.floor((n_a + n_b) * (of - high) / (of + high))
    share = F.least((n_a + n_b) * high / (of + high) / most, F.lit(1.0))
    common = k * share - 6 * F.sqrt(k * share * (1 - share))
    return F.when(most <= k, whole).otherwise(F.ceil(F.least(n_a, k) + F.least(n_b, k) - 2 * common))


def _distinct_shingles(chunk: W.Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each text's distinct shingles, in row order."""
    hashes = chunk.hashes()
    at, found = chunk.windows(hashes, n)
    row = chunk.row[at]
    lengths = np.diff(chunk.first_word)
    for k in range(1, n):
        short = np.flatnonzero(lengths == k)
        row = np.concatenate((row, short))
        found = np.concatenate((found, W.combine(hashes, chunk.first_word[short], k)))
    first, _ = W.repeats(row, found)
    row, found = row[first], found[first]
    order = np.argsort(row, kind="stable")
    return row[order], found[order]


def _band_keys(shingles: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The band keys of the sets that start at ``starts``, one row per set."""
    least = np.empty((bands * rows, len(starts)), np.uint64)
    for k in range(bands * rows):
        np.minimum.reduceat(shingles * _MULTIPLY[k] + _ADD[k], starts, out=least[k])
    keys = np.empty((bands, len(starts)), np.uint64)
    for b in range(bands):
        band = least[b * rows : (b + 1) * rows]
        keys[b] = W.mix(band[0]) ^ np.uint64(b)
        for k in range(1, rows):
            keys[b] = W.mix(keys[b] * _MULTIPLY[k] + band[k])
    return keys.T.view(np.int64)


def _odd_sketches(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the bottom samples, as 64-bit words, one row per set."""
    sizes = np.diff(np.concatenate((starts, [len(shingles)])))
    sampled = np.ones(len(shingles), dtype=bool)
    for lo, size in zip(starts[sizes > SKETCH_SAMPLES], sizes[sizes > SKETCH_SAMPLES], strict=True):
        order = np.argpartition(shingles[lo : lo + size], SKETCH_SAMPLES)
        sampled[lo + order[SKETCH_SAMPLES:]] = False
    place = np.repeat(np.arange(len(starts)), sizes) * SKETCH_BITS + (W.mix(shingles) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(place[sampled], minlength=len(starts) * SKETCH_BITS).astype(np.uint8) & 1
    return np.packbits(odd.reshape(-1, SKETCH_BITS), axis=1, bitorder="little").view("<i8")


_SIGNATURE = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("set_a", T.LongType()),
        T.StructField("set_b", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.ArrayType(T.LongType())),
    ]
)


def _lists(rows: np.ndarray, of: np.ndarray, n: int, width: int) -> pa.Array:
    """A list of ``width`` values for each row in ``of``; empty lists elsewhere."""
    sizes = np.zeros(n + 1, np.int32)
    sizes[of + 1] = width
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(rows.ravel()))


def signature(bands: int, rows: int) -> Callable[[str], Column]:
    """Set size, two 64-bit sums that identify the set, band keys and odd sketch."""

    @F.arrow_udf(_SIGNATURE)
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            n = np.zeros(len(texts), np.int64)
            ids = np.zeros((2, len(texts)), np.uint64)
            of, keys, sketches = [], [], []
            for chunk in W.chunks(texts, W.not_space(), W.lower_ascii()):
                row, found = _distinct_shingles(chunk, SHINGLE)
                if not len(row):
                    continue
                starts = np.flatnonzero(np.concatenate(([True], np.diff(row) > 0)))
                at = chunk.first_row + row[starts]
                n[at] = np.diff(np.concatenate((starts, [len(row)])))
                ids[0, at] = np.add.reduceat(W.mix(found), starts)
                ids[1, at] = np.add.reduceat(W.mix(found ^ _ADD[0]), starts)
                of.append(at)
                keys.append(_band_keys(found, starts, bands, rows))
                sketches.append(_odd_sketches(found, starts))
            at = np.concatenate(of) if of else np.zeros(0, np.int64)
            empty = np.zeros(0, np.int64)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(n),
                    pa.array(ids[0].view(np.int64)),
                    pa.array(ids[1].view(np.int64)),
                    _lists(np.concatenate(keys) if keys else empty, at, len(texts), bands),
                    _lists(np.concatenate(sketches) if sketches else empty, at, len(texts), SKETCH_WORDS),
                ],
                fields=[pa.field(f.name, t) for f, t in zip(_SIGNATURE.fields, _ARROW, strict=True)],
            )

    return signed


_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]


@F.arrow_udf(T.ArrayType(T.LongType()))
def shingle_set(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The full set as shingle hashes."""
    for texts in batches:
        sizes, found = np.zeros(len(texts) + 1, np.int32), []
        for chunk in W.chunks(texts, W.not_space(), W.lower_ascii()):
            row, hashes = _distinct_shingles(chunk, SHINGLE)
            sizes[chunk.first_row + 1 : chunk.first_row + chunk.n_rows + 1] = np.bincount(row, minlength=chunk.n_rows)
            found.append(hashes.view(np.int64))
        values = np.concatenate(found) if found else np.zeros(0, np.int64)
        yield pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(values))


def _differing(a: str, b: str) -> Column:
    """Population count of the XOR of two sketches held as columns."""
    total = F.lit(0)
    for k in range(SKETCH_WORDS):
        total = total + F.bit_count(F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}")))
    return total


def _spread(prefix: str) -> list[Column]:
    return [F.col("sketch")[k].alias(f"{prefix}{k}") for k in range(SKETCH_WORDS)]


def _sizes_allow(a: str, b: str, similar: Similar) -> Column:
    return F.least(a, b) * similar.of >= F.greatest(a, b) * similar.high


def _verified(pairs: DataFrame, sets: DataFrame, similar: Similar) -> DataFrame:
    """The pairs ``a``, ``b`` that are similar on their full sets, as edges ``u``, ``v``."""
    high, of = similar.high, similar.of
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_of_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_of_b"))
    both = F.size(F.array_intersect("set_of_a", "set_of_b"))
    return (
        pairs.select("a", "b")
        .join(left, "a")
        .join(right, "b")
        .select("a", "b", both.alias("both"), (F.size("set_of_a") + F.size("set_of_b")).alias("total"))
        .where(of * F.col("both") >= high * (F.col("total") - F.col("both")))
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )


def _grouped(found: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` (key, rep) with each representative's component."""
    named = found.select(F.col("node").alias("rep"), "component")
    return members.select("key", "rep").join(named, "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("comp"))


def _open_buckets(grouped: DataFrame, seed: int) -> DataFrame:
    """(key, main, leader) of buckets with several components: a largest one, and one of its documents, drawn by hash."""
    drawn = F.min(F.struct(F.xxhash64("rep", F.lit(seed)).alias("h"), "rep")).alias("drawn")
    counts = grouped.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), drawn)
    most = F.max(F.struct("n", (-F.col("comp")).alias("less"), "drawn")).alias("most")
    mains = counts.groupBy("key").agg(most, F.count(F.lit(1)).alias("comps")).where("comps > 1")
    return materialized(mains.select("key", (-F.col("most.less")).alias("main"), F.col("most.drawn.rep").alias("leader")), "open-buckets")


def _best_leaders(pairs: DataFrame, reps: DataFrame, similar: Similar) -> DataFrame:
    """Of every document's leaders that pass the sketch test, the best one."""
    mine = reps.select("rep", "n", *_spread("x"))
    theirs = reps.select(F.col("rep").alias("leader"), F.col("n").alias("n_leader"), *_spread("y"))
    near = (
        pairs.select("rep", "leader")
        .distinct()
        .join(mine, "rep")
        .join(theirs, "leader")
        .select("rep", "leader", "n", "n_leader", _differing("x", "y").alias("bits"))
        .where((F.col("bits") <= max_differing(F.col("n"), F.col("n_leader"), similar)) & _sizes_allow("n", "n_leader", similar))
    )
    return near.groupBy("rep").agg(F.min(F.struct("bits", "leader")).alias("best")).select(
        F.col("rep").alias("a"), F.col("best.leader").alias("b")
    )


def _with_reach(opened: DataFrame, reps: DataFrame, sets: DataFrame, similar: Similar) -> DataFrame:
    """``opened`` with ``n`` and ``reach``, the most shingles a partner of another component can have.

    Of a document's ``n`` shingles, ``m`` occur in other components too. A
    partner of ``k`` shingles shares at most ``m``, and a link needs at least
    ``high * (n + k) / (of + high)`` shared ones, which bounds ``k``. Documents
    whose bound is below ``high * n / of``, the least size of a partner, are
    left out.
    """
    docs = materialized(opened.select("rep", "comp").distinct(), "open-documents")
    held = docs.join(sets, "rep").select("rep", "comp", F.explode("shingles").alias("s"))
    own = held.groupBy("s").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo = hi").select("s")
    n_own = held.join(own, "s", "left_semi").groupBy("rep").agg(F.count(F.lit(1)).alias("n_own"))
    high, of = similar.high, similar.of
    m = F.col("n") - F.coalesce("n_own", F.lit(0))
    reach = F.floor(m * (of + high) / high) - F.col("n")
    bounded = reps.select("rep", "n").join(docs.select("rep"), "rep").join(n_own, "rep", "left").select("rep", "n", reach.alias("reach"))
    near = materialized(bounded.where(F.col("reach") * of >= F.col("n") * high), "reach")
    return opened.join(near, "rep")


def _compared(reached: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Parts (outside, others) that hold every pair to compare; ``later`` marks others that are outside too.

    Of two documents that each reach smaller partners only, neither reaches the other.
    """
    in_main, down = F.col("comp") == F.col("main"), F.col("reach") < F.col("n")
    others = reached.withColumn("later", ~in_main & ~down)
    return [(reached.where(~in_main & ~down), others), (reached.where(~in_main & down), others.where(in_main & ~down))]


def _cross_pairs(opened: DataFrame, reps: DataFrame, sets: DataFrame, similar: Similar) -> DataFrame:
    """Distinct pairs of different components that share a bucket and pass the sketch test: (a, b, bits).

    One side of a pair always lies outside the bucket's main component, and
    the sketch test is part of the join's condition.
    """
    sketches = reps.select("rep", "sketch")
    differ = _differing("x", "y")
    found = []
    for outside, others in _compared(_with_reach(opened, reps, sets, similar)):
        left = outside.join(sketches, "rep").select(
            "key",
            F.col("rep").alias("a"),
            F.col("comp").alias("comp_a"),
            F.col("n").alias("n_a"),
            F.col("reach").alias("reach_a"),
            *_spread("x"),
        )
        right = others.join(sketches, "rep").select(
            F.col("key").alias("key_b"),
            F.col("rep").alias("b"),
            F.col("comp").alias("comp_b"),
            F.col("n").alias("n_b"),
            F.col("reach").alias("reach_b"),
            "later",
            *_spread("y"),
        )
        pairs = left.join(
            right,
            (F.col("key") == F.col("key_b"))
            & (F.col("comp_a") != F.col("comp_b"))
            & (~F.col("later") | (F.col("comp_a") < F.col("comp_b")))
            & (F.col("n_b") <= F.col("reach_a"))
            & (F.col("n_a") <= F.col("reach_b"))
            & _sizes_allow("n_a", "n_b", similar)
            & (differ <= max_differing(F.col("n_a"), F.col("n_b"), similar)),
        )
        found.append(pairs.select("a", "b", differ.alias("bits")))
    return found[0].unionAll(found[1]).groupBy("a", "b").agg(F.min("bits").alias("bits"))


def _extended(links: DataFrame, found: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links and components with ``more`` links, which are often none: then nothing is contracted again."""
    more = materialized(more, "links")
    if more.isEmpty():
        return links, found
    links = links.unionAll(more)
    return links, components(links)


def _linked(members: DataFrame, reps: DataFrame, sets: DataFrame, similar: Similar) -> DataFrame:
    """(node, component) of everything that verified links connect.

    ``members`` are (key, rep, leader), the leader being a bucket's smallest id.
    """
    first = _best_leaders(members.where("rep != leader"), reps, similar)
    links = materialized(_verified(first, sets, similar), "links")
    found = components(links)
    for seed in range(1, STAR_ROUNDS + 1):
        grouped = _grouped(found, members)
        open_buckets = _open_buckets(grouped, seed)
        if open_buckets.isEmpty():
            return found
        opened = grouped.join(open_buckets, "key")
        if seed == STAR_ROUNDS:
            break
        again = _best_leaders(opened.where("comp != main"), reps, similar)
        links, found = _extended(links, found, _verified(again, sets, similar))

    best_first = Window.partitionBy("a").orderBy("bits", "b")
    pairs = materialized(_cross_pairs(opened, reps, sets, similar), "cross-pairs")
    take = 1
    while not pairs.isEmpty():
        ranked = materialized(pairs.withColumn("place", F.row_number().over(best_first)), "ranked-pairs")
        links, found = _extended(links, found, _verified(ranked.where(F.col("place") <= take), sets, similar))
        of_a = found.select(F.col("node").alias("a"), F.col("component").alias("in_a"))
        of_b = found.select(F.col("node").alias("b"), F.col("component").alias("in_b"))
        left = ranked.where(F.col("place") > take).join(of_a, "a", "left").join(of_b, "b", "left")
        apart = F.coalesce("in_a", "a") != F.coalesce("in_b", "b")
        pairs = materialized(left.where(apart).select("a", "b", "bits"), "cross-pairs")
        take *= 4
    return found


def near_duplicates(docs: DataFrame, similar: Similar = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    slim = docs.select("doc_id", "text")
    signed = slim.withColumn("s", signature(similar.bands, similar.rows)("text")).select("doc_id", "s.*")
    signed = materialized(signed, "signatures")
    linkable = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull())

    same_set = ["set_a", "set_b", "n"]
    reps = linkable.groupBy(*same_set).agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies")
    )
    reps = materialized(reps, "representatives")

    bucketed = reps.select("rep", F.explode("bands").alias("key"))
    shared = bucketed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("leader")).where("n > 1")
    members = materialized(bucketed.join(materialized(shared.drop("n"), "shared-keys"), "key"), "members")

    candidates = members.select(F.col("rep")).distinct()
    found = slim.join(candidates, F.col("doc_id") == F.col("rep")).select("rep", shingle_set("text").alias("shingles"))
    sets = materialized(found, "sets")

    found = _linked(members, reps, sets, similar).withColumnRenamed("node", "rep")
    classes = reps.join(found, "rep", "left").where("copies > 1 or component is not null")
    classes = classes.select(
        F.col("set_a").alias("a"), F.col("set_b").alias("b"), F.col("n").alias("c"), F.coalesce("component", "rep").alias("component")
    )
    classes = materialized(classes, "classes")
    named = signed.select("doc_id", *same_set).join(
        classes, (F.col("set_a") == F.col("a")) & (F.col("set_b") == F.col("b")) & (F.col("n") == F.col("c")), "left"
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return named.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def drop_near_copies(docs: DataFrame, similar: Similar = SIMILAR) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id."""
    dropped = near_duplicates(docs, similar).where(~F.col("kept")).select(F.col("doc_id").alias("__dropped")).distinct()
    dropped = materialized(dropped, "ids")
    return docs.join(dropped, F.col("doc_id") == F.col("__dropped"), "left_anti")

"""Benchmark decontamination: a broadcast hash set of test windows against all training windows.

Benchmark texts become windows of ``WINDOW`` consecutive normalised words (a
shorter text is one window of its own length). The window hashes are
broadcast; every window of every document is hashed and looked up, and each
hit is verified against the window's words themselves. Hits mark words;
documents or just the hit spans can then be removed.

The broadcast is bounded: windows are dealt by hash, with their item, into
blocks of about ``BLOCK_BYTES``; the items of a hot window lie in many blocks. A benchmark of usual size is one block and one
narrow step, no shuffle. Of a larger one, every block but the last is a pass of
its own over the texts that writes the hits alone, by text; the last pass takes
the earlier hits with it through a join on the text's digest. At any number of
blocks a task has one Python worker that holds one block, and so has the driver.

Defined cases:

* null or wordless document: no words, not contaminated;
* null or wordless item: no window; an item without id marks words, but isn't named;
* repeated items: one window with several ids; repeated documents: each judged;
* a very long text is a chunk of its own, judged whole; there are no ties, a
  word is hit or not;
* extra columns of any name pass through (rows travel as one struct);
* empty benchmark: no hits; empty table: no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import words as W
from marquee.session import materialized

WINDOW = 10
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
BLOCK_BYTES = 64 << 20
FILTER_BITS = 20


def normal_words(text: Column) -> Column:
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.regexp_extract_all(F.translate(text, upper, upper.lower()), F.lit(WORD), 1)


def windows(bench: DataFrame, n: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(window, item_id): every different window of every item, words joined by a blank; a hot window is many rows."""
    listed = bench.select(F.col(item_id).cast("string").alias("item_id"), normal_words(F.col(text)).alias("w"))
    runs = F.when(
        F.size("w") >= n,
        F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " ")),
    ).when(F.size("w") > 0, F.array(F.array_join("w", " ")))
    return listed.where(F.size("w") > 0).select(F.explode(F.array_distinct(runs)).alias("window"), "item_id").distinct()


class WindowSet:
    """One block of windows: hashes by length for lookup, words for verification."""

    def __init__(self, items_of: dict[bytes, list[str]]):
        self.items_of = items_of
        by_length = defaultdict(list)
        texts = pa.array([k.decode() for k in items_of], pa.large_string())
        for chunk in W.chunks(texts, W.not_space(), W.same_bytes()):
            hashes = chunk.hashes()
            for first, last in zip(chunk.first_word[:-1], chunk.first_word[1:], strict=True):
                by_length[int(last - first)].append(W.combine(hashes, np.array([first]), int(last - first))[0])
        self.hashes = {n: np.unique(np.array(h, np.uint64)) for n, h in by_length.items()}
        mask = np.uint64((1 << FILTER_BITS) - 1)
        self.mask = mask
        self.maybe = {}
        for n, h in self.hashes.items():
            self.maybe[n] = np.zeros(1 << FILTER_BITS, dtype=bool)
            self.maybe[n][h & mask] = True

    def hits(self, chunk: W.Chunk) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, number of words, item ids) of every verified occurrence."""
        hashes = chunk.hashes()
        for n, known in self.hashes.items():
            first, found = chunk.windows(hashes, n)
            near = np.flatnonzero(self.maybe[n][found & self.mask])
            at = np.minimum(np.searchsorted(known, found[near]), len(known) - 1)
            for f in first[near[known[at] == found[near]]].tolist():
                said = b" ".join(chunk.data[chunk.start[k] : chunk.end[k]].tobytes() for k in range(f, f + n))
                items = self.items_of.get(said)
                if items is not None:
                    yield f, n, items


def _blocks(bench: DataFrame, n: int) -> Iterator[tuple[dict[bytes, list[str]], bool]]:
    """Blocks of windows with their item ids, one at a time, and whether a block is the last.

    Windows are dealt with their item, so the items of a hot window lie in many blocks.
    """
    found = materialized(windows(bench, n), "benchmark-windows")
    size = F.octet_length("window") + F.coalesce(F.octet_length("item_id"), F.lit(0)) + 128
    count = 1 + int(found.agg(F.sum(size)).first()[0] or 0) // BLOCK_BYTES
    for b in range(count):
        block: dict[bytes, list[str]] = {}
        for r in found.where(F.pmod(F.xxhash64("window", "item_id"), F.lit(count)) == b).toLocalIterator():
            ids = block.setdefault(r.window.encode(), [])
            if r.item_id is not None:
                ids.append(r.item_id)
        yield block, b == count - 1


SCAN = "struct<n_words:bigint,words:array<int>,items:array<string>,clean:string>"


def scan(docs: DataFrame, bench: DataFrame, n: int = WINDOW, with_clean: bool = False, text: str = "text") -> DataFrame:
    """``docs`` with struct ``leak``: n_words, words (places of hit words), items (ids), clean (text without hit spans, if asked for)."""
    spark = docs.sparkSession
    earlier = []
    none = F.lit(None).cast("array<int>"), F.lit(None).cast("array<string>")
    for block, last in _blocks(bench, n):
        known = spark.sparkContext.broadcast(block)
        if last:
            break
        found = docs.select(F.col(text).alias("text")).select("text", _looker(known, False)("text", *none).alias("leak"))
        hits = found.where(F.size("leak.words") > 0).select(_digest("text").alias("digest"), "leak.words", "leak.items")
        earlier.append(materialized(hits.groupBy("digest").agg(F.first("words").alias("words"), F.first("items").alias("items")), "hits"))
        known.unpersist()
    look = _looker(known, with_clean)
    if not earlier:
        return docs.withColumn("leak", look(F.col(text), *none))
    merged = reduce(DataFrame.unionAll, earlier).groupBy("digest").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("words")))).alias("words"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    merged = materialized(merged.select("digest", F.struct("words", "items").alias("leak")), "merged-hits")
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.join(merged, _digest(f"row.{text}") == F.col("digest"), "left").select("row", "leak")
    rows = rows.select("row", look(F.col(f"row.{text}"), F.col("leak.words"), F.col("leak.items")).alias("leak"))
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() != "leak"], "leak")


def _digest(text: str) -> Column:
    return F.sha2(F.col(text).cast("binary"), 256)


def _looker(block: Broadcast, with_clean: bool):
    @F.arrow_udf(SCAN)
    def look(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        known = WindowSet(block.value)
        for texts, words, items in batches:
            yield _look(known, texts, words, items, with_clean)

    return look


def _look(known: WindowSet, texts: pa.Array, words: pa.Array, items: pa.Array, with_clean: bool) -> pa.Array:
    """Adds one block's hits to the hit words and items found so far."""
    n_words = np.zeros(len(texts), np.int64)
    hit_words, hit_items, clean = words.to_pylist(), items.to_pylist(), [None] * len(texts)
    for chunk in W.chunks(texts, W.alphanumeric(), W.lower_ascii()):
        rows = slice(chunk.first_row, chunk.first_row + chunk.n_rows)
        n_words[rows] = np.diff(chunk.first_word)
        step = np.zeros(len(chunk.start) + 1, np.int64)
        named = defaultdict(set)
        for first, n, ids in known.hits(chunk):
            step[first] += 1
            step[first + n] -= 1
            named[int(chunk.row[first])].update(ids)
        covered = np.cumsum(step[:-1]) > 0
        touched = {r for r in range(chunk.n_rows) if hit_words[chunk.first_row + r]} | set(named)
        for r in touched:
            at, lo, hi = chunk.first_row + r, chunk.first_word[r], chunk.first_word[r + 1]
            places = np.flatnonzero(covered[lo:hi])
            if hit_words[at]:
                places = np.union1d(places, np.array(hit_words[at]))
            hit_words[at] = places.tolist()
            hit_items[at] = sorted(named[r].union(hit_items[at] or ()))
            if with_clean:
                clean[at] = _without(chunk, r, places)
    fields = ["n_words", "words", "items", "clean"]
    columns = [
        pa.array(n_words),
        pa.array([w or [] for w in hit_words], pa.list_(pa.int32())),
        pa.array([i or [] for i in hit_items], pa.list_(pa.string())),
        pa.array(clean, pa.string()),
    ]
    return pa.StructArray.from_arrays(columns, fields)


def _without(chunk: W.Chunk, row: int, places: np.ndarray) -> str:
    """The row's text without the spans from the first to the last word of each run of hit words."""
    base = chunk.first_word[row]
    runs = np.split(places, np.flatnonzero(np.diff(places) > 1) + 1)
    kept, at = [], chunk.bounds[row]
    for run in runs:
        if len(run):
            kept.append(chunk.raw[at : chunk.start[base + run[0]]].tobytes())
            at = chunk.end[base + run[-1]]
    kept.append(chunk.raw[at : chunk.bounds[row + 1]].tobytes())
    return b"".join(kept).decode()


def decontaminate(docs: DataFrame, bench: DataFrame, remove: str = "documents", n: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with the hit spans cut out of their texts."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    rows = docs.select(F.struct("*").alias("doc"))
    found = scan(rows, bench, n, remove == "spans", "doc.text")
    hit = F.size("leak.words") > 0
    if remove == "documents":
        return found.where(~hit).select("doc.*")
    clean = F.col("leak.clean")
    out = F.col("doc").withField("text", F.when(hit, clean).otherwise(F.col("doc.text")))
    if "n_chars" in docs.columns:
        out = out.withField("n_chars", F.when(hit, F.length(clean).cast("bigint")).otherwise(F.col("doc.n_chars")))
    return found.select(out.alias("doc")).select("doc.*")


def leak_report(docs: DataFrame, bench: DataFrame) -> DataFrame:
    found = scan(docs.select("doc_id", "text"), bench).select("doc_id", "leak")
    n_hit = F.size("leak.words").cast("bigint")
    return found.select(
        "doc_id",
        F.col("leak.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("leak.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("leak.items"), ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )

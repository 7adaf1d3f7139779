"""Repeated passages: byte strings of ``SPAN`` bytes that start at two places, found by suffix sorting.

Texts are UTF-8 bytes and a window is a place with ``SPAN`` bytes from there
on, inside one text. A suffix array of the whole corpus would take many times
its size, so windows that may be equal are brought together first:

1. A window's key is the smallest hash of its ``GRAM``-byte strings. Equal
   windows have equal keys, and neighbours mostly share theirs, so a text falls
   into pieces, runs of windows with one key (about one per 185 bytes), each
   known by a 128-bit digest of the bytes that it spans.
2. Pieces found twice are repeated whole. A key with one piece only is done,
   unless that piece holds the key's bytes twice (a text with a short period):
   nothing else can equal its windows. All this follows from counts alone.
3. Of every other key, one copy of each different piece is sent as bytes.
   Blocks of whole keys are suffix-sorted (:mod:`marquee.llm.suffixes`);
   windows with an adjacent common prefix of ``SPAN`` bytes are repeated.
4. Keys with more than ``group_bytes`` of different pieces (a passage in very
   many surroundings) are never sorted in one task: their windows are parted
   by where in the window the smallest hash lies, and keyed anew by the bytes
   that all windows of a part share, in ever finer parts. The finest part is a
   single window, whose copies are all one piece, so this ends exactly.

All windows are decided on the input as it is; every byte inside a repeated
window is removed.

Defined cases:

* null and empty text: no bytes, nothing removed, digest of no bytes;
* a text shorter than ``SPAN`` has no window; a very long text is worked
  through in blocks of ``BLOCK`` windows, so a piece ends there at the latest;
* rows with equal texts, ids repeated or not, are copies: each such text of
  ``SPAN`` bytes or more goes whole; null ids are judged like any other;
* ties (equal smallest hashes in a window) leave the key as it is; where parts
  are formed, the last such place counts;
* extra columns stay (``without_repeats``), one named like an output is
  replaced; empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import words as W
from marquee.llm.suffixes import repeated
from marquee.session import materialized

SPAN = 400
GRAM = 32  # a power of two
BLOCK = 256 << 10  # windows worked on at once
BUCKET_BYTES = 1 << 20  # bytes sorted at once
GROUP_BYTES = 1 << 20  # most bytes of one key sorted at once
TASK_BYTES = 8 << 20  # bytes of pieces sorted by one task
PARTS = (96, 24, 6, 1)  # windows per part, for keys beyond GROUP_BYTES

_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLY = _rng.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_TEXT = ["d1", "d2", "base"]  # a text by digest, and where in it the bytes at hand begin
_PIECE = ["key", "s1", "s2"]
_PIECES = "d1 bigint, d2 bigint, base bigint, known boolean, start int, n int, key bigint, s1 bigint, s2 bigint, inner boolean"


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on."""
    found, size, k = _BYTE[data], 1, 0
    while size < GRAM:
        found = found[:-size] * _MULTIPLY[k] + found[size:]
        size, k = 2 * size, k + 1
    return W.mix(found)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours."""
    least, size = values, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return np.minimum(least[: len(values) - width + 1], least[width - size :]) if width > size else least


def _place_of_least(values: np.ndarray, width: int) -> np.ndarray:
    """Last place of the smallest of every ``width`` neighbours."""

    def lower(v, p, w, q):
        second = w <= v
        return np.where(second, w, v), np.where(second, q, p)

    least, place, size = values, np.arange(len(values)), 1
    while 2 * size <= width:
        least, place = lower(least[:-size], place[:-size], least[size:], place[size:])
        size *= 2
    n = len(values) - width + 1
    return lower(least[:n], place[:n], least[width - size :], place[width - size :])[1] if width > size else place


def _digests(data: memoryview, lows: np.ndarray, highs: np.ndarray, seed: bytes = b"") -> np.ndarray:
    """128-bit digests of byte ranges, as two longs each."""
    base = hashlib.blake2b(seed, digest_size=16)
    out = bytearray()
    for lo, hi in zip(lows.tolist(), highs.tolist(), strict=True):
        h = base.copy()
        h.update(data[lo:hi])
        out += h.digest()
    return np.frombuffer(bytes(out), "<i8").reshape(-1, 2)


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a binary column without nulls."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


Labels = tuple[np.ndarray, ...]  # arrays over the windows of a block; a piece ends where one changes


@dataclass
class _Block:
    """Bytes worked on at once, and the pieces in them."""

    data: np.ndarray
    grams: np.ndarray
    row: np.ndarray  # text of each piece
    start: np.ndarray  # its first window, in the block
    size: np.ndarray  # its windows
    at: np.ndarray  # its first window, in its text
    labels: Labels


def _runs(bytes_: pa.Array, span: int, label: Callable[[np.ndarray], Labels]) -> Iterator[_Block]:
    data, bounds = _buffer(bytes_)
    for lo in range(0, max(len(data) - span + 1, 0), BLOCK):
        n = min(BLOCK, len(data) - span + 1 - lo)
        block = data[lo : lo + n + span - 1]
        first = int(np.searchsorted(bounds, lo, side="right")) - 1
        inside = bounds[first + 1 : int(np.searchsorted(bounds, lo + n, side="left"))] - lo
        row = np.zeros(n, np.int64)
        np.add.at(row, inside, 1)
        row = first + np.cumsum(row)
        usable = np.arange(lo, lo + n) + span <= bounds[row + 1]
        grams = _grams(block)
        labels = label(grams)
        turn = np.ones(n, dtype=bool)
        turn[1:] = (row[1:] != row[:-1]) | (usable[1:] != usable[:-1])
        for values in labels:
            turn[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(turn)
        sizes = np.diff(np.concatenate((starts, [n])))
        keep = usable[starts]
        starts, sizes = starts[keep], sizes[keep]
        yield _Block(block, grams, row[starts], starts, sizes, lo + starts - bounds[row[starts]], tuple(v[starts] for v in labels))


def _batch(batch: pa.RecordBatch, block: _Block, span: int, key: np.ndarray, inner: np.ndarray) -> pa.RecordBatch:
    said = batch.select([*_TEXT, "known"]).take(pa.array(block.row))
    digest = _digests(memoryview(block.data), block.start, block.start + block.size + span - 1)
    columns = [block.at.astype(np.int32), block.size.astype(np.int32), key.view(np.int64), digest[:, 0], digest[:, 1], inner]
    return pa.RecordBatch.from_arrays([*said.columns, *(pa.array(c) for c in columns)], names=[*_TEXT, "known", "start", "n", *_PIECE, "inner"])


def _holds_key_twice(block: _Block, key: np.ndarray, span: int) -> np.ndarray:
    """Whether a piece has its smallest hash at several places; only then can two of its own windows be equal."""
    if not len(key):
        return np.zeros(0, dtype=bool)
    low = np.flatnonzero(block.grams <= key.max())
    values, rank = np.unique(block.grams[low], return_inverse=True)
    width = len(block.grams) + 1
    codes = np.sort(rank * width + low)
    first = np.searchsorted(values, key) * width + block.start
    return np.searchsorted(codes, first + block.size + span - GRAM) - np.searchsorted(codes, first) > 1


def _by_least_hash(span: int):
    """Pieces of texts: runs of windows with the same smallest hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _runs(batch["bytes"], span, lambda grams: (_least(grams, span - GRAM + 1),)):
                (key,) = block.labels
                yield _batch(batch, block, span, key, _holds_key_twice(block, key, span))

    return cut


def _by_place(span: int, width: int):
    """Pieces of pieces: windows whose smallest hash lies in the same part, keyed by what the part's windows share."""
    last = span - GRAM

    def label(grams: np.ndarray) -> Labels:
        place = _place_of_least(grams, last + 1)
        return place, (place - np.arange(len(place))) // width

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _runs(batch["bytes"], span, label):
                place, part = block.labels
                low = part * width
                high = np.minimum(low + width - 1, last)
                shared = _digests(memoryview(block.data), place - low, place - high + span, b"shared")[:, 0]
                key = W.mix(shared.view(np.uint64) ^ W.mix(part.astype(np.uint64)))
                yield _batch(batch, block, span, key, np.zeros(len(key), dtype=bool))

    return cut


def _sorted_blocks(span: int, bucket_bytes: int):
    """Repeated windows among pieces that come key by key."""

    def find(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        data, bounds = _buffer(table["piece"].chunk(0) if isinstance(table["piece"], pa.ChunkedArray) else table["piece"])
        usable = np.zeros(len(data), dtype=bool)
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        usable[:] = np.arange(len(data)) + span <= bounds[row + 1]
        found = repeated(data, usable, span)
        found &= ~table["known"].to_numpy(zero_copy_only=False)[row]
        turn = np.flatnonzero(np.diff(np.concatenate(([False], found, [False]))) | np.concatenate(([False], np.diff(row) != 0, [True])))
        starts = turn[:-1][found[turn[:-1]]] if len(turn) > 1 else np.zeros(0, np.int64)
        ends = turn[1:][found[turn[:-1]]] if len(turn) > 1 else starts
        of = row[starts]
        begin = table["begin"].to_numpy()[of] + (starts - bounds[of])
        ids = [table[c].to_numpy()[of] for c in ("d1", "d2")]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in (*ids, begin, ends - starts)], names=["d1", "d2", "begin", "n"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch["key"].to_numpy()
            ends = np.concatenate((np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
            lengths = np.cumsum(np.diff(_buffer(batch["piece"])[1]))
            at = 0
            for end in ends.tolist():
                new_key = bool(waiting) and waiting[-1]["key"][-1].as_py() != int(key[at])
                if new_key and size >= bucket_bytes:
                    yield find(waiting)
                    waiting, size = [], 0
                waiting.append(batch.slice(at, end - at))
                size += int(lengths[end - 1] - (lengths[at - 1] if at else 0))
                at = end
        if waiting:
            yield find(waiting)

    return sort


def _live_pieces(pieces: DataFrame, span: int, group_bytes: int) -> DataFrame:
    """A place of each different piece that is found ``twice`` or may share windows; ``group_size`` are the bytes to sort for its key, ``hot`` if too many."""
    weight = F.when(F.col("known"), F.lit(2)).otherwise(F.lit(1))
    sample = [F.first(c).alias(f"one_{c}") for c in (*_TEXT, "start")]
    classes = pieces.groupBy(*_PIECE).agg(F.sum(weight).alias("times"), F.first("n").alias("n"), F.first("inner").alias("inner"), *sample)
    size = (F.col("n") + (span - 1)).cast("bigint")
    several = classes.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum(size).alias("size")).where("kinds > 1")
    # Written before the join: a key with very many pieces is dealt over several tasks only if both sides come straight from a shuffle.
    several = materialized(several.select("key", F.col("size").alias("group_size")), "shared-keys")
    group_size = F.coalesce("group_size", F.when(F.col("inner"), size))
    live = classes.join(several, "key", "left").withColumn("group_size", group_size).where("times > 1 or group_size is not null")
    live = live.withColumn("twice", F.col("times") > 1).withColumn("hot", F.col("group_size") > group_bytes)
    return live.drop("times", "n", "inner")


def _level(texts: DataFrame, cut, span: int, group_bytes: int, bucket_bytes: int) -> tuple[DataFrame, DataFrame, bool]:
    """One round over (d1, d2, base, known, bytes): (repeated windows, pieces of keys too large to sort, whether there are any)."""
    pieces = materialized(texts.mapInArrow(cut, _PIECES), "pieces")
    live = materialized(_live_pieces(pieces, span, group_bytes), "live-pieces")

    marked = pieces.join(live, _PIECE)
    spans = marked.where("twice and not known").select("d1", "d2", (F.col("base") + F.col("start")).alias("begin"), F.col("n").cast("bigint").alias("n"))
    chosen = marked.where("group_size is not null")
    for c in (*_TEXT, "start"):
        chosen = chosen.where(F.col(c) == F.col(f"one_{c}"))
    send = F.struct("key", "s1", "s2", "start", "n", F.col("twice").alias("known"), "hot")
    wanted = chosen.groupBy(*_TEXT).agg(F.collect_set(send).alias("send"))
    bytes_ = texts.select(*_TEXT, "bytes").groupBy(*_TEXT).agg(F.first("bytes").alias("bytes"))
    sent = F.transform(
        "send", lambda p: p.withField("piece", F.substring(F.col("bytes"), p.getField("start") + 1, p.getField("n") + (span - 1)))
    )
    shipped = bytes_.join(wanted, _TEXT).select(*_TEXT, F.explode(sent).alias("p"))
    begin = F.col("base") + F.col("p.start")
    shipped = materialized(shipped.select("d1", "d2", begin.alias("begin"), "p.key", "p.known", "p.hot", "p.piece"), "sent-pieces")

    sizes = {r["hot"]: r["size"] for r in shipped.groupBy("hot").agg(F.sum(F.length("piece")).alias("size")).collect()}
    if sizes.get(False):
        tasks = sizes[False] // TASK_BYTES + 1
        ordered = shipped.where(~F.col("hot")).drop("hot").repartition(tasks, "key").sortWithinPartitions("key")
        found = ordered.mapInArrow(_sorted_blocks(span, bucket_bytes), "d1 bigint, d2 bigint, begin bigint, n bigint")
        spans = spans.unionByName(materialized(found, "sorted-windows"))
    hot = shipped.where("hot").select("d1", "d2", F.col("begin").alias("base"), "known", F.col("piece").alias("bytes"))
    return spans, hot, bool(sizes.get(True))


def digest_columns(text: Column) -> list[Column]:
    """128 bits of the text's SHA-256, as two longs."""
    sha = F.sha2(text, 256)
    return [F.conv(F.substring(sha, 1 + 16 * k, 16), 16, -10).cast("bigint").alias(f"d{k + 1}") for k in range(2)]


def repeated_windows(docs: DataFrame, span: int = SPAN, group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(d1, d2, begin, n): runs of repeated windows of each different text (named by its digest)."""
    if span <= GRAM:
        raise ValueError(f"span must be over {GRAM}")
    texts = docs.select(*digest_columns(F.col("text")), F.col("text").cast("binary").alias("bytes")).where(F.octet_length("text") >= span)
    texts = texts.select("d1", "d2", F.lit(0).cast("bigint").alias("base"), F.lit(False).alias("known"), "bytes")
    found = []
    cuts = [_by_least_hash(span), *(_by_place(span, width) for width in PARTS)]
    for cut in cuts:
        spans, texts, more = _level(texts, cut, span, group_bytes, bucket_bytes)
        found.append(spans)
        if not more:
            break
    return reduce(DataFrame.unionByName, found)


def _cutter(span: int):
    @F.arrow_udf("struct<kept: binary, n_removed: bigint, n_spans: bigint>")
    def cut(bytes_: pa.Array, runs: pa.Array) -> pa.Array:
        kept, removed, spans = [], [], []
        for text, run in zip(bytes_, runs, strict=True):
            data = text.as_buffer()
            begin = run.values.field("begin").to_numpy()
            end = begin + run.values.field("n").to_numpy() + (span - 1)
            order = np.argsort(begin, kind="stable")
            begin, end = begin[order], np.maximum.accumulate(end[order])
            new = np.concatenate(([True], begin[1:] > end[:-1]))
            lows = begin[new]
            highs = end[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(end) - 1]))]
            view, at, left = memoryview(data), 0, []
            for lo, hi in zip(lows.tolist(), highs.tolist(), strict=True):
                left.append(view[at:lo])
                at = hi
            left.append(view[at:])
            kept.append(b"".join(left))
            removed.append(int((highs - lows).sum()))
            spans.append(len(lows))
        columns = [pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())]
        return pa.StructArray.from_arrays(columns, ["kept", "n_removed", "n_spans"])

    return cut


def _cut_texts(docs: DataFrame, span: int, **limits: int) -> DataFrame:
    """(d1, d2, kept, n_removed, n_spans) of each different text that loses something."""
    windows = repeated_windows(docs, span, **limits)
    runs = windows.groupBy("d1", "d2").agg(F.collect_set(F.struct("begin", "n")).alias("runs"))
    texts = docs.select(*digest_columns(F.col("text")), F.col("text").cast("binary").alias("bytes")).where(F.octet_length("text") >= span)
    texts = texts.groupBy("d1", "d2").agg(F.first("bytes").alias("bytes"))
    return texts.join(runs, ["d1", "d2"]).select("d1", "d2", _cutter(span)("bytes", "runs").alias("c")).select("d1", "d2", "c.*")


def without_repeats(docs: DataFrame, span: int = SPAN, **limits: int) -> DataFrame:
    """``docs`` with ``kept`` (the bytes that stay; null for a null text), ``n_bytes``, ``n_removed`` and ``n_spans``."""
    outputs = ("kept", "n_bytes", "n_removed", "n_spans", "__d1", "__d2")
    cut = materialized(_cut_texts(docs, span, **limits), "cut-texts").select(F.col("d1").alias("c1"), F.col("d2").alias("c2"), F.struct("kept", "n_removed", "n_spans").alias("__cut"))
    own = [c for c in docs.columns if c.lower() not in outputs]
    d1, d2 = digest_columns(F.col("text"))
    named = docs.select(*own, d1.alias("__d1"), d2.alias("__d2"))
    joined = named.join(cut, (F.col("__d1") == F.col("c1")) & (F.col("__d2") == F.col("c2")), "left")
    return joined.select(
        *own,
        F.when(F.col("__cut").isNotNull(), F.col("__cut.kept")).otherwise(F.col("text").cast("binary")).alias("kept"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.coalesce("__cut.n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("__cut.n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
    )


def repeats_report(docs: DataFrame, span: int = SPAN, **limits: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``; no text is joined."""
    cut = _cut_texts(docs, span, **limits).select("d1", "d2", F.sha2("kept", 256).alias("kept_sha"), "n_removed", "n_spans")
    cut = materialized(cut, "cut-texts")
    named = docs.select(
        "doc_id",
        *digest_columns(F.col("text")),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"),
    )
    return named.join(cut, ["d1", "d2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("kept_sha", "sha").alias("kept_sha256"),
    )

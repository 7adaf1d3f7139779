"""Words of whole texts as numpy arrays, for code that runs inside tasks.

A batch of texts is one Arrow buffer of UTF-8 bytes. Words are maximal runs of
bytes of a class (all separators used here are ASCII, so byte runs are
character runs). Everything is computed on whole buffers, in chunks of a
bounded number of bytes (a single longer text is a chunk of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 512 << 10
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)

# The white space of the word pattern [^\x20\x09-\x0D]+.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def not_space() -> np.ndarray:
    """Byte class of ``[^\\x20\\x09-\\x0D]``."""
    mask = np.ones(256, dtype=bool)
    mask[list(SPACES)] = False
    return mask


def alphanumeric() -> np.ndarray:
    """Byte class of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z."""
    mask = np.zeros(256, dtype=bool)
    for first, last in (("0", "9"), ("a", "z"), ("A", "Z")):
        mask[ord(first) : ord(last) + 1] = True
    mask[0x80:] = True
    return mask


def lower_ascii() -> np.ndarray:
    """Byte map that lower-cases A-Z and nothing else."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def same_bytes() -> np.ndarray:
    return np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; equal inputs stay equal, close inputs spread."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Chunk:
    """Consecutive texts: bytes (case folded if asked for), row bounds and words."""

    first_row: int
    raw: np.ndarray  # uint8, as stored
    data: np.ndarray  # uint8, folded
    bounds: np.ndarray  # int64, n_rows + 1 offsets into data
    start: np.ndarray  # int64, word starts
    end: np.ndarray  # int64, word ends (exclusive)
    row: np.ndarray  # int64, row of each word, from 0 in the chunk
    first_word: np.ndarray  # int64, n_rows + 1 offsets into the words

    @property
    def n_rows(self) -> int:
        return len(self.bounds) - 1

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        weight = np.cumprod(np.full(int(length.max()), _BASE, np.uint64))
        word_first = np.cumsum(length) - length
        at = np.arange(int(length.sum()), dtype=np.int64)
        place = at - np.repeat(word_first, length)
        at_byte = place + np.repeat(self.start, length)
        terms = (self.data[at_byte].astype(np.uint64) + np.uint64(1)) * weight[place]
        return mix(np.add.reduceat(terms, word_first) + length.astype(np.uint64))

    def windows(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``n`` words inside one text."""
        if len(hashes) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        first = np.flatnonzero(self.row[: len(self.row) - n + 1] == self.row[n - 1 :])
        return first, combine(hashes, first, n)


def combine(hashes: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Hash of the word runs ``first .. first + n - 1``; the length is part of it."""
    total = np.full(len(first), np.uint64(n), np.uint64)
    for k in range(n):
        total = total * _STEP + hashes[first + k]
    return mix(total)


def _offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bounds, raw


def chunks(texts: pa.Array, is_word: np.ndarray, fold: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Consecutive chunks that cover all ``texts``; null is an empty text."""
    bounds, raw = _offsets(texts)
    row, n = 0, len(texts)
    while row < n:
        stop = int(np.searchsorted(bounds, bounds[row] + chunk_bytes, side="right")) - 1
        stop = min(max(stop, row + 1), n)
        yield _chunk(row, raw[bounds[row] : bounds[stop]], bounds[row : stop + 1] - bounds[row], is_word, fold)
        row = stop


def _chunk(first_row: int, raw: np.ndarray, bounds: np.ndarray, is_word: np.ndarray, fold: np.ndarray) -> Chunk:
    inside = is_word[raw]
    text_start = np.zeros(len(raw) + 1, dtype=bool)
    text_start[bounds] = True
    before = np.concatenate(([False], inside[:-1])) & ~text_start[:-1]
    after = np.concatenate((inside[1:], [False])) & ~text_start[1:]
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first_word = np.searchsorted(start, bounds)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(first_word))
    return Chunk(first_row, raw, fold[raw], bounds, start, end, row, first_word)


def per_row(chunk: Chunk, values: np.ndarray) -> np.ndarray:
    """Sums word values by row."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[chunk.first_word[1:]] - total[chunk.first_word[:-1]]


def bytes_per_row(chunk: Chunk, flags: np.ndarray) -> np.ndarray:
    """Counts flagged bytes by row."""
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[chunk.bounds[1:]] - total[chunk.bounds[:-1]]


def resplit(chunk: Chunk, is_word: np.ndarray, fold: np.ndarray) -> Chunk:
    """The same texts split by another byte class."""
    return _chunk(chunk.first_row, chunk.raw, chunk.bounds, is_word, fold)


def repeats(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (row, hash) pair: whether it is the first of its kind, and how many there are of it."""
    first, count = np.zeros(len(row), dtype=bool), np.zeros(len(row), np.int64)
    if len(row):
        key = hashes ^ mix(row.astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
        sizes = np.diff(np.concatenate((starts, [len(row)])))
        first[order[starts]] = True
        count[order] = np.repeat(sizes, sizes)
    return first, count

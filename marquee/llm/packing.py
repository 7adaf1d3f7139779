"""Token ids packed into fixed-length rows by best-fit-decreasing.

Texts are tokenized with a public byte-level BPE, an end token is appended,
and documents longer than a row are split without loss. Every partition packs
its own pieces in windows of ``WINDOW_TOKENS`` tokens: largest first, each
into the open row with the least room that still holds it. The row is found
in a segment tree over capacities. Nothing is shuffled, and a task holds one
window at a time.

A packed row carries its ids (padded), the cumulative lengths of its segments,
position ids that restart at every segment, and where each segment came from.

Defined cases: a null or empty text gives no tokens and no segment; a null id
stays null in the segment list; repeated documents are packed each time; an
empty table gives no rows. Equally long documents keep their order. Only the
id and the text are read, whatever else the table holds. Strings of special tokens in a text are plain text.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern of that public vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_TOKEN = 50256  # free in that vocabulary
ROW_TOKENS = 2048
WINDOW_TOKENS = 2_000_000
PACKED = (
    "part int, row bigint, n_tokens int, ids binary, cu_seqlens array<int>, position_ids binary, "
    "doc_ids array<bigint>, doc_offsets array<bigint>"
)


class Piece(NamedTuple):
    doc_id: int | None
    offset: int  # of its first token in the document
    ids: np.ndarray


class Capacities:
    """Segment tree whose leaf ``c`` says whether some row has room for exactly ``c`` more tokens."""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]
        self.largest = [0] * (2 * self.width)  # largest capacity below each node; 0: none

    def _set(self, capacity: int, value: int) -> None:
        at = self.width + capacity
        self.largest[at] = value
        while at > 1:
            at >>= 1
            self.largest[at] = max(self.largest[2 * at], self.largest[2 * at + 1])

    def add(self, row: int, capacity: int) -> None:
        if capacity:
            if not self.rows[capacity]:
                self._set(capacity, capacity)
            self.rows[capacity].append(row)

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes and returns (row, capacity) with the least capacity of at least ``need``."""
        at = 1
        if self.largest[at] < need:
            return None
        while at < self.width:
            at = 2 * at if self.largest[2 * at] >= need else 2 * at + 1
        capacity = at - self.width
        row = self.rows[capacity].pop()
        if not self.rows[capacity]:
            self._set(capacity, 0)
        return row, capacity


def split_long(doc_id: int | None, ids: np.ndarray, row_tokens: int) -> list[Piece]:
    return [Piece(doc_id, lo, ids[lo : lo + row_tokens]) for lo in range(0, len(ids), row_tokens)]


def best_fit_decreasing(pieces: list[Piece], row_tokens: int) -> list[list[Piece]]:
    """Rows of pieces; equally long pieces keep their order."""
    rows: list[list[Piece]] = []
    tree = Capacities(row_tokens)
    for piece in sorted(pieces, key=lambda p: -len(p.ids)):
        found = tree.take(len(piece.ids))
        if found is None:
            rows.append([])
            found = (len(rows) - 1, row_tokens)
        rows[found[0]].append(piece)
        tree.add(found[0], found[1] - len(piece.ids))
    return rows


_ENCODINGS: dict[int, tiktoken.Encoding] = {}


def encoding(ranks_file: bytes) -> tiktoken.Encoding:
    """Built once per Python worker."""
    key = hash(ranks_file)
    if key not in _ENCODINGS:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks_file.splitlines())}
        _ENCODINGS[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[key]


def _batch(rows: list[list[Piece]], part: int, first_row: int, row_tokens: int) -> pa.RecordBatch:
    ids = np.full((len(rows), row_tokens), END_TOKEN, "<u2")
    positions = np.zeros((len(rows), row_tokens), "<u2")
    lengths, ends, docs, offsets = [], [], [], []
    for r, row in enumerate(rows):
        ends.append([0])
        for piece in row:
            lo = ends[r][-1]
            hi = lo + len(piece.ids)
            ids[r, lo:hi] = piece.ids
            positions[r, lo:hi] = np.arange(hi - lo)
            ends[r].append(hi)
        lengths.append(ends[r][-1])
        docs.append([p.doc_id for p in row])
        offsets.append([p.offset for p in row])
    columns = [
        pa.array(np.full(len(rows), part, np.int32)),
        pa.array(np.arange(first_row, first_row + len(rows))),
        pa.array(lengths, pa.int32()),
        pa.array([r.tobytes() for r in ids], pa.binary()),
        pa.array(ends, pa.list_(pa.int32())),
        pa.array([r.tobytes() for r in positions], pa.binary()),
        pa.array(docs, pa.list_(pa.int64())),
        pa.array(offsets, pa.list_(pa.int64())),
    ]
    names = [field.split()[0] for field in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays(columns, names)


def _packer(ranks_file: Broadcast, row_tokens: int, window_tokens: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(ranks_file.value)
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        waiting: list[Piece] = []
        n_waiting = n_rows = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                said = text.as_py()
                if not said:
                    continue
                ids = np.array([*bpe.encode_ordinary(said), END_TOKEN], np.uint16)
                waiting += split_long(doc_id.as_py(), ids, row_tokens)
                n_waiting += len(ids)
                if n_waiting >= window_tokens:
                    for out in _rows(waiting, part, n_rows, row_tokens):
                        n_rows += out.num_rows
                        yield out
                    waiting, n_waiting = [], 0
        yield from _rows(waiting, part, n_rows, row_tokens)

    return pack


def _rows(pieces: list[Piece], part: int, first_row: int, row_tokens: int) -> Iterator[pa.RecordBatch]:
    rows = best_fit_decreasing(pieces, row_tokens)
    for lo in range(0, len(rows), 256):
        yield _batch(rows[lo : lo + 256], part, first_row + lo, row_tokens)


def pack_tokens(
    docs: DataFrame,
    row_tokens: int = ROW_TOKENS,
    window_tokens: int = WINDOW_TOKENS,
    tokenizer: str = TOKENIZER,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Packed rows: ids and position_ids are little-endian 16-bit matrices rows of ``row_tokens`` entries.

    (part, row) names a packed row: the input partition and the row's place in it.
    """
    if not 1 <= row_tokens <= 65536:
        raise ValueError("row_tokens must be 1 to 65536, so that positions fit 16 bits")
    with open(tokenizer, "rb") as f:
        ranks_file = docs.sparkSession.sparkContext.broadcast(f.read())
    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(_packer(ranks_file, row_tokens, window_tokens), PACKED)


def write_packed(packed: DataFrame, path: str) -> None:
    """Writes the id matrix with its segment lengths and positions, and the segment origins, as parquet."""
    packed.select("part", "row", "n_tokens", "ids", "cu_seqlens", "position_ids").write.parquet(os.path.join(path, "rows"))
    origins = packed.select("part", "row", F.posexplode(F.arrays_zip("doc_ids", "doc_offsets")).alias("segment", "of"))
    origins.select("part", "row", "segment", "of.doc_ids", "of.doc_offsets").write.parquet(os.path.join(path, "segments"))


def read_matrix(rows: list[bytes], row_tokens: int = ROW_TOKENS) -> np.ndarray:
    """The 16-bit matrix of stored rows."""
    return np.frombuffer(b"".join(rows), "<u2").reshape(-1, row_tokens)

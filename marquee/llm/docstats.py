"""Statistics of whole texts, computed on Arrow batches inside tasks.

The five base counts are exact; the features are shares and means derived from
them and from a few more counts. A null text has the counts of an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from marquee.llm import words as W

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words",
    "mean_word_chars",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "punctuation_share",
    "distinct_share",
    "short_word_share",
    "line_words",
    "wordless_line_share",
    "top_word_share",
)

# The symbols counted by n_symbols.
SYMBOLS = "#*$%&|<>"


def _flags(chars: str) -> np.ndarray:
    mask = np.zeros(256, dtype=bool)
    mask[[ord(c) for c in chars]] = True
    return mask


def _span(first: str, last: str) -> np.ndarray:
    mask = np.zeros(256, dtype=bool)
    mask[ord(first) : ord(last) + 1] = True
    return mask


_NOT_SPACE, _NOT_NEWLINE = W.not_space(), ~_flags("\n")
_CHAR_START = (np.arange(256) & 0xC0) != 0x80
_LETTERS = _span("a", "z") | _span("A", "Z") | _span("0", "9")
_SYMBOL, _UPPER, _DIGIT = _flags(SYMBOLS), _span("A", "Z"), _span("0", "9")
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[0x21:0x7F] = True
_PUNCTUATION &= ~_LETTERS


def _of_chunk(chunk: W.Chunk) -> tuple[np.ndarray, np.ndarray]:
    raw, n = chunk.raw, chunk.n_rows
    hashes = chunk.hashes()
    n_words = np.diff(chunk.first_word)
    word_chars = W.bytes_per_row(chunk, _CHAR_START[raw] & _NOT_SPACE[raw])
    n_symbols = W.bytes_per_row(chunk, _SYMBOL[raw])

    lines = W.resplit(chunk, _NOT_NEWLINE, W.same_bytes())
    word_bytes = np.concatenate(([0], np.cumsum(_NOT_SPACE[raw])))
    worded = word_bytes[lines.end] > word_bytes[lines.start]
    line_row = lines.row[worded]
    first_line, _ = W.repeats(line_row, lines.hashes()[worded])
    n_lines = np.bincount(line_row, minlength=n)
    n_dup_lines = np.bincount(line_row[~first_line], minlength=n)

    at, runs = chunk.windows(hashes, 3)
    _, found = W.repeats(chunk.row[at], runs)
    covered = np.zeros(len(hashes), dtype=bool)
    for k in range(3):
        covered[at[found > 1] + k] = True
    n_repeat_words = W.per_row(chunk, covered.astype(np.int64))

    base = np.stack([n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words], axis=1).astype(np.int64)

    first_word, seen = W.repeats(chunk.row, hashes)
    length = chunk.end - chunk.start
    top = np.zeros(n, np.int64)
    np.maximum.at(top, chunk.row[first_word], seen[first_word])
    some_words, some_chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    all_lines = np.maximum(W.bytes_per_row(chunk, ~_NOT_NEWLINE[raw]) + 1, 1)
    features = np.stack(
        [
            np.log1p(n_words),
            word_chars / some_words,
            n_symbols / some_chars,
            n_dup_lines / np.maximum(n_lines, 1),
            n_repeat_words / some_words,
            W.bytes_per_row(chunk, _UPPER[raw]) / some_chars,
            W.bytes_per_row(chunk, _DIGIT[raw]) / some_chars,
            W.bytes_per_row(chunk, _PUNCTUATION[raw]) / some_chars,
            W.per_row(chunk, first_word.astype(np.int64)) / some_words,
            W.per_row(chunk, (length <= 3).astype(np.int64)) / some_words,
            n_words / np.maximum(n_lines, 1),
            (all_lines - n_lines) / all_lines,
            top / some_words,
        ],
        axis=1,
    )
    return base, features


def stats(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows x BASE int64, rows x FEATURES float64) of a batch of texts."""
    base = np.zeros((len(texts), len(BASE)), np.int64)
    features = np.zeros((len(texts), len(FEATURES)))
    for chunk in W.chunks(texts, _NOT_SPACE, W.same_bytes()):
        rows = slice(chunk.first_row, chunk.first_row + chunk.n_rows)
        base[rows], features[rows] = _of_chunk(chunk)
    return base, features

"""Suffix order of one bounded block of bytes by two-stage sorting, and adjacent common prefixes.

Stage one sorts directly only the suffixes that are smaller than their
successors. Stage two induces the rest: scanning the order from its small end,
the suffix one byte before a scanned one comes next in the bucket of its first
byte. Everything is compared up to ``depth`` bytes; suffixes that agree so far
are in any order. The scan takes a whole bucket at a time.
"""

from __future__ import annotations

import numpy as np

STEP = 8


def big_endian_words(data: np.ndarray, depth: int) -> np.ndarray:
    """The 8 bytes from each place on as one number; zeros follow the end."""
    padded = np.concatenate((data, np.zeros(depth + 2 * STEP, np.uint8)))
    words = np.zeros(len(data) + depth + STEP, np.uint64)
    for k in range(STEP):
        words = (words << np.uint64(8)) | padded[k : k + len(words)]
    return words


def smaller_than_successor(data: np.ndarray) -> np.ndarray:
    """Whether suffix i sorts before suffix i + 1."""
    n = len(data)
    turns = np.flatnonzero(data[1:] != data[:-1])
    rises = data[turns] < data[turns + 1]
    at = np.searchsorted(turns, np.arange(n))
    return np.concatenate((rises, [False]))[np.minimum(at, len(turns))]


def sort_directly(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of their suffixes, word after word; only what still ties goes on."""
    order = places[np.argsort(words[places], kind="stable")]
    first = words[order]
    group = np.cumsum(np.concatenate(([0], first[1:] != first[:-1]))) if len(order) else np.zeros(0, np.int64)
    active = np.arange(len(order))
    for at in range(STEP, depth, STEP):
        if not len(active):
            break
        same = group[active[1:]] == group[active[:-1]]
        tied = np.concatenate((same, [False])) | np.concatenate(([False], same))
        active = active[tied]
        key, of = words[order[active] + at], group[active]
        wrong = (of[1:] == of[:-1]) & (key[1:] < key[:-1])
        if wrong.any():
            sort = np.flatnonzero(np.isin(of, of[1:][wrong]))
            sorted_ = sort[np.lexsort((key[sort], of[sort]))]
            order[active[sort]], key[sort] = order[active[sorted_]], key[sorted_]
        # Groups are numbered by the place of their first member, so numbers stay unique when they split.
        starts = np.concatenate(([True], (of[1:] != of[:-1]) | (key[1:] != key[:-1])))
        group[active] = len(order) + active[np.maximum.accumulate(np.where(starts, np.arange(len(active)), 0))]
    return order


def suffix_order(data: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Every suffix of ``data`` in order, as far as ``depth`` bytes tell."""
    n = len(data)
    small = smaller_than_successor(data)
    direct = sort_directly(words, np.flatnonzero(small), depth)
    sizes = np.bincount(data, minlength=256)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    n_direct = np.bincount(data[direct], minlength=256)
    order = np.empty(n, np.int64)
    done = 0
    for byte in np.flatnonzero(n_direct):  # within a bucket, the induced ones come first
        order[ends[byte] - n_direct[byte] : ends[byte]] = direct[done : done + n_direct[byte]]
        done += n_direct[byte]
    head = starts.copy()
    if n:  # the last suffix is larger than the empty one behind it
        order[head[data[-1]]] = n - 1
        head[data[-1]] += 1
    for byte in np.flatnonzero(sizes):
        scanned = starts[byte]
        while scanned < head[byte]:  # runs of one byte
            before = order[scanned : head[byte]] - 1
            scanned = head[byte]
            before = before[before >= 0]
            before = before[data[before] == byte]
            order[scanned : scanned + len(before)] = before
            head[byte] += len(before)
        before = order[starts[byte] : ends[byte]] - 1
        before = before[before >= 0]
        before = before[data[before] > byte]
        before = before[np.argsort(data[before], kind="stable")]
        counts = np.bincount(data[before], minlength=256)
        done = 0
        for larger in np.flatnonzero(counts):
            order[head[larger] : head[larger] + counts[larger]] = before[done : done + counts[larger]]
            head[larger] += counts[larger]
            done += counts[larger]
    return order


def common_prefixes(words: np.ndarray, left: np.ndarray, right: np.ndarray, depth: int) -> np.ndarray:
    """Bytes, ``depth`` at most, that the suffixes at ``left[k]`` and ``right[k]`` have in common."""
    common = np.zeros(len(left), np.int64)
    active = np.arange(len(left))
    for at in range(0, depth, STEP):
        differ = words[left[active] + at] ^ words[right[active] + at]
        over = np.flatnonzero(differ)
        if len(over):  # the leading equal bytes of the differing word
            bytes_ = differ[over].astype(">u8").view(np.uint8).reshape(-1, STEP)
            common[active[over]] = at + (bytes_ != 0).argmax(axis=1)
            active = active[differ == 0]
        if not len(active):
            break
    common[active] = depth
    return np.minimum(common, depth)


def repeated(data: np.ndarray, usable: np.ndarray, depth: int) -> np.ndarray:
    """Of the usable places, those whose next ``depth`` bytes occur at another usable place as well."""
    words = big_endian_words(data, depth)
    order = suffix_order(data, words, depth)
    order = order[usable[order]]
    found = np.zeros(len(data), dtype=bool)
    same = common_prefixes(words, order[:-1], order[1:], depth) >= depth
    found[order[:-1][same]] = True
    found[order[1:][same]] = True
    return found

"""Plain Python versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return SPACED.findall(text or "")


def base_counts(text):
    text = text or ""
    w = words(text)
    runs = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    repeated = {i + k for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


def shingles(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def components(docs, percent=85):
    """{doc_id: smallest linked doc_id} from that similarity on; docs: {doc_id: text}."""
    sets = {i: shingles(t) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(docs)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def leaks(text, items, n=10):
    """(n_words, n_hit, sorted item ids, sha256) for items [(id, text)]."""
    w = ALNUM.findall((text or "").translate(LOWER))
    hit, named = set(), set()
    for item, said in items:
        v = ALNUM.findall((said or "").translate(LOWER))
        size = min(n, len(v))
        if not size:
            continue
        wins = {tuple(v[k : k + size]) for k in range(len(v) - size + 1)}
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in wins:
                hit |= set(range(i, i + size))
                if item is not None:
                    named.add(str(item))
    ids = sorted(named)
    return len(w), len(hit), ids, hashlib.sha256(",".join(ids).encode()).hexdigest()


def targets(sizes, weights=(5, 2, 1), share=1.5):
    """{source: target} by repeated sharing of the excess."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full = set()
    left = share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        total = sum(weight[s] for s in rest)
        over = [s for s in rest if weight[s] * left / total > 2 * sizes[s]] if rest else []
        if not over:
            return {s: 2.0 * sizes[s] if s in full else weight[s] * left / total for s in order}
        for s in over:
            full.add(s)
            left -= 2 * sizes[s]


def crc(text):
    return zlib.crc32(text.encode())

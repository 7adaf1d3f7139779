"""URL filter: a bit-parallel automaton over many wildcard rules at once.

All globs are packed into one multiword Shift-And machine. A glob of ``m``
consuming symbols owns ``m + 1`` neighbouring bits; one step moves every state
of every glob by a shift, a mask of the states that accept the byte, and a
mask of the states that loop on it::

    state = (state << 1 & accept[byte]) | (state & loop[byte])

Batches of URLs advance together, one byte position at a time.

Globs that one machine of 4,096 states can't hold are dealt over several. Such a
machine runs only over the URLs that hold a key of one of its globs: four
literal bytes in a row that every URL the glob fits must hold, those that the
fewest globs share. Globs without four such bytes run over every URL.

Glob syntax: ``?`` any one byte, ``*`` any run without ``/``, ``**`` any run.
Globs are matched against the whole canonical URL: host (A-Z lower-cased), then path.

Defined cases: a null URL or one without ``://`` has an empty host and path,
which no rule fits; it falls to the default verdict. Of several fitting rules
the longest wins, of equally long ones the first given. Very long URLs are
matched whole, repeated ones alike; extra columns stay, those named like an
output are replaced. Empty table: no rows. A table of globs may hold nulls
(ignored), repeated and empty globs; an empty one blocks nothing. More than
8 MB of globs are an error, as the machines are broadcast.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.words import CHUNK_BYTES

BLOCK_BYTES = 8 << 20  # of automaton state
MACHINE_BITS = 4096
KEY_BYTES = 4
MAX_GLOB_BYTES = 8 << 20  # a state takes at most 32 bytes of masks, so 0.3 GB at worst


class Rule(NamedTuple):
    action: str  # "block" or "allow"
    host: str
    path: str


# The rules of the query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
# Host names of unwanted sites, for URLs that no rule fits.
JUNK_GLOBS = ("*casino**", "*free-bets**", "*spam-farm**", "*adult-**")


def parse_glob(glob: str) -> tuple[list[int | None], dict[int, str]]:
    """Consuming symbols (None: any), and the kind of run allowed after the first k of them."""
    symbols: list[int | None] = []
    stars: dict[int, str] = {}
    raw, i = glob.encode(), 0
    while i < len(raw):
        if raw[i : i + 2] == b"**":
            stars[len(symbols)] = "**"
            i += 2
        elif raw[i : i + 1] == b"*":
            stars.setdefault(len(symbols), "*")
            i += 1
        else:
            symbols.append(None if raw[i : i + 1] == b"?" else raw[i])
            i += 1
    return symbols, stars


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: empty) and the bounds of each."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), bounds


class GlobMachine:
    """The packed masks of a list of globs; bytes that all globs treat alike share a mask."""

    def __init__(self, globs: Sequence[str]):
        parsed = [parse_glob(g) for g in globs]
        n_bits = sum(len(symbols) + 1 for symbols, _ in parsed)
        self.n_words = max(1, -(-n_bits // 64))
        accept = np.zeros((256, self.n_words * 64), dtype=bool)
        loop = np.zeros((256, self.n_words * 64), dtype=bool)
        start = np.zeros((1, self.n_words * 64), dtype=bool)
        self.final = np.zeros(len(parsed), dtype=np.int64)
        bit = 0
        for g, (symbols, stars) in enumerate(parsed):
            start[0, bit] = True
            for k, symbol in enumerate(symbols):
                if symbol is None:
                    accept[:, bit + k + 1] = True
                else:
                    accept[symbol, bit + k + 1] = True
            for k, star in stars.items():
                loop[:, bit + k] = True
                if star == "*":
                    loop[ord("/"), bit + k] = False
            bit += len(symbols) + 1
            self.final[g] = bit - 1
        self.start = self._pack(start)
        self.accept, self.accept_of = self._classes(self._pack(accept))
        self.loop, self.loop_of = self._classes(self._pack(loop))

    @staticmethod
    def _pack(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").astype(np.uint64)

    @staticmethod
    def _classes(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The different masks, and the place among them of each byte's."""
        different, place = np.unique(masks, axis=0, return_inverse=True)
        return different, place.reshape(-1)

    @property
    def n_bytes(self) -> int:
        return self.accept.nbytes + self.loop.nbytes + self.start.nbytes + self.final.nbytes

    def matches(self, raw: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """(n strings, n globs) booleans for the byte strings of these first places and lengths."""
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        state = np.repeat(self.start, len(order), axis=0)
        one, carry = np.uint64(1), np.uint64(63)
        alive = len(order)
        for at in range(int(length[0]) if len(length) else 0):
            while alive and length[alive - 1] <= at:
                alive -= 1
            now = state[:alive]
            byte = raw[first[:alive] + at]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> carry
            state[:alive] = (moved & self.accept[self.accept_of[byte]]) | (now & self.loop[self.loop_of[byte]])
        out = np.zeros((len(order), len(self.final)), dtype=bool)
        words, bits = np.divmod(self.final, 64)
        out[order] = (state[:, words] >> bits.astype(np.uint64)) & one != 0
        return out

    def first_match(self, raw: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Index of the first glob that fits each byte string, or -1."""
        out = np.full(len(first), -1, dtype=np.int64)
        block = max(1, BLOCK_BYTES // (8 * self.n_words))
        for lo in range(0, len(first), block):
            fits = self.matches(raw, first[lo : lo + block], length[lo : lo + block])
            if fits.shape[1]:
                out[lo : lo + len(fits)] = np.where(fits.any(axis=1), fits.argmax(axis=1), -1)
        return out


def literal_keys(glob: str) -> set[int]:
    """Every KEY_BYTES literal bytes in a row of a glob, as an integer (first byte lowest)."""
    symbols, stars = parse_glob(glob)
    out = set()
    for k in range(len(symbols) - KEY_BYTES + 1):
        run = symbols[k : k + KEY_BYTES]
        if None not in run and not any(k + i in stars for i in range(1, KEY_BYTES)):
            out.add(int.from_bytes(bytes(run), "little"))
    return out


class GlobSet:
    """Any number of globs, in machines of bounded size."""

    def __init__(self, globs: Sequence[str], machine_bits: int = MACHINE_BITS):
        self.n = len(globs)
        choices = [literal_keys(g) for g in globs]
        sharing = Counter(k for keys in choices for k in keys)
        key = np.array([min(keys, key=lambda k: (sharing[k], k)) if keys else -1 for keys in choices], dtype=np.int64)
        bits = np.array([len(parse_glob(g)[0]) + 1 for g in globs], dtype=np.int64)
        if bits.sum() <= machine_bits:
            key[:] = -1  # one machine runs over every text
        self.machines: list[tuple[GlobMachine, np.ndarray, int, int]] = []
        at = 0
        order = np.argsort(key, kind="stable")
        while at < self.n:
            end, used = at, 0
            while end < self.n and (end == at or used + bits[order[end]] <= machine_bits):
                if (key[order[end]] < 0) != (key[order[at]] < 0):
                    break
                used += bits[order[end]]
                end += 1
            members = np.sort(order[at:end])
            machine = GlobMachine([globs[g] for g in members])
            self.machines.append((machine, members, int(key[order[at]]), int(key[order[end - 1]])))
            at = end
        self.keys = np.unique(key[key >= 0])

    @property
    def n_bytes(self) -> int:
        return self.keys.nbytes + sum(m.n_bytes + members.nbytes for m, members, _, _ in self.machines)

    def _keys_held(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, row) of every key that a text holds, by key."""
        part = raw[bounds[0] : bounds[-1]]
        if len(part) < KEY_BYTES or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        gram = np.zeros(len(part) - KEY_BYTES + 1, dtype=np.int64)
        for i in range(KEY_BYTES):
            gram |= part[i : i + len(gram)].astype(np.int64) << (8 * i)
        place = np.minimum(np.searchsorted(self.keys, gram), len(self.keys) - 1)
        at = np.flatnonzero(self.keys[place] == gram)
        row = np.searchsorted(bounds, at + bounds[0], side="right") - 1
        inside = at + bounds[0] + KEY_BYTES <= bounds[row + 1]
        key, row = gram[at[inside]], row[inside]
        order = np.argsort(key, kind="stable")
        return key[order], row[order]

    def first_match(self, texts: pa.Array) -> np.ndarray:
        """Index of the first glob that fits each text, or -1."""
        raw, bounds = text_bytes(texts)
        out = np.full(len(texts), self.n, dtype=np.int64)
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + CHUNK_BYTES, side="right")) - 1)
            hi = min(hi, len(texts))
            key, row = self._keys_held(raw, bounds[lo : hi + 1])
            for machine, members, low, high in self.machines:
                if low < 0:
                    rows = np.arange(lo, hi)
                else:
                    ends = np.searchsorted(key, [low, high + 1])
                    rows = lo + np.unique(row[ends[0] : ends[1]])
                if len(rows):
                    fit = machine.first_match(raw, bounds[rows], bounds[rows + 1] - bounds[rows])
                    hit = fit >= 0
                    out[rows[hit]] = np.minimum(out[rows[hit]], members[fit[hit]])
            lo = hi
        return np.where(out < self.n, out, -1)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for null or without ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    host = F.translate(F.regexp_extract(url, shape, 1), upper, upper.lower())
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, shape, 2), F.lit(""))


def read_globs(globs: DataFrame) -> list[str]:
    """The different globs of a table's column ``glob``, in text order."""
    listed = globs.select(F.col("glob").cast("string").alias("glob")).where("glob <> ''").distinct()
    n_bytes = listed.agg(F.sum(F.octet_length("glob"))).first()[0] or 0
    _check_bound(n_bytes)
    return sorted(r.glob for r in listed.collect())


def _check_bound(n_bytes: int) -> None:
    if n_bytes > MAX_GLOB_BYTES:
        raise ValueError(f"{n_bytes} bytes of globs, more than the {MAX_GLOB_BYTES} that may be broadcast")


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    junk_globs: Sequence[str] | DataFrame = JUNK_GLOBS,
    default: str = "allow",
    url: str = "url",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``glob`` (what matched), which replace columns of those names.

    A rule ``(action, host, path)`` fits its host and all subdomains where the
    path starts with the rule's path. Where no rule fits, a junk glob blocks;
    ``junk_globs`` is a list or a table with a column ``glob``.
    """
    junk = read_globs(junk_globs) if isinstance(junk_globs, DataFrame) else list(junk_globs)
    ranked = sorted(rules, key=lambda r: -len(r.host + r.path))
    globs = [g for r in ranked for g in (f"{r.host}{r.path}**", f"*.{r.host}{r.path}**")] + junk
    _check_bound(sum(len(g.encode()) for g in globs))
    names = [r.host + r.path for r in ranked for _ in range(2)] + [None] * len(junk)
    verdicts = [r.action for r in ranked for _ in range(2)] + ["block"] * len(junk)
    columns = [pa.array(values, pa.string()) for values in (names, verdicts, globs)]
    shared = pages.sparkSession.sparkContext.broadcast((GlobSet(globs), columns))

    @F.arrow_udf("rule string, verdict string, glob string")
    def first_fit(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machines, values = shared.value
        for canonical in batches:
            fit = machines.first_match(canonical)
            place = pa.array(fit, pa.int64(), mask=fit < 0)
            yield pa.StructArray.from_arrays([v.take(place) for v in values], ["rule", "verdict", "glob"])

    host, path = host_and_path(F.col(url))
    outputs = ("host", "path", "rule", "verdict", "glob")
    kept = [c for c in pages.columns if c.lower() not in outputs]
    split = pages.withColumn("__host", host).withColumn("__path", path)
    fitted = split.withColumn("__fit", first_fit(F.concat("__host", "__path")))
    return fitted.select(
        *kept,
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__fit.rule").alias("rule"),
        F.coalesce("__fit.verdict", F.lit(default)).alias("verdict"),
        F.col("__fit.glob").alias("glob"),
    )


def url_report(pages: DataFrame) -> DataFrame:
    return filter_urls(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")

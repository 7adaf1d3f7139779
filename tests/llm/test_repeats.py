"""Repeated passages against all windows by brute force, the suffix order, and edge rows."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from marquee.llm import repeats as R
from marquee.llm import suffixes as S

SCHEMA = "doc_id bigint, text string, kept string, n_spans string, d1 string, key string, begin string"


def removed(texts, span):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of every text."""
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + span] for b in data for i in range(len(b) - span + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        rest = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


def check(spark, texts, span=R.SPAN, **limits):
    df = spark.createDataFrame([(i, t, "k", "n", "d", "k", "b") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in R.repeats_report(df, span, **limits).collect())
    assert got == [(i, *want) for i, want in enumerate(removed(texts, span))]
    return df


def corpus(seed):
    rng = random.Random(seed)

    def prose(n):
        return " ".join(rng.choice("the of and a wörd text über data 東京 ßx q\0z".split()) + str(rng.randint(0, 99)) for _ in range(n))

    shared, long = prose(90), prose(300)
    texts = [prose(rng.randint(0, 150)) for _ in range(20)]
    texts += [prose(rng.randint(0, 60)) + shared + prose(rng.randint(0, 60)) for _ in range(12)]
    texts += [long, long, long[:700], "x" + long[3:], long + prose(30) + long[500:1100], long[:300] + "?" + long[301:]]
    texts += ["", None, "a", "é" * 199, "é" * 200, "ab" * 500, "b" * 399, "b" * 400, "c" * 401, shared[:399], shared[1:401], "y" * 399 + "z"]
    return texts


def test_whole_texts_against_brute_force(spark):
    df = check(spark, corpus(1))
    out = R.without_repeats(df)
    assert set(df.columns) - {"kept", "n_spans"} < set(out.columns) and out.columns.count("kept") == 1
    want = removed(corpus(1), R.SPAN)
    for r in out.collect():
        assert r.kept is None if r.text is None else hashlib.sha256(r.kept).hexdigest() == want[r.doc_id][3]
        assert (r.n_bytes, r.n_removed, r.n_spans) == want[r.doc_id][:3]


@pytest.mark.parametrize("group_bytes", [0, 3000])
def test_large_keys_are_split_exactly(spark, group_bytes):
    """One passage, ends cut off at will, in many surroundings that partly agree."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(520))
    heads = ["".join(rng.choice("uvwxyz ") for _ in range(300)) for _ in range(3)]
    texts = [rng.choice(heads)[rng.randint(0, 250) :] + passage[rng.randint(0, 60) : 520 - rng.randint(0, 60)] + rng.choice(heads)[: rng.randint(0, 300)] for _ in range(40)]
    texts += ["ab" * 400, "ba" * 300, "q" * 900]
    check(spark, texts, group_bytes=group_bytes, bucket_bytes=4000)


def test_blocks_do_not_matter(spark, monkeypatch):
    texts = corpus(3)[-25:]
    df = spark.createDataFrame([(i, t, "", "", "", "", "") for i, t in enumerate(texts)], SCHEMA)
    import pyarrow as pa

    whole = {}
    for block in (1 << 18, 777):
        monkeypatch.setattr(R, "BLOCK", block)
        cut = R._by_least_hash(R.SPAN)
        data = pa.array([t.encode() for t in texts if t], pa.binary())
        n = len(data)
        batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(n)), pa.array([0] * n), pa.array([False] * n), data], names=["d1", "d2", "base", "known", "bytes"])
        rows = pa.Table.from_batches(list(cut([batch]))).to_pylist()
        whole[block] = sorted((r["d1"], r["start"] + k, r["key"]) for r in rows for k in range(r["n"]))
    assert whole[777] == whole[1 << 18]
    assert df.count() == len(texts)


def test_a_third_of_all_rows_are_copies_and_no_rows(spark):
    rng = random.Random(4)
    one = "".join(rng.choice("abcde fg") for _ in range(900))
    check(spark, [one if i % 3 == 0 else one[:200] + str(i) * 150 for i in range(90)])
    empty = spark.createDataFrame([], SCHEMA)
    assert R.repeats_report(empty).count() == 0 and R.without_repeats(empty).count() == 0


def test_a_key_with_very_many_pieces_is_dealt_over_tasks(spark):
    """One key on 2,000 of 3,000 different pieces: the join that gives its size to its pieces is split."""
    rows = [(i, i, 0, False, 0, 10, 7 if i < 2000 else i // 2, i * 104729, i, False) for i in range(3000)]
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        live = R._live_pieces(spark.createDataFrame(rows, R._PIECES).repartition(16), 400, 5000)
        got = {r.s2: (r.key, r.one_d1, r.group_size, r.twice, r.hot) for r in live.collect()}
        plan = live._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == {i: (7, i, 2000 * 409, False, True) if i < 2000 else (i // 2, i, 2 * 409, False, False) for i in range(3000)}
    assert "skew=true" in plan.split("== Initial Plan ==")[0]


def test_suffix_order_and_common_prefixes():
    rng = np.random.default_rng(0)
    for trial in range(120):
        n, letters = int(rng.integers(0, 90)), int(rng.integers(1, 5))
        data = rng.integers(0, letters, n).astype(np.uint8)
        if trial % 3 == 0 and n:
            data = np.repeat(data, rng.integers(1, 6, n))
        b, depth = data.tobytes(), 400
        words = S.big_endian_words(data, depth)
        order = S.suffix_order(data, words, depth)
        assert sorted(order.tolist()) == list(range(len(b)))
        tails = [b[i:] + bytes(depth - len(b) + i) for i in order]
        assert tails == sorted(tails)
        for short in (3, 8, 11):
            usable = np.arange(len(b)) + short <= len(b)
            seen = collections.Counter(b[i : i + short] for i in range(len(b) - short + 1))
            assert S.repeated(data, usable, short).tolist() == [bool(u) and seen[b[i : i + short]] > 1 for i, u in enumerate(usable)]
            common = S.common_prefixes(words, order[:-1], order[1:], short)
            for k, (i, j) in enumerate(zip(order[:-1], order[1:], strict=True)):
                x, y = b[i:] + bytes(short), b[j:] + bytes(short)
                assert common[k] == next((m for m in range(short) if x[m] != y[m]), short)

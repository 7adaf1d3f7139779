"""Mixing against repeated sharing and a sorted list, and edge rows."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

import brute as B
from marquee.llm import mixing as M

SCHEMA = "doc_id bigint, source string, text string, n_chars bigint, size string, target string, mix string"


def rows(n=300, seed=3):
    rng = random.Random(seed)
    data = []
    for k in range(n):
        source = rng.choice(["a", "b", "B", "é", None, "hot", "hot", "hot"])
        text = " \n".join(["wörd"] * rng.randint(0, 60)) + " "
        data.append((k, source, text, len(text), "s", "t", "m"))
    return data + [(None, "a", "one two", 7, "", "", ""), (900, "null", None, None, "", "", ""), (901, "empty", "", 0, "", "", "")]


def test_report_against_brute_force(spark):
    data = rows()
    data += [data[0], data[0], data[1]]
    got = M.mix_report(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == len(data)
    sizes = defaultdict(int)
    for r in data:
        sizes[r[1]] += len(B.words(r[2]))
    want = B.targets(dict(sizes))
    source_of = {r[0]: r[1] for r in data}
    taken = defaultdict(int)
    for r in got:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 3
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_reruns_and_layout_agree(spark):
    df = spark.createDataFrame(rows(120, 4), SCHEMA)
    one = sorted(map(tuple, M.mix_report(df).collect()), key=str)
    assert one == sorted(map(tuple, M.mix_report(df.repartition(7)).collect()), key=str)


def test_mixed_documents_take_exactly_the_words_of_the_report(spark):
    df = spark.createDataFrame(rows(200, 5), SCHEMA)
    taken = {r.doc_id: r.taken for r in M.mix_report(df).collect()}
    out = M.mix_sources(df)
    assert out.dtypes == df.dtypes and {r.mix for r in out.collect()} <= {"m", ""}
    words, whole = defaultdict(int), {r.doc_id: r.text for r in df.collect()}
    for r in out.collect():
        words[r.doc_id] += len(B.words(r.text))
        assert whole[r.doc_id].startswith(r.text) and r.n_chars == (len(r.text) if r.doc_id is not None else 7)
    assert {k: v for k, v in taken.items() if v} == dict(words)


def test_empty_table_and_wordless_sources(spark):
    assert M.mix_report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert M.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    none = M.mix_report(spark.createDataFrame([(1, "a", None, 0, "", "", "")], SCHEMA)).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in none] == [(0, 0, 0.0, 0)]


def test_first_words_keeps_white_space_and_long_texts(spark):
    from pyspark.sql import functions as F

    long = " a\n\tbé  c" * 20000
    df = spark.createDataFrame([(long, 2), (long, 50000), ("x", 1)], "text string, n int")
    got = [r[0] for r in df.select(M.first_words(F.col("text"), F.col("n"))).collect()]
    assert got[0] == " a\n\tbé" and len(B.words(got[1])) == 50000 and long.startswith(got[1]) and got[2] == "x"

"""Benchmark windows against brute force, blocks, span removal and edge rows."""

from __future__ import annotations

import random

import brute as B
from marquee.llm import decontam as D

SCHEMA = "doc_id bigint, text string, leak string, n_chars bigint"
ITEMS = "item_id bigint, text string, window string"


def cases(seed=1):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(30)] + ["É", "ñ9", "A"]

    def said(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))

    items = [(k, said(rng.choice([0, 1, 2, 3, 9, 10, 11, 25])), "x") for k in range(12)]
    items += [(None, said(12), "x"), (50, None, "x"), (51, "", "x"), (52, items[3][1], "x"), items[4]]
    docs = []
    for k in range(60):
        text = said(rng.randint(0, 40))
        if k % 3 == 0:
            text += " . " + rng.choice(items[:13])[1].upper() + " ! " + said(5)
        docs.append((k, text, "clash", len(text)))
    return docs + [(None, "none", "", 4), (100, None, "", None), (101, "", "", 0), docs[0]], items


def test_report_against_brute_force(spark):
    docs, items = cases()
    got = D.leak_report(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS)).collect()
    pairs = [(i, t) for i, t, _ in items]
    want = sorted((str(d), *B.leaks(t, pairs)) for d, t, *_ in docs)
    assert len(got) == len(docs)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got) == [
        (d, n, h, len(ids), sha) for d, n, h, ids, sha in want
    ]
    assert all(r.contaminated == (r.n_hit > 0) for r in got) and any(r.contaminated for r in got)


def test_many_blocks_give_the_same(spark, monkeypatch):
    docs, items = cases(2)
    df, bench = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS)
    one = sorted(map(tuple, D.leak_report(df, bench).collect()), key=str)
    monkeypatch.setattr(D, "BLOCK_BYTES", 500)
    assert len(list(D._blocks(bench, 10))) > 2
    assert sorted(map(tuple, D.leak_report(df, bench).collect()), key=str) == one


def test_items_of_a_hot_window_lie_in_many_blocks(spark, monkeypatch):
    shared = "one two three four five six seven eight nine ten"
    items = [(k, f"{shared} own{k} tail{k}", "x") for k in range(300)] + [(None, shared, "x"), (7, shared, "x")]
    docs = [(1, f"He said {shared} and left", "", 0), (2, f"two {shared} own5 x", "", 0), (3, "one two three", "", 0)]
    df, bench = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS)
    assert D.windows(bench).where(f"window = '{shared}'").count() == 301
    monkeypatch.setattr(D, "BLOCK_BYTES", 50_000)
    holding = [shared.encode() in block for block, _ in D._blocks(bench, 10)]
    assert len(holding) > 2 and all(holding)
    got = {r.doc_id: tuple(r)[1:5] for r in D.leak_report(df, bench).collect()}
    pairs = [(i, t) for i, t, _ in items]
    for d, text, *_ in docs:
        n_words, n_hit, ids, sha = B.leaks(text, pairs)
        assert got[d] == (n_words, n_hit, len(ids), sha)
    assert got[1][2] == 300


def test_many_blocks_cut_the_same_spans_with_one_python_worker(spark, monkeypatch):
    docs, items = cases(5)
    df, bench = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS)
    one = sorted(map(tuple, D.decontaminate(df, bench, remove="spans").collect()), key=str)
    monkeypatch.setattr(D, "BLOCK_BYTES", 150)
    assert len(list(D._blocks(bench, 10))) > 8
    out = D.decontaminate(df, bench, remove="spans")
    assert sorted(map(tuple, out.collect()), key=str) == one
    found = D.scan(df, bench).select("doc_id", "leak")
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_removal(spark):
    docs, items = cases(3)
    df, bench = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS)
    pairs = [(i, t) for i, t, _ in items]
    clean = D.decontaminate(df, bench)
    assert clean.schema == df.schema and {r.leak for r in clean.collect()} <= {"clash", ""}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, t, *_ in docs if not B.leaks(t, pairs)[1])
    cut = D.decontaminate(df, bench, remove="spans")
    assert cut.columns == df.columns and cut.count() == len(docs)
    whole = {d: t for d, t, *_ in docs}
    for r in cut.collect():
        n_words, n_hit, _, _ = B.leaks(whole[r.doc_id], pairs)
        if not n_hit:
            assert r.text == whole[r.doc_id]
        else:
            assert len(B.ALNUM.findall(r.text.translate(B.LOWER))) == n_words - n_hit and r.n_chars == len(r.text)


def test_empty_tables(spark):
    docs, items = cases(4)
    df, bench = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS)
    none = spark.createDataFrame([], ITEMS)
    assert not any(r.contaminated or r.n_items for r in D.leak_report(df, none).collect())
    assert D.leak_report(spark.createDataFrame([], SCHEMA), bench).count() == 0
    assert D.decontaminate(df, none).count() == len(docs)

"""Near duplicates against all pairs by brute force, sketches, components and edge rows."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute as B
import corpus_pipeline
from marquee.llm import components as C
from marquee.llm import near_dups as N

SCHEMA = "doc_id bigint, text string, n string, rep string, key string, component_id string, kept string"


def family(seed, sizes, length=120):
    """Groups of copies with a few words changed each, so that pairs lie on both sides of the limit."""
    rng = random.Random(seed)
    texts = []
    for g, size in enumerate(sizes):
        base = [f"g{g}w{rng.randint(0, 900)}" for _ in range(length)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6])):
                copy[rng.randrange(length)] = f"x{rng.randint(0, 9999)}"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return dict(enumerate(texts))


def judged(spark, data):
    df = spark.createDataFrame([(i, t, "", "", "", "", "") for i, t in data], SCHEMA)
    return N.near_duplicates(df.repartition(3)).collect()


def test_groups_and_edge_rows_against_brute_force(spark):
    docs = family(1, [30, 20, 12, 3, 2, 1, 1])
    n = len(docs)
    docs |= {n: "", n + 1: None, n + 2: "One two", n + 3: "one\ttwo", n + 4: "one two three", n + 5: " \n", n + 6: "A b c d e", n + 7: "a b c d e"}
    data = [*docs.items(), (None, docs[0]), (n + 2, "One two")]
    want = B.components(docs)
    got = judged(spark, data)
    assert len(got) == len(data)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
            continue
        assert r.n_shingles == len(B.shingles(docs[r.doc_id]))
        assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == want[r.doc_id])


def test_borderline_family_needs_more_than_leaders(spark):
    docs = family(7, [60], length=60)
    got = {r.doc_id: r.component_id for r in judged(spark, docs.items())}
    assert got == B.components(docs)


@pytest.mark.parametrize("size", [60, 180])
def test_boilerplate_below_the_limit_is_not_compared(spark, monkeypatch, size):
    """Texts of 200 common and 24 own words (similarity 0.8), some with a near copy: comparisons grow no faster than rows."""
    common = [f"c{k}" for k in range(200)]
    texts = [common + [f"own{d}x{k}" for k in range(24)] for d in range(size)]
    texts += [["changed", *texts[d][1:]] for d in range(0, size, 6)]
    docs = {i: " ".join(t) for i, t in enumerate(texts)}
    compared, parts = [], N._compared

    def counted(reached):
        for outside, others in parts(reached):
            compared.append(outside.select("key", "rep").join(others.select("key"), "key").count())
        return parts(reached)

    monkeypatch.setattr(N, "_compared", counted)
    assert {r.doc_id: r.component_id for r in judged(spark, docs.items())} == B.components(docs)
    assert compared and sum(compared) <= 32 * len(docs)


def test_a_third_of_all_rows_in_one_group(spark):
    docs = {i: ("same text of one large group " * 3 if i % 3 == 0 else f"word{i} " * 7 + str(i)) for i in range(900)}
    got = judged(spark, docs.items())
    assert sum(r.kept for r in got) == 601
    assert {r.component_id for r in got if r.doc_id % 3 == 0} == {0}


def test_dropping_keeps_columns_and_one_of_each_group(spark):
    docs = family(3, [6, 4, 1])
    df = spark.createDataFrame([(i, t, "n", "r", "k", "c", "x") for i, t in docs.items()], SCHEMA)
    out = N.drop_near_copies(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == set(B.components(docs).values())


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert N.near_duplicates(empty).count() == 0
    assert N.drop_near_copies(empty).count() == 0


@pytest.mark.parametrize("size", [30, 500, 1000, 1150, 4000])
def test_sketch_limit_lets_similar_pairs_pass(spark, size):
    rng = np.random.default_rng(4)
    seen, far = [], []
    for similar, out in ((0.851, seen), (0.6, far)):
        for _ in range(60):
            both = int(np.ceil(2 * size * similar / (1 + similar)))
            own = rng.integers(0, 2**63, 2 * (size - both), dtype=np.uint64)
            a = rng.integers(0, 2**63, both, dtype=np.uint64)
            sets = np.concatenate([a, own[: size - both], a, own[size - both :]])
            s = N._odd_sketches(sets, np.array([0, size]))
            out.append(sum(int(x).bit_count() for x in (s[0] ^ s[1]).view(np.uint64)))
    limit = spark.range(1).select(N.max_differing(F.lit(size), F.lit(size))).first()[0]
    assert max(seen) <= limit < min(far)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 301), (301, 300)]
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    got = {r.node: r.component for r in C.components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {300: 300, 301: 300}
    assert C.components(df.where("false")).count() == 0


def test_words_of_odd_bytes():
    from marquee.llm import words as W

    texts = ["", None, " a b\tc ", "\x1fx\x0b\x0cy\r\n", "é" * 70000, "z"]
    rows = []
    for chunk in W.chunks(pa.array(texts), W.not_space(), W.lower_ascii(), chunk_bytes=64):
        for r in range(chunk.n_rows):
            lo, hi = chunk.first_word[r], chunk.first_word[r + 1]
            rows.append([chunk.data[chunk.start[k] : chunk.end[k]].tobytes().decode() for k in range(lo, hi)])
    assert rows == [B.words((t or "").translate(B.LOWER)) for t in texts]


def links_at(docs, high):
    sets = {i: B.shingles(t) for i, t in docs.items()}
    return {(i, j) for i in docs for j in docs if i < j and 100 * len(sets[i] & sets[j]) >= high * len(sets[i] | sets[j])}


def test_the_stage_drops_copies_from_a_similarity_of_80_on(spark):
    """Pairs of 0.8 exactly, and between 0.8 and 0.85, go in the stage and stay in op8."""
    docs = {}
    for g, changed in enumerate((1, 2, 3, 4)):  # of 49 words, 45 shingles: each change takes 5
        base = [f"g{g}w{k}" for k in range(49)]
        docs[2 * g] = " ".join(base)
        docs[2 * g + 1] = " ".join(f"new{k}" if k < changed else w for k, w in enumerate(base))
    docs |= {10: " ".join(f"h{k}" for k in range(49)), 11: " ".join("x" if k == 20 else f"h{k}" for k in range(49))}
    assert links_at(docs, 80) == links_at(docs, 85) | {(6, 7), (10, 11)}
    df = spark.createDataFrame([(i, t, "t", "s", len(t)) for i, t in docs.items()], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    stage = corpus_pipeline.near_dedup_stage(spark, df, "")
    dropped = lambda links: {j for _, j in links}
    assert set(docs) - {r.doc_id for r in stage.collect()} == dropped(links_at(docs, 80))
    assert {r.doc_id for r in N.near_duplicates(df).where("not kept").collect()} == dropped(links_at(docs, 85))


def test_components_are_contracted_again_only_for_new_links(spark, monkeypatch):
    calls = []

    def counted(edges):
        calls.append(1)
        return C.components(edges)

    monkeypatch.setattr(N, "components", counted)
    # copies with changed words on both sides of the limit
    docs = family(11, [6, 6, 6, 1, 1], length=100)
    got = {r.doc_id: r.component_id for r in judged(spark, docs.items())}
    assert got == B.components(docs)
    links = spark.createDataFrame([(1, 2)], "u long, v long")
    found = C.components(links)
    calls.clear()
    assert N._extended(links, found, links.limit(0)) == (links, found) and not calls
    _, more = N._extended(links, found, spark.createDataFrame([(2, 3), (7, 8)], "u long, v long"))
    assert sorted((r.node, r.component) for r in more.collect()) == [(1, 1), (2, 1), (3, 1), (7, 7), (8, 7)] and calls == [1]


def test_a_node_meets_its_edges_without_more_rows_than_edges(spark):
    pairs = [(2 * k, 2 * k + 1) for k in range(50)]
    edges = spark.createDataFrame(pairs, "u long, v long")
    df = C._with_least(edges)
    assert sorted((r.u, r.v, r.m) for r in df.collect()) == [(u, v, u) for u, v in pairs]
    assert generated_rows(df) <= len(pairs)


def generated_rows(df) -> int:
    """Rows that the plan's generator made."""
    metrics, nodes = [], [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            nodes.append(node.plan())
        if node.nodeName() == "Generate":
            metrics.append(node.metrics().apply("numOutputRows").value())
        nodes += [node.children().apply(k) for k in range(node.children().size())]
    assert metrics
    return sum(metrics)

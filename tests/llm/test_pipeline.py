"""Every stage of the pipeline against brute force on its own input, and the registration."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline as P
import pytest

import brute as B
from marquee.llm import catalog, quality_rules
from marquee.session import materialized
from tables import sf_dir  # noqa: F401

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frames = [docs]
    for name, stage in P.STAGES:
        frames.append(materialized(stage(spark, frames[-1], sf_dir), f"test-{name}"))
    return frames


def test_stage_names_and_columns(steps):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_dedup", "decontamination", "mixing", "sharding"]
    assert all(f.columns == steps[0].columns for f in steps[1:5])
    assert steps[5].columns == [*steps[0].columns, "vslot", "shard"]


def test_quality_stage(spark, sf_dir, steps):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality_rules.judge(steps[0], quality_rules.train_rules(steps[0], labels)).collect()
    kept = set()
    for r in judged:
        n_words, _, _, _, repeated = B.base_counts(r.text)
        if n_words >= 50 and 2 * repeated <= n_words and r.score >= 0.5:
            kept.add(tuple(r[c] for c in steps[0].columns))
    assert set(map(tuple, steps[1].collect())) == kept and 0 < len(kept) < len(judged)


def test_near_dedup_stage(steps):
    before = {r.doc_id: r for r in steps[1].collect()}
    first = B.components({k: r.text for k, r in before.items()}, percent=80)
    assert {tuple(r) for r in steps[2].collect()} == {tuple(r) for k, r in before.items() if first[k] == k}


def test_decontamination_stage(spark, sf_dir, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {tuple(r) for r in steps[2].collect() if not B.leaks(r.text, items)[1]}
    assert {tuple(r) for r in steps[3].collect()} == want and 0 < len(want) < steps[2].count()


def test_mixing_stage(steps):
    before = {r.doc_id: r for r in steps[3].collect()}
    sizes = defaultdict(int)
    for r in before.values():
        sizes[r.source] += len(B.words(r.text))
    got, copies = Counter(), Counter()
    for r in steps[4].collect():
        old = before[r.doc_id]
        assert old.text.startswith(r.text) and (r.lang, r.source) == (old.lang, old.source)
        got[r.source] += len(B.words(r.text))
        copies[r.doc_id] += 1
    assert max(copies.values()) == 2
    assert {s: got[s] for s in sizes} == {s: int(t + 1e-6) for s, t in B.targets(sizes).items()}


def test_sharding_stage(steps):
    before = Counter(map(tuple, steps[4].collect()))
    rows = steps[5].collect()
    assert Counter(tuple(r)[:5] for r in rows) == before
    shard_of = {}
    load = defaultdict(int)
    for r in rows:
        assert shard_of.setdefault(r.vslot, r.shard) == r.shard and 0 <= r.shard < P.N_SHARDS
        load[r.shard] += len((r.text or "").encode()) + 1
    per_slot = defaultdict(int)
    for r in rows:
        per_slot[r.vslot] += len((r.text or "").encode()) + 1
    assert max(load.values()) - min(load.values()) <= max(per_slot.values())


def test_run_returns_the_last_stage(spark, sf_dir, steps):
    assert catalog.queries()["pipeline"] is P.run and P.ORACLE_SQL is None
    got = P.run(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps[5].collect()))


def test_stages_on_edge_rows_and_an_empty_table(spark, sf_dir):
    rows = [(1, None, None, None, None), (2, "", "en", None, 0), (None, "no id " * 60, "en", "s", 360), (3, "w " * 40, "en", None, 80), (3, "w " * 40, "en", None, 80)]
    rows += [(k, " ".join(f"a{k}b{i}" for i in range(80)), "en", "s" if k % 2 else None, 400) for k in range(10, 20)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, SCHEMA)
        for name, stage in P.STAGES:
            alone = stage(spark, spark.createDataFrame(data, SCHEMA), sf_dir)
            assert alone.count() >= 0, name
            docs = materialized(stage(spark, docs, sf_dir), f"edge-{name}")
        assert (docs.count() > 0) == bool(data)

"""Quality rules, boosted trees and the positive-unlabelled classifier."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import brute as B
from marquee.llm import docstats, labelled, pu, quality_rules, trees
from tables import sf_dir  # noqa: F401

SCHEMA = "doc_id bigint, text string, score string, kept string, quality string, n_words string"
LABELS = "doc_id bigint, quality int, text string"


def corpus(n=900, seed=2):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("th", "er", "on", "an", "re", "he") for b in ("ing", "ed", "at", "or", "es", "en", "al")]
    docs, labels = [], []
    for k in range(n):
        words = [rng.choice(vocab) + str(rng.randint(0, 40)) * (rng.random() < 0.5) for _ in range(rng.randint(60, 200))]
        bad = rng.random() < 0.2
        if bad:
            words = [w + rng.choice(["###", "$$$", "&&&"]) for w in words] if k % 2 else words[:1] * len(words)
        docs.append((k, " ".join(words) + ".\n" + words[0], "s", "k", "q", "n"))
        labels.append((k, int(not bad), ""))
    return docs, labels


def edge_rows():
    texts = [None, "", " \n\t", "a b c a b c", "x\nx\nx\n \nx", "#$ é\n#$ é", "word " * 3000, "é" * 50000]
    return [(10_000 + k, t, "", "", "", "") for k, t in enumerate(texts)] + [(None, "no id", "", "", "", "")]


def test_base_counts_against_brute_force(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    texts += [r[1] for r in edge_rows()]
    base, features = docstats.stats(pa.array(texts))
    assert [tuple(b) for b in base.tolist()] == [B.base_counts(t) for t in texts]
    assert np.isfinite(features).all()


def test_rules_report_with_edge_rows(spark):
    docs, labels = corpus()
    rows = docs + edge_rows() + [docs[0]]
    got = quality_rules.rules_report(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels + [(0, None, ""), (None, 1, ""), (5, 7, "")], LABELS)).collect()
    assert len(got) == len(rows)
    text_of = {r[0]: r[1] for r in rows}
    for r in got:
        base = B.base_counts(text_of[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (r.base_failed and r.kept)
    quality = {k: q for k, q, _ in labels}
    right = [r.kept == bool(quality[r.doc_id]) for r in got if r.doc_id in quality]
    assert sum(right) / len(right) > 0.97


def test_keeping_good_rows_without_labels_and_empty(spark):
    docs, _ = corpus(60)
    none = spark.createDataFrame([], LABELS)
    df = spark.createDataFrame(docs + edge_rows(), SCHEMA)
    out = quality_rules.keep_good(df, none)
    assert out.columns == df.columns
    fine = {d for d, t, *_ in docs + edge_rows() if B.base_counts(t)[0] >= 50 and 2 * B.base_counts(t)[4] <= B.base_counts(t)[0]}
    assert {r.doc_id for r in out.collect()} == fine
    assert quality_rules.rules_report(df.where("false"), none).count() == 0


def test_labels_of_one_class_leave_the_verdict_to_the_limits(spark):
    docs, _ = corpus(60)
    df = spark.createDataFrame(docs + edge_rows(), SCHEMA)
    fine = {d for d, t, *_ in docs + edge_rows() if B.base_counts(t)[0] >= 50 and 2 * B.base_counts(t)[4] <= B.base_counts(t)[0]}
    for quality in (0, 1):
        labels = spark.createDataFrame([(d, quality, "") for d, *_ in docs], LABELS)
        assert {r.doc_id for r in quality_rules.keep_good(df, labels).collect()} == fine


def test_an_id_on_very_many_rows_is_one_row_of_the_sample(spark):
    docs, labels = corpus(150)
    hot = [(7, f"{docs[7][1]} {k}", "s", "k", "q", "n") for k in range(400)]
    df = spark.createDataFrame(docs + hot, SCHEMA)
    sample = labelled.hash_sample(spark.createDataFrame(labels, LABELS).select("doc_id", F.col("quality").alias("y")), 150)
    x, other = labelled.sample_features(df, sample)
    assert len(x) == 150 and other["y"].sum() == sum(q for _, q, _ in labels)


def test_trees_keep_monotone_and_match_a_walk_of_the_nodes():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 4))
    y = ((x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=800)) > 0).astype(float)
    forest = trees.train(x, y, {0: 1, 1: -1}, n_trees=20)
    probe = np.repeat(x[:50], 40, axis=0)
    for f, sign in ((0, 1), (1, -1)):
        moved = probe.copy()
        moved[:, f] = np.tile(np.linspace(-3, 3, 40), 50)
        steps = np.diff(forest.margin(moved).reshape(50, 40), axis=1) * sign
        assert (steps >= -1e-9).all()

    def walk(row):
        total = forest.base
        for at in forest.roots:
            while np.isfinite(forest.threshold[at]):
                at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
            total += forest.value[at]
        return total

    assert np.allclose(forest.margin(x[:60]), [walk(r) for r in x[:60]])
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.9


def test_positive_unlabelled_scores(spark):
    docs, labels = corpus(1500, 6)
    df = spark.createDataFrame(docs + edge_rows(), SCHEMA)
    marks = spark.createDataFrame(labels, LABELS)
    got = pu.quality_report(df, marks).collect()
    assert len(got) == len(docs) + len(edge_rows())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    quality = {k: q for k, q, _ in labels}
    right = [r.predicted == quality[r.doc_id] for r in got if r.held_out and r.doc_id in quality]
    assert len(right) > 300 and sum(right) / len(right) > 0.93
    # held-out labels and all negative labels are never read
    turned = marks.withColumn("quality", F.when(labelled.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    positives = turned.where((F.col("quality") == 1) | labelled.held_out(F.col("doc_id")))
    assert [r.score for r in pu.quality_report(df, positives).orderBy("doc_id").collect()] == [
        r.score for r in sorted(got, key=lambda r: -1 if r.doc_id is None else r.doc_id)
    ]


def test_positive_unlabelled_without_positives_or_rows(spark):
    docs, labels = corpus(30)
    df = spark.createDataFrame(docs, SCHEMA)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in pu.quality_report(df, none).collect()} == {0.5}
    assert pu.quality_report(df.where("false"), none).count() == 0


def test_prior_estimate_on_mixed_normals():
    rng = np.random.default_rng(8)
    pos = rng.normal(3, 1, 4000)
    unl = np.concatenate([rng.normal(3, 1, 2800), rng.normal(-3, 1, 1200)])
    levels = pu.score_levels(pos)
    above = np.array([(unl >= v).mean() for v in levels])
    assert abs(pu.estimate_prior(pos, above, levels, len(unl)) - 0.7) < 0.05


def test_positive_unlabelled_fit_against_plain_python(spark):
    """Bins, prior and scores of 300 documents, with the risk and its slope summed row by row."""
    docs, labels = corpus(300, 11)
    model, prior = pu.train_quality(spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(labels, LABELS))
    free = [k for k, *_ in docs if zlib.crc32(str(k).encode()) % 3 != 1]
    x = docstats.stats(pa.array([docs[k][1] for k in free]))[1]
    trusted = np.array([labels[k][1] == 1 for k in free])
    for f, edges in enumerate(model.edges):
        cells = sorted(math.floor(math.log1p(v) * pu.GRID) for v in x[:, f])
        want = {cells[math.ceil(q * len(cells) / pu.BINS) - 1] for q in range(1, pu.BINS)} - {cells[-1]}
        assert set(edges) == want
    rows = [[sum(e < math.floor(math.log1p(v) * pu.GRID) for e in edges) for v, edges in zip(r, model.edges, strict=True)] for r in x]
    z = [model.bias + sum(w[b] for w, b in zip(model.weights, r, strict=True)) for r in rows]
    assert np.allclose(z, model.margin(x))
    soft = lambda v: math.log1p(math.exp(-abs(v))) + max(v, 0.0)
    pos = [v for v, t in zip(z, trusted, strict=True) if t]
    negative = sum(map(soft, z)) / len(z) - prior * sum(map(soft, pos)) / len(pos)
    assert negative >= 0 and 0.5 < prior < 0.98
    if negative > 1e-3:  # a free minimum: no weight can lower the risk
        for f, w in enumerate(model.weights):
            for b in range(len(w)):
                down = sum(1 / (1 + math.exp(-v)) for v, r in zip(z, rows, strict=True) if r[f] == b) / len(z)
                up = sum(r[f] == b for r, t in zip(rows, trusted, strict=True) if t) / len(pos)
                assert abs(down - prior * up + pu.RIDGE * w[b]) < 2e-3

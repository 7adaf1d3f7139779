"""Bigram models against a plain Python model, and edge rows."""

from __future__ import annotations

import collections
import math
import random
import re

import pytest

import brute as B
from marquee.llm import lm_scoring as L

SCHEMA = "doc_id bigint, text string, score string, n_words string"
LABELS = "doc_id bigint, quality int"


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(40)] + ["É", "ñandú", "co-op", "don't", "LONGWORDxyz", "x1"]
    docs = [(k, rng.choice([" ", "\n\t"]).join(rng.choice(vocab[: 10 + k % 36]) for _ in range(rng.randint(0, 60))), "", "") for k in range(n)]
    docs += [(500, None, "", ""), (501, "", "", ""), (502, " \n ", "", ""), (None, "w1 w2", "", ""), docs[3], (503, "w1 " * 5000, "", "")]
    labels = [(k, int(k % 3 == 0)) for k in range(n)] + [(3, 0), (3, 1), (None, 1), (999, 1)]
    return docs, labels


def plain(docs, labels, part):
    trusted = {d for d, q in labels if q == 1 and d is not None}
    texts = [(d, B.words((t or "").translate(B.LOWER))) for d, t, *_ in docs]
    models = [collections.Counter(w for d, ws in texts if keep(d) for w in ws) for keep in (lambda d: d in trusted, lambda d: True)]
    counts = models[1]
    vocab = {w for w, n in counts.items() if n * part >= sum(counts.values())}

    def symbol(w):
        if w in vocab:
            return w
        return min((len(w) - 1) // 4, 3) + 4 * bool(re.search(r"[!-@\[-`{-~]", w))

    rows = [(d, ws, [symbol(w) for w in ws]) for d, ws in texts]
    n = len(vocab) + 8
    rare = collections.defaultdict(list)
    for w in counts:
        if w not in vocab:
            rare[symbol(w)].append(w)
    losses = []
    for keep, words in zip((lambda d: d in trusted, lambda d: True), models, strict=True):
        pairs = collections.Counter((h, s) for d, _, ss in rows if keep(d) for h, s in zip([None, *ss], ss, strict=False))
        hist, uni = collections.Counter(), collections.Counter()
        for (h, s), c in pairs.items():
            hist[h] += c
            uni[s] += c
        total = sum(uni.values())
        within = {w: -math.log((words[w] + 0.5) / sum(words[v] + 0.5 for v in vs)) for vs in rare.values() for w in vs}

        def loss(h, s, w, pairs=pairs, hist=hist, uni=uni, total=total, within=within):
            u = (uni[s] + 0.5) / (total + 0.5 * n)
            return -math.log(0.75 * pairs[h, s] / hist[h] + 0.25 * u if hist[h] else u) + within.get(w, 0.0)

        losses.append(loss)
    return [
        (d, len(ws), *[sum(f(h, s, w) for h, s, w in zip([None, *ss], ss, ws, strict=False)) / len(ws) if ws else None for f in losses])
        for d, ws, ss in rows
    ]


@pytest.mark.parametrize(("part", "hot"), [(3, 4), (40, 100), (40, 40), (1024, 1 << 18), (10**9, 10**9)])
def test_scores_against_plain_python(spark, part, hot):
    """Symbols for no, some and all words; losses of other words broadcast for none, some and all of them."""
    docs, labels = corpus()
    df, marks = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)
    scored = L.score_documents(df.repartition(3), L.train_models(df.repartition(3), marks, part, hot))
    assert scored.columns == ["doc_id", "text", "n_words", "loss_target", "loss_background", "score"]
    got = sorted(((r.doc_id, r.n_words, r.loss_target, r.loss_background, r.score) for r in scored.collect()), key=str)
    want = sorted(plain(docs, labels, part), key=str)
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[1])), sorted(want, key=lambda r: (str(r[0]), r[1])), strict=True):
        assert g[:2] == w[:2]
        if w[1]:
            assert g[2] == pytest.approx(w[2]) and g[3] == pytest.approx(w[3]) and g[4] == pytest.approx(w[2] - w[3])
        else:
            assert g[2:] == (None, None, None)


def test_texts_that_differ_in_rare_words_only_score_differently(spark):
    docs = [(k, "some common words here and there " * 9 + ("goodword" if k % 2 else "evilword"), "", "") for k in range(40)]
    labels = [(k, 1) for k in range(1, 20, 2)]
    model = L.train_models(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS), 20, 20)
    got = {r.doc_id: r.score for r in L.score_documents(spark.createDataFrame(docs, SCHEMA), model).collect()}
    assert max(got[k] for k in got if k % 2) < min(got[k] for k in got if not k % 2)


def test_target_like_documents_score_lower(spark):
    docs = [(k, "good clean words of the target " * 5 if k % 2 else "other noisy stuff from the web " * 5, "", "") for k in range(60)]
    labels = [(k, 1) for k in range(1, 40, 2)]
    got = L.lm_report(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    assert max(r.score for r in got if r.doc_id % 2) < min(r.score for r in got if r.doc_id % 2 == 0)


def test_no_labels_and_empty_table(spark):
    docs, _ = corpus(2, 20)
    none = spark.createDataFrame([], LABELS)
    got = L.lm_report(spark.createDataFrame(docs, SCHEMA), none).collect()
    assert len(got) == len(docs) and all(r.loss_target > 0 for r in got if r.n_words)
    assert L.lm_report(spark.createDataFrame([], SCHEMA), none).count() == 0

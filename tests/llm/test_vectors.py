"""Whitening and centroid clustering against plain versions, and their edge rows."""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from marquee.llm import centroids as K
from marquee.llm import whitening as Q

SCHEMA = "vec_id bigint, embedding array<float>, component string, cluster string, x string, deviation string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", "c", "x", "d") for i, v in rows], SCHEMA).repartition(3)


def odd_vectors(dims):
    """Vectors that are dropped by both operators."""
    one = [0.5] * dims
    return [None, [], [*one[1:], None], [*one[1:], math.nan], [*one[1:], math.inf], [-math.inf, *one[1:]]]


def clustered(rows, k=8, rounds=10):
    """{row number: (cluster, distance)} and the centroids, by comparing all."""
    ints = [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v in rows]
    lowest = sorted(ints, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in lowest[:k]]

    def place():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres)) for _, v in ints]

    for _ in range(rounds):
        of = place()
        for n in range(len(centres)):
            mine = [v for (_, v), (_, c) in zip(ints, of, strict=True) if c == n]
            if mine:
                centres[n] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    return place(), centres


def test_clusters_against_comparing_all_pairs(spark):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(6, 64)) * 4
    rows = [(i, [float(c) for c in (middles[i % 6] + rng.normal(size=64)).astype(np.float32)]) for i in range(150)]
    rows += [(i, list(rows[3][1])) for i in range(150, 220)] + [(3, list(rows[3][1])), (None, list(rows[7][1]))]
    bad = [(500 + n, v) for n, v in enumerate([*odd_vectors(64), [1.0] * 63, [1.0] * 65])]
    got = K.cluster_report(frame(spark, rows + bad)).collect()
    placed, centres = clustered(rows)
    want = sorted((str(i), c, d) for (i, _), (d, c) in zip(rows, placed, strict=True))
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in got) == want
    total = sum(d for d, _ in placed)
    for r in got:
        assert r.inertia == total
        assert r.cluster_inertia == sum(d for d, c in placed if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


def test_fewer_vectors_than_centroids_ties_and_no_rows(spark):
    rows = [(1, [0.0] * 64), (2, [0.0] * 64), (3, [1.0] * 64)]
    got = {r.vec_id: (r.cluster, r.distance) for r in K.cluster_report(frame(spark, rows)).collect()}
    placed, _ = clustered(rows)
    assert got == {i: (c, d) for (i, _), (d, c) in zip(rows, placed, strict=True)}
    assert got[1] == got[2]
    for empty in ([], [(1, None)]):
        out = K.cluster_report(frame(spark, empty))
        assert out.count() == 0 and out.columns[0] == "vec_id"


def test_bounds_leave_out_centroids_and_change_nothing():
    rng = np.random.default_rng(1)
    middles = rng.integers(-4000, 4000, (8, 64))
    x = np.repeat(middles, 40, axis=0) + rng.integers(-50, 50, (320, 64))
    pivots = K.far_apart(x[::7], 12)
    label, best, exact = K.nearest(x, K._distances(x, pivots), middles, pivots)
    all_pairs = ((x[:, None, :] - middles[None]) ** 2).sum(axis=2)
    assert (label == all_pairs.argmin(axis=1)).all() and (best == all_pairs.min(axis=1)).all()
    assert exact.mean() < 2


def test_a_component_too_large_for_exact_distances_is_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        K.cluster_report(frame(spark, [(1, [1e9] * 64)])).collect()


@pytest.mark.parametrize("values", [range(1, 25), [1e6] * 3 + [1.0] * 5 + [1e-6] * 4, [0.0] * 6, [5.0] * 9, [2.0**-k for k in range(30)], [3.0], [1.0, 0.0, 0.0]])
def test_divide_and_conquer_against_known_spectra(values):
    values = np.array(sorted(values, reverse=True), float)
    q, _ = np.linalg.qr(np.random.default_rng(len(values)).standard_normal((len(values), len(values))))
    a = (q * values) @ q.T
    found, vectors = Q.eigen(a)
    size = max(np.abs(values).max(), 1e-300)
    assert np.abs(found - values).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(a @ vectors - vectors * found).max() <= 1e-13 * size * 10


def test_polar_factor_is_the_matrix_sign():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((20, 20)))
    values = np.concatenate((np.logspace(-9, 3, 10), -np.logspace(-8, 2, 10)))
    want = (q * np.sign(values)) @ q.T
    assert np.abs(Q.polar_factor((q * values) @ q.T) - want).max() < 1e-6


def test_whitening_against_a_plain_version(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(200, 24)) * np.linspace(0.3, 3, 24) + rng.normal(size=24)
    base[:, 5] = 2 * base[:, 3]
    rows = [(i, [float(c) for c in v.astype(np.float32)]) for i, v in enumerate(base)]
    rows += [(7, rows[7][1]), (None, rows[1][1])] + [(900 + i, rows[2][1]) for i in range(100)]
    bad = [(500 + n, v) for n, v in enumerate([*odd_vectors(24), [1.0] * 23])]
    got = Q.whiten_report(frame(spark, rows + bad)).collect()
    assert len(got) == len(rows) * 16

    ints = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in rows}
    fit = sorted({tuple(x) for x in ints.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(Fraction(c * n - s, n)) for c, s in zip(x, sums, strict=True)] for x in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    for r in got:
        x, k = ints[r.vec_id], r.component - 1
        assert r.n == n and r.identity_error < 1e-9
        assert r.deviation == sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        assert abs(r.explained - values[k] / values.sum()) < 1e-9 * r.explained
        mine = np.array([c - s / n for c, s in zip(x, sums, strict=True)]) @ axes[:, k] / math.sqrt(values[k])
        assert abs(abs(r.whitened) - abs(mine)) < 1e-6


def test_whitening_of_few_dimensions_one_vector_and_no_rows(spark):
    got = Q.whiten_report(frame(spark, [(1, [0.0, 1.0]), (2, [0.0, 3.0]), (3, [0.0, 3.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, round(abs(r.whitened), 9), r.explained) for r in got) == [
        (1, 1, 2, 1.0, 1.0), (1, 2, 2, 0.0, 0.0), (2, 1, 2, 1.0, 1.0), (2, 2, 2, 0.0, 0.0), (3, 1, 2, 1.0, 1.0), (3, 2, 2, 0.0, 0.0)
    ]
    assert {r.identity_error < 1e-12 for r in got} == {True}
    one = Q.whiten_report(frame(spark, [(1, [0.5, 1.0, 2.0])] * 4)).collect()
    assert len(one) == 12 and {(r.whitened, r.explained, r.deviation, r.identity_error) for r in one} == {(0.0, 0.0, 0, 0.0)}
    for empty in ([], [(1, None)]):
        out = Q.whiten_report(frame(spark, empty))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_beyond_64_bits_stay_exact():
    w = Q.Whitening(10**9 + 7, [(10**9 + 7) * 1_000_000 + 123, (10**9 + 7) * 1_000_003 + 9], np.zeros(2), np.zeros((2, 0)))
    x = np.array([[1_000_500, 999_000], [1_000_000, 1_000_003]])
    want = [sum((w.n * int(c) - s) ** 2 for c, s in zip(row, w.sums, strict=True)) for row in x]
    assert [int(d) for d in w.deviations(x).to_pylist()] == want

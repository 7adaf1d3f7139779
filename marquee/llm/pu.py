"""Quality classifier by positive-unlabelled learning.

Positives are the trusted documents (label 1); everything else is unlabelled
web text. No negative label is read. Three steps:

1. a logistic model tells positives from unlabelled rows of one half of the documents;
2. on the other half, the class prior is the smallest ratio, over score
   thresholds, of the unlabelled share to the positive share above the
   threshold (with a bound for its sampling error); both halves take turns;
3. a logistic model minimises the non-negative unbiased risk
   ``prior * R_pos(+) + max(0, R_unl(-) - prior * R_pos(-))``.

Inputs are document statistics, each cut into quantile bins (an additive
model). Label, language, source and id are never inputs of a score.

The unlabelled side is all documents outside the held-out third: the quantiles
come from exact histograms, and every step of the fit (Newton's method, a few
passes) sums risk, gradient and curvature over a stored table of bin numbers,
one byte per statistic and document. Only those sums, whose size is fixed by
the number of bins, reach the driver. The positives are labelled rows, a bounded
sample of them (``POSITIVES``, lowest id hashes first); scores are given to every
whole text.

Defined cases: a null text scores as an empty one; very long texts count whole;
ids with both labels are not trusted; without positives or unlabelled rows
every score is the prior 0.5; an id on several rows is one positive, and as
many unlabelled rows; repeated documents score alike, and ties in a statistic
share a bin; an input column named like an output is replaced; empty table: no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import docstats, labelled
from marquee.session import materialized

POSITIVES = 10_000
BINS = 10
GRID = 1 << 11  # histogram cells per unit of log(1 + |x|)
STEPS = 40  # most Newton steps; a fit ends when a step changes next to nothing
RIDGE = 1e-2


@dataclass
class Additive:
    """A logistic model that is a sum over binned features."""

    edges: list[np.ndarray]  # last histogram cell of each bin but the highest
    weights: list[np.ndarray]
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        binned = bins(x, self.edges)
        for f, w in enumerate(self.weights):
            out += w[binned[:, f]]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _cells(x: np.ndarray) -> np.ndarray:
    """Histogram cell of a statistic; the order of values is kept."""
    return np.floor(np.sign(x) * np.log1p(np.abs(x)) * GRID).astype(np.int64)


def quantile_edges(features: DataFrame) -> list[np.ndarray]:
    """Upper bin limits per statistic, at the quantiles over all rows of (x) up to the grid's resolution."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = _cells(_matrix(batch["x"]))
                for f in range(cells.shape[1]):
                    cell, n = np.unique(cells[:, f], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), f)), pa.array(cell), pa.array(n)], names=["f", "cell", "n"])

    found = features.select("x").mapInArrow(count, "f bigint, cell bigint, n bigint").groupBy("f", "cell").agg(F.sum("n").alias("n")).toArrow()
    f, cell, n = (found[c].to_numpy() for c in ("f", "cell", "n"))
    edges = []
    for k in range(len(docstats.FEATURES)):
        order = np.argsort(cell[f == k])
        cells, seen = cell[f == k][order], np.cumsum(n[f == k][order])
        at = np.searchsorted(seen, np.arange(1, BINS) / BINS * seen[-1]) if len(seen) else np.zeros(0, np.int64)
        edges.append(np.unique(cells[at[at < len(cells) - 1]]).astype(np.float64) if len(seen) else np.zeros(0))
    return edges


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin number of every statistic, one byte each."""
    cells = _cells(x)
    return np.stack([np.searchsorted(e, cells[:, f], side="left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)


class Columns:
    """Places of all bins in one weight vector; the last weight is the bias."""

    def __init__(self, edges: list[np.ndarray]):
        self.first = np.concatenate(([0], np.cumsum([len(e) + 1 for e in edges])))
        self.n = int(self.first[-1]) + 1

    def of(self, binned: np.ndarray) -> np.ndarray:
        at = binned.astype(np.int64) + self.first[:-1]
        return np.hstack((at, np.full((len(at), 1), self.n - 1)))

    def sums(self, binned: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Over the rows: sum of log(1 + e^z), its gradient and its curvature."""
        at = self.of(binned)
        z = w[at].sum(axis=1)
        p = 1 / (1 + np.exp(-z))
        gradient = np.bincount(at.ravel(), np.repeat(p, at.shape[1]), self.n)
        rows, weight = np.arange(len(at))[:, None], (p * (1 - p))[:, None]
        hot = np.zeros((len(at), self.n), np.float32)
        hot[rows, at] = 1
        return float(np.logaddexp(0, z).sum()), gradient, (hot * weight.astype(np.float32)).T.astype(np.float64) @ hot


class Unlabelled:
    """The unlabelled rows, (half, bins) in a stored table, known through sums only."""

    def __init__(self, table: DataFrame, columns: Columns):
        self.table, self.columns = table, columns
        self.n = {r["half"]: r["n"] for r in table.groupBy("half").agg(F.count("*").alias("n")).collect()}

    def _summed(self, of_rows, size: int) -> np.ndarray:
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for lo in range(0, batch.num_rows, 4096):
                    part = batch.slice(lo, 4096)
                    binned = np.frombuffer(b"".join(part["bins"].to_pylist()), np.uint8).reshape(part.num_rows, -1)
                    total += of_rows(binned, part["half"].to_numpy())
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "v"])

        # partial sums in a fixed order, so that reruns agree to the last bit
        parts = self.table.select("half", "bins").mapInArrow(partial, "at bigint, v double")
        found = parts.groupBy("at").agg(F.array_sort(F.collect_list("v")).alias("v")).toArrow()
        out = np.zeros(size)
        out[found["at"].to_numpy()] = [sum(v) for v in found["v"].to_pylist()]
        return out

    def sums(self, weights: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
        """Means over each half (-1: all rows) with that half's weights: loss as negative, gradient, curvature."""
        n, columns = self.columns.n, self.columns
        size = 1 + n + n * n

        def of_rows(binned: np.ndarray, half: np.ndarray) -> np.ndarray:
            out = []
            for h, w in weights.items():
                loss, gradient, curve = columns.sums(binned if h < 0 else binned[half == h], w)
                out += [[loss], gradient, curve.ravel()]
            return np.concatenate(out)

        total = self._summed(of_rows, size * len(weights)).reshape(len(weights), size)
        rows = {h: sum(self.n.values()) if h < 0 else self.n.get(h, 0) for h in weights}
        return {h: (t[0] / rows[h], t[1 : 1 + n] / rows[h], t[1 + n :].reshape(n, n) / rows[h]) for (h, t) in zip(weights, total, strict=True)}

    def above(self, weights: dict[int, np.ndarray], levels: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """Share of each half's rows whose margin is at least each level."""
        width, columns = max(map(len, levels.values())), self.columns

        def of_rows(binned: np.ndarray, half: np.ndarray) -> np.ndarray:
            out = np.zeros((len(weights), width))
            for k, (h, w) in enumerate(weights.items()):
                z = w[columns.of(binned[half == h])].sum(axis=1)
                out[k, : len(levels[h])] = len(z) - np.searchsorted(np.sort(z), levels[h], side="left")
            return out.ravel()

        total = self._summed(of_rows, len(weights) * width).reshape(len(weights), width)
        return {h: total[k, : len(levels[h])] / self.n[h] for k, h in enumerate(weights)}


def tell_apart(pos: dict[int, np.ndarray], unl: Unlabelled) -> dict[int, np.ndarray]:
    """Per half, weights of a plain logistic model of positive against unlabelled rows, both classes weighted alike."""
    n = unl.columns.n
    w = {h: np.zeros(n) for h in pos}
    for _ in range(STEPS // 4):
        found, moved = unl.sums(w), 0.0
        for h, rows in pos.items():
            _, up, curve_pos = unl.columns.sums(rows, w[h])
            here = np.bincount(unl.columns.of(rows).ravel(), minlength=n)
            _, down, curve = found[h]
            g = 0.5 * down + 0.5 * (up - here) / len(rows) + RIDGE * w[h]
            step = np.linalg.solve(0.5 * curve + 0.5 * curve_pos / len(rows) + RIDGE * np.eye(n), g)
            step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
            w[h], moved = w[h] - step, max(moved, float(np.abs(step).max()))
        if moved < 1e-3:
            break
    return w


def fit(pos: np.ndarray, unl: Unlabelled, prior: float) -> np.ndarray:
    """Weights that minimise the non-negative unbiased risk with the logistic loss.

    ``R_pos(+) - R_pos(-)`` is the negated mean margin of the positives, so the
    unbiased risk is convex and Newton's method applies. A step is halved until
    it lowers the risk and leaves the negative part of the risk, which
    can't be below zero, at zero or more.
    """
    n = unl.columns.n
    here = np.bincount(unl.columns.of(pos).ravel(), minlength=n) / len(pos)

    def state(w: np.ndarray):
        loss, down, curve = unl.sums({-1: w})[-1]
        negative = loss - prior * unl.columns.sums(pos, w)[0] / len(pos)
        return loss - prior * here @ w + RIDGE / 2 * w @ w, negative, down - prior * here + RIDGE * w, curve + RIDGE * np.eye(n)

    w = np.zeros(n)
    risk, _, g, curve = state(w)
    passes = 1
    while passes < STEPS:
        step = np.linalg.solve(curve, g)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        size = 1.0
        while passes < STEPS:
            new = state(w - size * step)
            passes += 1
            if new[0] <= risk and new[1] >= 0:
                break
            size /= 2
        else:
            break
        done = risk - new[0] < 1e-7
        w, risk, g, curve = w - size * step, new[0], new[2], new[3]
        if done:
            break
    return w


def estimate_prior(pos: np.ndarray, above_unl: np.ndarray, levels: np.ndarray, n_unl: int) -> float:
    """Class prior from the margins of held-back positives and the unlabelled shares above ``levels`` (best-bin estimate)."""
    above_pos = 1 - np.searchsorted(np.sort(pos), levels, side="left") / len(pos)
    error = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(n_unl) + 1 / np.sqrt(len(pos)))
    best = np.argmin((above_unl + error) / above_pos)
    return float(np.clip(above_unl[best] / above_pos[best], 0.02, 0.98))


def score_levels(pos: np.ndarray) -> np.ndarray:
    return np.unique(np.quantile(pos, np.linspace(0, 0.9, 91)))


def learn(pos: np.ndarray, half: np.ndarray, unl: Unlabelled) -> tuple[np.ndarray, float]:
    """(weights, estimated prior) from the positives' bins and halves, and the unlabelled rows."""
    prior = 0.5
    if all((half == h).any() and unl.n.get(h) for h in (0, 1)):
        w = tell_apart({h: pos[half == h] for h in (0, 1)}, unl)
        other = {1 - h: w[h] for h in w}  # a half is scored by the other half's model
        margins = {h: other[h][unl.columns.of(pos[half == h])].sum(axis=1) for h in other}
        levels = {h: score_levels(m) for h, m in margins.items()}
        above = unl.above(other, levels)
        prior = sum(estimate_prior(margins[h], above[h], levels[h], unl.n[h]) for h in other) / 2
    return fit(pos, unl, prior), prior


def _half(doc_id):
    """Half of a document, by a hash of its id, so that none is on both sides."""
    return F.coalesce(F.pmod(F.xxhash64(doc_id, F.lit(2)), F.lit(2)), F.lit(0)).cast("int")


def train_quality(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES) -> tuple[Additive, float]:
    """Learns from rows outside the held-out third only."""
    trusted = (
        labels.where(~labelled.held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
        .where((F.col("least") == 1) & (F.col("most") == 1))
        .select("doc_id", _half(F.col("doc_id")).alias("half"))
    )
    x, role = labelled.sample_features(docs, labelled.hash_sample(trusted, positives))
    web = docs.select("doc_id", "text").where(~labelled.held_out(F.col("doc_id")))
    features = materialized(web.select(_half(F.col("doc_id")).alias("half"), labelled.text_features("text").alias("x")), "web-features")
    edges = quantile_edges(features)
    columns = Columns(edges)

    @F.arrow_udf("binary")
    def binned(batch: pa.Array) -> pa.Array:
        found = bins(_matrix(batch), edges) if len(batch) else np.zeros((0, len(edges)), np.uint8)
        return pa.array([row.tobytes() for row in found], pa.binary())

    unl = Unlabelled(materialized(features.select("half", binned("x").alias("bins")), "web-bins"), columns)
    if len(x) < 4 or sum(unl.n.values()) < 4:
        return Additive(edges, [np.zeros(len(e) + 1) for e in edges], 0.0), 0.5
    w, prior = learn(bins(x, edges), role["half"], unl)
    return Additive(edges, np.split(w[:-1], columns.first[1:-1]), float(w[-1])), prior


def score_quality(docs: DataFrame, model: Additive) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on), which replace columns of those names."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.probability(docstats.stats(texts)[1]))

    own = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    return docs.withColumn("__score", score(F.col("text"))).select(
        *own, F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted")
    )


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model, _ = train_quality(docs, labels)
    return score_quality(docs.select("doc_id", "text"), model).select(
        "doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )

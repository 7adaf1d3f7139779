"""Quality rules: hard limits on exact counts, then boosted trees over document statistics.

The trees learn from a bounded, hash-chosen sample of the labelled documents
(``TRAIN_ROWS``), with monotonic constraints: more symbols, repeated words or
repeated lines never raise the score. Scoring covers every whole text with the
flattened trees (:mod:`marquee.llm.trees`).

Defined cases: a null or wordless text fails the word limit; a label other
than 0 and 1 is ignored, an id with both counts as 0; without labels of both
classes the verdict is the limits' alone; repeated documents are judged alike,
very long ones whole; a score of exactly ``KEEP_FROM`` passes; an input column
named like an output is replaced; empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import docstats, labelled, trees

TRAIN_ROWS = 20_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_FROM = 0.5
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1}


def train_rules(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> trees.Forest:
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where(F.col("y").isin(0, 1))
    x, other = labelled.sample_features(docs, labelled.hash_sample(marked, train_rows))
    monotone = {docstats.FEATURES.index(name): sign for name, sign in MONOTONE.items()}
    return trees.train(x, other["y"].astype(float), monotone)


def _scorer(forest: trees.Forest):
    fields = ", ".join(f"{name}: bigint" for name in docstats.BASE)

    @F.arrow_udf(f"struct<{fields}, score: double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            base, features = docstats.stats(texts)
            columns = [pa.array(base[:, k]) for k in range(base.shape[1])] + [pa.array(forest.probability(features))]
            yield pa.StructArray.from_arrays(columns, [*docstats.BASE, "score"])

    return score


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def judge(docs: DataFrame, forest: trees.Forest) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``score`` and ``kept``."""
    outputs = (*docstats.BASE, "base_failed", "score", "kept")
    own = [c for c in docs.columns if c.lower() not in outputs]
    scored = docs.withColumn("__q", _scorer(forest)(F.col("text")))
    failed = base_failed(F.col("__q.n_words"), F.col("__q.n_repeat_words"))
    return scored.select(
        *own,
        *[F.col(f"__q.{name}").alias(name) for name in docstats.BASE],
        failed.alias("base_failed"),
        F.col("__q.score").alias("score"),
        (~failed & (F.col("__q.score") >= KEEP_FROM)).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, in their own columns."""
    scored = docs.withColumn("__q", _scorer(train_rules(docs, labels))(F.col("text")))
    failed = base_failed(F.col("__q.n_words"), F.col("__q.n_repeat_words"))
    return scored.where(~failed & (F.col("__q.score") >= KEEP_FROM)).select(*docs.columns)


def rules_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text"), train_rules(docs, labels)).select(
        "doc_id", *docstats.BASE, "base_failed", "kept", "score"
    )

"""Physical-plan properties the reports rely on at scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from marquee.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(spark, name: str) -> str:
    df = E.queries()[name](spark, SF_DIR)
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_top_k_limits_before_the_shuffle(spark):
    text = formatted(spark, "topic_top_words")
    assert "WindowGroupLimit" in text
    assert "Partial" in text and "Final" in text


def test_aggregates_are_partial_then_final(spark):
    text = formatted(spark, "movie_rating_stats")
    assert "partial_avg" in text and "partial_count" in text


def test_stopwords_use_an_anti_join(spark):
    text = formatted(spark, "review_tokens")
    assert "BroadcastHashJoin LeftAnti" in text
    # frequent_words has no labels join, so any left outer join would be the stopwords
    assert "LeftOuter" not in formatted(spark, "frequent_words")


def test_header_filter_and_pruning_reach_the_scan(spark):
    text = formatted(spark, "topic_top_words")
    assert "PushedFilters: [IsNotNull(text), Not(EqualTo(text,comment))]" in text
    assert "ReadSchema: struct<text:string,lang:string>" in text


def test_rating_scan_reads_only_needed_columns(spark):
    text = formatted(spark, "yearly_rating_stats")
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>" in text


def test_gender_pivot_has_one_aggregation_exchange(spark):
    text = formatted(spark, "movie_gender_stats")
    assert "pivotfirst" not in text.lower()
    assert text.count("partial_avg") == 2  # M and F, one aggregate node


def test_no_plan_depends_on_split_counts_or_round_robin(spark):
    for name in sorted(catalog.queries()):
        if name.startswith(("sink_", "scan_", "stream_", "ingest_reviews", "ingest_stopwords", "union_", "op_sort", "op_format")):
            continue  # these write files when they are built
        assert "RoundRobin" not in formatted(spark, name), name


def test_labels_filter_reaches_the_scan(spark):
    assert "In(quality, [0,1])" in formatted(spark, "topic_sentiment_top_words")


def test_report_6_aggregates_below_the_title_join(spark):
    text = formatted(spark, "movie_gender_stats_zero")
    tree = text[: text.index("(1) ")]
    # (sum, count) per movie in two steps, then merged by title in two steps
    assert tree.count("HashAggregate") == 4
    assert tree.rindex("HashAggregate") > tree.index("Join") > tree.index("HashAggregate")

"""The training-data pipeline over ``documents``: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns what it keeps; all but the
last return the columns of ``documents``. ``ORACLE_SQL`` is None: boosted
trees can't be put in SQL. The tests hold every stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import decontam, mixing, near_dups, quality_rules, sharding
from marquee.session import materialized
from marquee.sources.testdata import table

N_SHARDS = 16


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more) stays."""
    return near_dups.drop_near_copies(docs, near_dups.STAGE_SIMILAR)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights; a document may come twice, or be cut at its source's budget."""
    return mixing.mix_sources(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the virtual slot and the shard."""
    return sharding.assign_shards(docs, N_SHARDS)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from marquee.llm import centroids, decontam, lm_scoring, mixing, near_dups, oracle, packing, pii, pu, quality_rules, repeats, sharding, urls, whitening
from marquee.sources.testdata import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_tokens(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rules_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_report(table(spark, sf_dir, "pages"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_report(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_report(table(spark, sf_dir, "embeddings"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_lm_scoring": op1_lm_scoring,
        "op2_sharding": op2_sharding,
        "op3_decontamination": op3_decontamination,
        "op4_mixing": op4_mixing,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_packing": op6_packing,
        "op7_quality_rules": op7_quality_rules,
        "op8_near_dups": op8_near_dups,
        "op9_url_filter": op9_url_filter,
        "op10_pii": op10_pii,
        "op11_repeats": op11_repeats,
        "op12_whitening": op12_whitening,
        "op13_centroids": op13_centroids,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.SQL

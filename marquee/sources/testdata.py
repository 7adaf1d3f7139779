"""Adapter: the report inputs defined over the TPC-H-like parquet tables.

=========== ============================================================
report      parquet source
=========== ============================================================
ratings     lineitem (movie = l_partkey, rating = l_quantity,
            ts = l_shipdate as Unix seconds); user = o_custkey of the order
movies      part (title = p_name, genres = the words of p_name)
users       customer (gender = first letter of c_mktsegment, so M and F
            exist next to other codes; age = floor(c_acctbal / 100), which
            spans negative ages and every bucket; occupation = c_nationkey)
occupations nation (n_nationkey, n_name)
reviews     documents left join labels (id = doc_id, review = text,
            topic = lang, aspect = source, sentiment from quality:
            1 positive, 0 negative, unlabelled NULL)
stopwords   a fixed list with a repeated entry and a two-word entry
=========== ============================================================

Ids become strings, as in the text files of the reports. Only the columns a
report needs are selected, so the parquet scans prune the rest.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.text import split_list
from marquee.operators.join import prefiltered_left_join, word_list_frame

# The stopword list used with the test documents. "the" and
# "de" appear twice and "of the" can never equal a single token.
TEST_STOPWORDS = (
    "the", "and", "of", "a", "to", "in", "is", "it",
    "la", "le", "et", "les", "des", "un",
    "der", "die", "und", "das",
    "el", "y", "en", "que", "los",
    "the", "de", "de", "of the",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _epoch_seconds(c: str):
    ts = F.col(c)
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * F.lit(86400)
        + F.hour(ts) * F.lit(3600)
        + F.minute(ts) * F.lit(60)
        + F.second(ts)
    )


def ratings(spark: SparkSession, sf_dir: str, with_user: bool = False) -> DataFrame:
    """Ratings; ``with_user`` adds user_id through orders (one order per line)."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey"),
        F.col("l_partkey").cast("string").alias("movie_id"),
        F.col("l_quantity").alias("rating"),
        _epoch_seconds("l_shipdate").alias("ts"),
    )
    if not with_user:
        return lines.drop("l_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("string").alias("user_id")
    )
    return lines.join(orders, "l_orderkey").select("user_id", "movie_id", "rating", "ts")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("movie_id"),
        F.col("p_name").alias("title"),
        split_list(F.col("p_name"), " ").alias("genres"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.substring("c_mktsegment", 1, 1).alias("gender"),
        F.floor(F.col("c_acctbal") / F.lit(100)).cast("int").alias("age"),
        F.col("c_nationkey").cast("string").alias("occupation_id"),
        F.col("c_name").alias("zip_code"),
    )


def occupations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("occupation_id"),
        F.col("n_name").alias("occupation_name"),
    )


def reviews(spark: SparkSession, sf_dir: str, with_sentiment: bool = True) -> DataFrame:
    """Reviews; without ``with_sentiment`` the labels join is skipped entirely
    and the frame has no sentiment column (reports that ignore sentiment
    then never shuffle the review text for the join)."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("review"),
        F.col("lang").alias("topic"),
        F.col("source").alias("aspect"),
    )
    if not with_sentiment:
        return docs
    labels = table(spark, sf_dir, "labels").where(F.col("quality").isin(0, 1)).select(
        F.col("doc_id").alias("id"),
        F.when(F.col("quality") == 1, F.lit("positive")).otherwise(F.lit("negative")).alias("sentiment"),
    )
    return prefiltered_left_join(docs, labels, "id")


def stopwords(spark: SparkSession) -> DataFrame:
    return word_list_frame(spark, TEST_STOPWORDS)

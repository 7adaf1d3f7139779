"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every callable reads the parquet tables of ``sf_dir`` through the adapter in
:mod:`marquee.sources.testdata` and runs one report or one operator check
over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.plans import checks
from marquee.plans import ratings as R
from marquee.plans import reviews as V
from marquee.sources import testdata as T

Query = Callable[[SparkSession, str], DataFrame]


def _report_queries() -> dict[str, Query]:
    return {
        "movie_rating_stats": lambda s, d: R.movie_rating_stats(T.ratings(s, d), T.movies(s, d)),
        "top_rated_movie": lambda s, d: R.top_rated_movie(T.ratings(s, d), T.movies(s, d)),
        "top_rated_movie_lab1": lambda s, d: R.top_rated_movie_by_id(T.ratings(s, d), T.movies(s, d)),
        "movie_rating_report": lambda s, d: R.movie_rating_report(T.ratings(s, d), T.movies(s, d)),
        "genre_rating_stats": lambda s, d: R.genre_rating_stats(T.ratings(s, d), T.movies(s, d)),
        "movie_gender_stats": lambda s, d: R.movie_gender_stats(
            T.ratings(s, d, with_user=True), T.users(s, d), T.movies(s, d)
        ),
        "movie_gender_stats_zero": lambda s, d: R.movie_gender_stats_zero(
            T.ratings(s, d, with_user=True), T.users(s, d), T.movies(s, d)
        ),
        "movie_age_group_stats": lambda s, d: R.movie_age_group_stats(
            T.ratings(s, d, with_user=True), T.users(s, d), T.movies(s, d)
        ),
        "movie_age_group_stats_title": lambda s, d: R.movie_age_group_stats_title(
            T.ratings(s, d, with_user=True), T.users(s, d), T.movies(s, d)
        ),
        "occupation_rating_stats": lambda s, d: R.occupation_rating_stats(
            T.ratings(s, d, with_user=True), T.users(s, d), T.occupations(s, d)
        ),
        "yearly_rating_stats": lambda s, d: R.yearly_rating_stats(T.ratings(s, d)),
        "review_tokens": lambda s, d: V.review_tokens(T.reviews(s, d), T.stopwords(s)),
        "frequent_words": lambda s, d: V.frequent_words(
            T.reviews(s, d, with_sentiment=False), T.stopwords(s)
        ),
        "comments_by_topic": lambda s, d: V.comments_by_topic(T.reviews(s, d, with_sentiment=False)),
        "comments_by_aspect": lambda s, d: V.comments_by_aspect(T.reviews(s, d, with_sentiment=False)),
        "sentiment_extreme_aspects": lambda s, d: V.sentiment_extreme_aspects(T.reviews(s, d)),
        "topic_sentiment_top_words": lambda s, d: V.topic_sentiment_top_words(T.reviews(s, d)),
        "topic_top_words": lambda s, d: V.topic_top_words(T.reviews(s, d, with_sentiment=False)),
    }


def queries() -> dict[str, Query]:
    out = _report_queries()
    out.update(checks.queries())
    return out

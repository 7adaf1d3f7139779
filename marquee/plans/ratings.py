"""Rating reports: per movie, genre, gender, age group, occupation and year.

Inputs are typed frames (see :mod:`marquee.sources.records`):

* ``ratings``: user_id string, movie_id string, rating double, ts bigint
* ``movies``: movie_id string, title string, genres array<string>
* ``users``: user_id string, gender string, age int, occupation_id string, zip_code string
* ``occupations``: occupation_id string, occupation_name string

Plan shape, for data far larger than memory:

* aggregate first, look titles up afterwards (the lookup then joins one row
  per movie, not one row per rating);
* raw ratings meet users in a join that splits the heavy users, so a user or
  movie with a large share of them never fills one task, and are reduced to
  (sum, count) per movie right after it, before titles come in;
* where a dimension is only needed for grouping (genres, occupations), the
  ratings are pre-aggregated to (sum, count) per join key before the join,
  so the join input is bounded by the number of movies or users and a hot key
  has collapsed to one row;
* pivots over a fixed category list are conditional aggregates (one
  exchange);
* a dimension read with line positions counts with its last line per key, as
  in a map filled line by line; without positions a repeated key multiplies
  (titles: the largest one counts);
* no broadcast hints: AQE broadcasts a dimension when its runtime size is
  under the threshold and otherwise keeps a shuffle join (and splits skewed
  partitions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalar import AGE_GROUPS, age_group, epoch_year
from marquee.operators.aggregate import (
    avg_count,
    conditional_stats,
    conditional_sums,
    merge_conditional,
    merge_sum_count,
    sum_count,
)
from marquee.operators.join import listed_once, lookup_with_fallback, one_per_key, split_heavy_join
from marquee.operators.topk import top_one

# Gender codes and their column prefixes, in report order.
GENDERS = (("M", "m"), ("F", "f"))
# Column prefixes of the age buckets, in the order of AGE_GROUPS.
AGE_GROUP_PREFIXES = ("age_0_18", "age_18_35", "age_35_50", "age_50_plus")
DEFAULT_MIN_RATINGS = 5


def _titles(movies: DataFrame) -> DataFrame:
    """(movie_id, title), one row per movie (see :func:`one_per_key`)."""
    return one_per_key(movies, "movie_id", "title")


def _with_users(ratings: DataFrame, users: DataFrame, field: str) -> DataFrame:
    """Ratings with one user field; users with very many ratings are split by movie."""
    slim = ratings.select("user_id", "movie_id", "rating")
    return split_heavy_join(slim, listed_once(users, "user_id", field), "user_id", "movie_id")


def movie_rating_stats(
    ratings: DataFrame, movies: DataFrame, order_by: str = "title", ordered: bool = True
) -> DataFrame:
    """Average rating and count per movie; unknown movies are kept under their id.

    ``order_by="title"`` is the default report order, ``"id"`` orders by the
    movie id as text (the MapReduce form of the report).
    """
    stats = avg_count(ratings, ["movie_id"])
    out = lookup_with_fallback(stats, movies, "movie_id", "title").select(
        "movie_id", "title", "avg_rating", "n"
    )
    if not ordered:
        return out
    if order_by == "id":
        return out.orderBy("movie_id")
    return out.orderBy("title", "movie_id")


def _qualified(ratings: DataFrame, movies: DataFrame, min_ratings: int) -> DataFrame:
    stats = avg_count(ratings, ["movie_id"]).where(F.col("n") >= F.lit(min_ratings))
    return lookup_with_fallback(stats, movies, "movie_id", "title")


def top_rated_movie(ratings: DataFrame, movies: DataFrame, min_ratings: int = DEFAULT_MIN_RATINGS) -> DataFrame:
    """Highest average among movies with at least ``min_ratings`` ratings (inclusive).

    Ties: more ratings first, then title, then id. Zero or one row.
    """
    best = top_one(
        _qualified(ratings, movies, min_ratings),
        [F.desc("avg_rating"), F.desc("n"), F.asc("title"), F.asc("movie_id")],
    )
    return best.select("movie_id", "title", "avg_rating", "n")


def top_rated_movie_by_id(
    ratings: DataFrame, movies: DataFrame, min_ratings: int = DEFAULT_MIN_RATINGS
) -> DataFrame:
    """MapReduce form: on an average tie the first movie id in text order wins."""
    best = top_one(
        _qualified(ratings, movies, min_ratings),
        [F.desc("avg_rating"), F.asc("movie_id")],
    )
    return best.select("movie_id", "title", "avg_rating", "n")


def movie_rating_report(
    ratings: DataFrame, movies: DataFrame, min_ratings: int = DEFAULT_MIN_RATINGS
) -> DataFrame:
    """Per-movie detail rows followed by one summary row.

    The summary row is ``top`` with the best movie, or ``none`` with NULLs
    when no movie reaches ``min_ratings``. It comes from a global
    ``min_by`` (one partial row per task), so it exists even for empty input
    without any driver-side decision.
    """
    stats = lookup_with_fallback(avg_count(ratings, ["movie_id"]), movies, "movie_id", "title")
    detail = stats.select(F.lit("detail").alias("row_kind"), "title", "avg_rating", "n")
    ranked_by = F.struct(
        (-F.col("avg_rating")).alias("a"), (-F.col("n")).alias("c"), F.col("title"), F.col("movie_id")
    )
    best = (
        stats.where(F.col("n") >= F.lit(min_ratings))
        .agg(F.min_by(F.struct("title", "avg_rating", "n"), ranked_by).alias("best"))
        .select(
            F.when(F.col("best").isNull(), F.lit("none")).otherwise(F.lit("top")).alias("row_kind"),
            F.col("best.title").alias("title"),
            F.col("best.avg_rating").alias("avg_rating"),
            F.col("best.n").alias("n"),
        )
    )
    return detail.unionByName(best).orderBy("row_kind", "title", "avg_rating", "n")


def genre_rating_stats(ratings: DataFrame, movies: DataFrame, ordered: bool = True) -> DataFrame:
    """Average and count per genre; a rating counts once per genre occurrence.

    Ratings of movies missing from ``movies`` are dropped (inner join).
    """
    per_movie = sum_count(ratings, ["movie_id"])
    by_genre = per_movie.join(listed_once(movies, "movie_id", "genres"), "movie_id").select(
        F.explode("genres").alias("genre"), "rating_sum", "rating_n"
    )
    out = merge_sum_count(by_genre, ["genre"])
    return out.orderBy("genre") if ordered else out


def movie_gender_stats(
    ratings: DataFrame,
    users: DataFrame,
    movies: DataFrame,
    genders: Sequence[tuple[str, str]] = GENDERS,
    ordered: bool = True,
) -> DataFrame:
    """Per movie: average and count for each gender code (exact match).

    A cell without ratings has avg NULL and n 0. Movies rated only by users of
    other codes still get a row. Ratings of unknown users are dropped; unknown
    movies are kept under their id.
    """
    joined = _with_users(ratings, users, "gender")
    stats = conditional_stats(joined, ["movie_id"], "gender", genders)
    cols = [c for _, p in genders for c in (f"{p}_avg", f"{p}_n")]
    out = lookup_with_fallback(stats, movies, "movie_id", "title").select(
        "movie_id", "title", *cols
    )
    return out.orderBy("title", "movie_id") if ordered else out


def movie_gender_stats_zero(
    ratings: DataFrame,
    users: DataFrame,
    movies: DataFrame,
    genders: Sequence[tuple[str, str]] = GENDERS,
    ordered: bool = True,
) -> DataFrame:
    """MapReduce form: keyed by title (equal titles merge), unknown movies and
    users dropped, gender code compared ignoring case, empty cell = 0.0."""
    joined = _with_users(ratings, users, "gender")
    per_movie = conditional_sums(joined, ["movie_id"], "gender", genders, ignore_case=True)
    prefixes = [p for _, p in genders]
    stats = merge_conditional(per_movie.join(_titles(movies), "movie_id"), ["title"], prefixes, missing_avg=0.0)
    out = stats.select("title", *[f"{p}_avg" for p in prefixes])
    return out.orderBy("title") if ordered else out


def movie_age_group_stats(
    ratings: DataFrame, users: DataFrame, movies: DataFrame, ordered: bool = True
) -> DataFrame:
    """Per movie: average and count in each age bucket (avg NULL, n 0 when empty)."""
    joined = _with_users(ratings, users, "age").withColumn("age_group", age_group("age"))
    buckets = list(zip(AGE_GROUPS, AGE_GROUP_PREFIXES))
    stats = conditional_stats(joined, ["movie_id"], "age_group", buckets)
    cols = [c for p in AGE_GROUP_PREFIXES for c in (f"{p}_avg", f"{p}_n")]
    out = lookup_with_fallback(stats, movies, "movie_id", "title").select(
        "movie_id", "title", *cols
    )
    return out.orderBy("title", "movie_id") if ordered else out


def movie_age_group_stats_title(
    ratings: DataFrame, users: DataFrame, movies: DataFrame, ordered: bool = True
) -> DataFrame:
    """MapReduce form: keyed by title (equal titles merge), unknown movies and
    users dropped; a bucket without ratings has avg NULL."""
    joined = _with_users(ratings, users, "age").withColumn("age_group", age_group("age"))
    buckets = list(zip(AGE_GROUPS, AGE_GROUP_PREFIXES))
    per_movie = conditional_sums(joined, ["movie_id"], "age_group", buckets)
    stats = merge_conditional(per_movie.join(_titles(movies), "movie_id"), ["title"], AGE_GROUP_PREFIXES)
    out = stats.select("title", *[f"{p}_avg" for p in AGE_GROUP_PREFIXES])
    return out.orderBy("title") if ordered else out


def occupation_rating_stats(
    ratings: DataFrame, users: DataFrame, occupations: DataFrame, ordered: bool = True
) -> DataFrame:
    """Average and count per occupation name through users.

    Occupations without ratings do not appear (inner joins). The ratings are
    reduced to (sum, count) per user first, so the join chain sees one row
    per user.
    """
    per_user = sum_count(ratings, ["user_id"])
    chain = per_user.join(listed_once(users, "user_id", "occupation_id"), "user_id").join(
        listed_once(occupations, "occupation_id", "occupation_name"), "occupation_id"
    )
    out = merge_sum_count(chain, ["occupation_name"])
    return out.orderBy("occupation_name") if ordered else out


def yearly_rating_stats(ratings: DataFrame, ordered: bool = True) -> DataFrame:
    """Average and count per UTC calendar year of the rating timestamp."""
    out = avg_count(ratings.withColumn("year", epoch_year("ts")), ["year"])
    return out.orderBy("year") if ordered else out

from __future__ import annotations

import pytest
from conftest import rows

from marquee.plans import ratings as R

MOVIE_SCHEMA = "movie_id string, title string, genres array<string>"
RATING_SCHEMA = "user_id string, movie_id string, rating double, ts bigint"
USER_SCHEMA = "user_id string, gender string, age int, occupation_id string, zip_code string"


@pytest.fixture()
def movies(spark):
    return spark.createDataFrame(
        [
            ("1", "Psycho (1960)", ["Horror", "Mystery", "Horror"]),
            ("2", "Sunset Boulevard (1950)", ["Drama", "Film-Noir"]),
            ("3", "Twin (2000)", ["Drama"]),
            ("4", "Twin (2000)", ["Comedy"]),
        ],
        MOVIE_SCHEMA,
    )


@pytest.fixture()
def users(spark):
    return spark.createDataFrame(
        [
            ("u1", "M", 17, "1", "z"),
            ("u2", "F", 18, "1", "z"),
            ("u3", "F", 34, "2", "z"),
            ("u4", "m", 35, "2", "z"),
            ("u5", "X", 49, "3", "z"),
            ("u6", "M", 50, "3", "z"),
            ("u7", "F", -1, "9", "z"),
        ],
        USER_SCHEMA,
    )


@pytest.fixture()
def occupations(spark):
    return spark.createDataFrame(
        [("1", "Programmer"), ("2", "Artist"), ("3", "Doctor"), ("4", "Researcher")],
        "occupation_id string, occupation_name string",
    )


@pytest.fixture()
def ratings(spark):
    data = [
        ("u2", "1", 4.0, 1577836799),  # 2019-12-31T23:59:59Z
        ("u3", "1", 4.0, 1577836800),  # 2020-01-01T00:00:00Z
        ("u1", "2", 4.5, 1577836800),
        ("u4", "2", 4.5, 1577836800),
        ("u6", "2", 4.0, 1577836800),
        ("u6", "2", 4.0, 1577836800),  # repeated (user, movie): both count
        ("u5", "3", 3.0, 1577836800),
        ("u1", "4", 5.0, 1577836800),
        ("nobody", "99", 2.0, 1577836800),  # unknown user and movie
    ]
    return spark.createDataFrame(data, RATING_SCHEMA)


def test_movie_stats_keep_unknown_movie_under_id(ratings, movies):
    got = R.movie_rating_stats(ratings, movies)
    assert [tuple(r) for r in got.collect()] == [
        ("99", "99", 2.0, 1),
        ("1", "Psycho (1960)", 4.0, 2),
        ("2", "Sunset Boulevard (1950)", 4.25, 4),
        ("3", "Twin (2000)", 3.0, 1),
        ("4", "Twin (2000)", 5.0, 1),
    ]
    by_id = [r.movie_id for r in R.movie_rating_stats(ratings, movies, order_by="id").collect()]
    assert by_id == ["1", "2", "3", "4", "99"]


def test_top_rated_threshold_inclusive_and_ties(spark, movies):
    data = [("u", "1", 4.0, 0)] * 3 + [("u", "2", 4.0, 0)] * 3 + [("u", "3", 5.0, 0)] * 2
    r = spark.createDataFrame(data, RATING_SCHEMA)
    # 1 and 2 tie on average and count: the smaller title wins.
    assert [tuple(x) for x in R.top_rated_movie(r, movies, min_ratings=3).collect()] == [
        ("1", "Psycho (1960)", 4.0, 3)
    ]
    more = r.unionByName(spark.createDataFrame([("u", "2", 4.0, 0)], RATING_SCHEMA))
    assert R.top_rated_movie(more, movies, min_ratings=3).first().movie_id == "2"
    assert R.top_rated_movie(r, movies, min_ratings=4).count() == 0


def test_top_rated_by_id_uses_text_order(spark):
    movies = spark.createDataFrame([("10", "B", []), ("9", "A", [])], MOVIE_SCHEMA)
    r = spark.createDataFrame([("u", "9", 4.0, 0), ("u", "10", 4.0, 0)], RATING_SCHEMA)
    assert R.top_rated_movie_by_id(r, movies, min_ratings=1).first().movie_id == "10"
    assert R.top_rated_movie(r, movies, min_ratings=1).first().movie_id == "9"


def test_report_summary_row(ratings, movies):
    rep = [tuple(r) for r in R.movie_rating_report(ratings, movies, min_ratings=4).collect()]
    assert rep[-1] == ("top", "Sunset Boulevard (1950)", 4.25, 4)
    assert [r[0] for r in rep].count("detail") == 5
    none = [tuple(r) for r in R.movie_rating_report(ratings, movies, min_ratings=50).collect()]
    assert none[-1] == ("none", None, None, None)


def test_report_summary_on_empty_input(spark, movies):
    empty = spark.createDataFrame([], RATING_SCHEMA)
    assert [tuple(r) for r in R.movie_rating_report(empty, movies).collect()] == [("none", None, None, None)]


def test_genre_repeats_count_twice_unknown_dropped(ratings, movies):
    got = {r.genre: (r.avg_rating, r.n) for r in R.genre_rating_stats(ratings, movies).collect()}
    assert got == {
        "Horror": (4.0, 4),
        "Mystery": (4.0, 2),
        "Drama": (pytest.approx(4.0), 5),
        "Film-Noir": (4.25, 4),
        "Comedy": (5.0, 1),
    }


def test_gender_pivot_null_and_zero_cells(ratings, users, movies):
    got = {r.movie_id: tuple(r)[1:] for r in R.movie_gender_stats(ratings, users, movies).collect()}
    assert got["1"] == ("Psycho (1960)", None, 0, 4.0, 2)
    # u4 is lower-case "m": not matched in the exact form
    assert got["2"] == ("Sunset Boulevard (1950)", pytest.approx(12.5 / 3), 3, None, 0)
    # only an "X" user rated movie 3: the row still exists
    assert got["3"] == ("Twin (2000)", None, 0, None, 0)
    assert "99" not in got  # unknown user: dropped by the inner join


def test_gender_zero_variant(ratings, users, movies):
    got = {r.title: (r.m_avg, r.f_avg) for r in R.movie_gender_stats_zero(ratings, users, movies).collect()}
    assert got["Psycho (1960)"] == (0.0, 4.0)
    assert got["Sunset Boulevard (1950)"] == (4.25, 0.0)  # "m" counts when case is ignored
    assert got["Twin (2000)"] == (5.0, 0.0)  # movies 3 and 4 merge under one title
    assert len(got) == 3


def test_age_group_boundaries(spark, users, movies):
    r = spark.createDataFrame([(u, "1", float(i + 1), 0) for i, u in enumerate(["u1", "u2", "u3", "u4", "u5", "u6", "u7"])], RATING_SCHEMA)
    row = R.movie_age_group_stats(r, users, movies).first().asDict()
    # ages 17 and -1 -> 0-18; 18, 34 -> 18-35; 35, 49 -> 35-50; 50 -> 50+
    assert (row["age_0_18_avg"], row["age_0_18_n"]) == (4.0, 2)
    assert (row["age_18_35_avg"], row["age_18_35_n"]) == (2.5, 2)
    assert (row["age_35_50_avg"], row["age_35_50_n"]) == (4.5, 2)
    assert (row["age_50_plus_avg"], row["age_50_plus_n"]) == (6.0, 1)


def test_age_group_empty_cells(ratings, users, movies):
    row = [r for r in R.movie_age_group_stats(ratings, users, movies).collect() if r.movie_id == "3"][0]
    assert (row.age_35_50_avg, row.age_35_50_n) == (3.0, 1)
    assert (row.age_0_18_avg, row.age_0_18_n, row.age_50_plus_avg, row.age_50_plus_n) == (None, 0, None, 0)


def test_occupation_inner_joins(ratings, users, occupations):
    got = {r.occupation_name: (r.avg_rating, r.n) for r in R.occupation_rating_stats(ratings, users, occupations).collect()}
    assert got == {
        "Programmer": (pytest.approx(13.5 / 3), 3),
        "Artist": (4.25, 2),
        "Doctor": (pytest.approx(11 / 3), 3),
    }  # Researcher has no ratings; user u7's occupation 9 is unknown


def test_occupation_duplicate_user_rows_multiply(spark, ratings, occupations):
    dup_users = spark.createDataFrame([("u1", "M", 20, "1", "z"), ("u1", "M", 20, "1", "z")], USER_SCHEMA)
    got = R.occupation_rating_stats(ratings, dup_users, occupations).collect()
    assert [(r.occupation_name, r.n) for r in got] == [("Programmer", 4)]


def test_year_boundary_and_zone_independence(spark, ratings):
    expect = [(2019, 4.0, 1), (2020, 4.0, 8)]
    got = [tuple(r) for r in R.yearly_rating_stats(ratings).collect()]
    assert [(y, n) for y, _, n in got] == [(y, n) for y, _, n in expect]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        again = [tuple(r) for r in R.yearly_rating_stats(ratings).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert again == got

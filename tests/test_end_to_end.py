"""Text files in the reference's formats -> ingest -> reports -> text lines."""

from __future__ import annotations

from conftest import lines

from marquee.plans import ratings as R
from marquee.plans import reviews as V
from marquee.plans import text_reports as TR
from marquee.session import scratch_path
from marquee.sources import records as REC
from marquee.sources import reviews as RV
from marquee.sources import sinks as SK


def _files(spark, name, *text):
    path = scratch_path(spark, name)
    lines(spark, *text).write.text(path)
    return path


def test_rating_reports_from_text_files(spark):
    movies = REC.ingest_movies(
        REC.scan_lines(
            spark,
            _files(
                spark,
                "movies",
                "1001,Psycho (1960),Horror|Mystery\r",
                "1002,The Good, the Bad and the Ugly (1966),Western\r",
                "1003,Unrated (2000),Drama\r",
            ),
        )
    ).rows
    ratings = REC.ingest_ratings(
        REC.scan_lines(
            spark,
            [
                _files(spark, "r1", "1,1001,4.0,1577836800", "2,1001,4.0,1577836800", "UserID,MovieID,Rating,Timestamp"),
                _files(spark, "r2", "3,1002,5.0,1577836799", "1,1002,4.5,1577836800", "1,9999,1.0,1577836800"),
            ],
        )
    ).rows
    users = REC.ingest_users(
        REC.scan_lines(spark, _files(spark, "users", "1,M,27,3,90210", "2,F,35,4,54321", "3,F,17,3,11111"))
    ).rows
    occupations = REC.ingest_occupations(
        REC.scan_lines(spark, _files(spark, "occ", "3,Programmer", "4,Doctor", "5,Researcher"))
    ).rows

    report = R.movie_rating_report(ratings, movies, min_ratings=2)
    got = [r.line for r in TR.movie_report_lines(report, 2).collect()]
    assert got == [
        "9999\tAverage Rating: 1.00\tTotal Ratings: 1",
        "Psycho (1960)\tAverage Rating: 4.00\tTotal Ratings: 2",
        "The Good, the Bad and the Ugly (1966)\tAverage Rating: 4.75\tTotal Ratings: 2",
        ">>> TOP RATED >>>\tThe Good, the Bad and the Ugly (1966) is the highest rated movie with an "
        "average rating of 4.75 among movies with at least 2 ratings (Total Ratings: 2).",
    ]
    none = R.movie_rating_report(ratings, movies, min_ratings=3)
    assert TR.movie_report_lines(none, 3).collect()[-1].line == ">>> TOP RATED >>>\tNo movie has at least 3 ratings."

    genres = [r.line for r in TR.average_lines(R.genre_rating_stats(ratings, movies), "genre").collect()]
    assert genres == [
        "Horror\tAverage Rating: 4.00\tTotal Ratings: 2",
        "Mystery\tAverage Rating: 4.00\tTotal Ratings: 2",
        "Western\tAverage Rating: 4.75\tTotal Ratings: 2",
    ]
    gender = [r.line for r in TR.gender_lines(R.movie_gender_stats(ratings, users, movies)).collect()]
    assert gender[1] == "Psycho (1960)\tM: 4.00 (n=1)\tF: 4.00 (n=1)"
    assert gender[0] == "9999\tM: 1.00 (n=1)\tF: NA (n=0)"
    ages = [r.line for r in TR.age_group_lines(R.movie_age_group_stats(ratings, users, movies)).collect()]
    assert ages[2] == (
        "The Good, the Bad and the Ugly (1966)\t0-18: 5.00 (n=1)\t18-35: 4.50 (n=1)\t35-50: NA (n=0)\t50+: NA (n=0)"
    )
    occ = [r.line for r in TR.average_lines(R.occupation_rating_stats(ratings, users, occupations), "occupation_name").collect()]
    assert occ == [
        "Doctor\tAverage Rating: 4.00\tTotal Ratings: 1",
        "Programmer\tAverage Rating: 3.62\tTotal Ratings: 4",
    ]
    years = [r.line for r in TR.average_lines(R.yearly_rating_stats(ratings), "year").collect()]
    assert years == ["2019\tAverage Rating: 5.00\tTotal Ratings: 1", "2020\tAverage Rating: 3.38\tTotal Ratings: 4"]

    zero = [r.line for r in TR.mr_gender_lines(R.movie_gender_stats_zero(ratings, users, movies)).collect()]
    assert zero == [
        "Psycho (1960)\tMale: 4.00, Female: 4.00",
        "The Good, the Bad and the Ugly (1966)\tMale: 4.50, Female: 5.00",
    ]
    mr_ages = [r.line for r in TR.mr_age_group_lines(R.movie_age_group_stats(ratings, users, movies)).collect()]
    assert mr_ages[1] == "Psycho (1960)\t0-18: NA  18-35: 4.00  35-50: 4.00  50+: NA"

    out = scratch_path(spark, "report_out")
    SK.write_text(TR.average_lines(R.genre_rating_stats(ratings, movies), "genre"), out, single_file=True)
    assert sorted(r.value for r in spark.read.text(out).collect()) == sorted(genres)


def test_review_reports_from_semicolon_file(spark):
    path = _files(
        spark,
        "hotel",
        "1;Giá rẻ, phòng đẹp;PRICES;HOTEL;positive",
        "2;phòng bẩn;COMFORT;ROOMS;negative",
        "3;giá cao;PRICES;HOTEL;negative",
    )
    reviews = RV.read_reviews(spark, path)
    top = [r.line for r in TR.csv_lines(V.topic_top_words(reviews), ["topic", "word", "freq"]).collect()]
    assert top == [
        "COMFORT,bẩn,1",
        "COMFORT,phòng,1",
        "PRICES,giá,2",
        "PRICES,cao,1",
        "PRICES,phòng,1",
        "PRICES,rẻ,1",
        "PRICES,đẹp,1",
    ]
    ext = [r.line for r in TR.csv_lines(V.sentiment_extreme_aspects(reviews), ["label", "aspect", "count"]).collect()]
    assert ext == ["MOST_NEGATIVE,HOTEL,1", "MOST_POSITIVE,HOTEL,1"]

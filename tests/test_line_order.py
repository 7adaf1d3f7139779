"""Line positions: the last line of a repeated key wins, and a header is looked for on a file's first line only."""

from __future__ import annotations

import os

import pytest

from conftest import rows
from marquee.functions.scalar import to_double, to_java_double
from marquee.operators.join import last_per_key, listed_once, lookup_with_fallback
from marquee.plans import ratings as R
from marquee.sources import records as REC


@pytest.fixture
def small_splits(spark):
    """Splits of a few lines, so that files span several splits and tasks hold several files."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def write(folder, name, *lines, end="\r\n"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write("".join(line + end for line in lines))
    return str(folder)


def test_last_line_wins_over_splits_files_and_paths(small_splits, tmp_path):
    spark = small_splits
    want = {}
    folders = [tmp_path / "z_first", tmp_path / "a_second"]
    for number, folder in enumerate(folders):
        for name in ("part-0", "part-1"):
            lines = [f"{k % 13},T{number}{name[-1]}{j:02d},G{j}" for j, k in enumerate(range(40, 0, -1))]
            write(folder, name, *lines)
            want |= {line.split(",")[0]: tuple(line.split(",")[1:]) for line in lines}
    lines = REC.scan_lines(spark, [str(f) for f in folders], position=True)
    assert lines.rdd.getNumPartitions() > 4
    movies = REC.ingest_movies(lines).rows
    last = {r.movie_id: (r.title, r.genres[0]) for r in last_per_key(movies, "movie_id").collect()}
    assert last == want
    facts = spark.createDataFrame([("5", 1), ("99", 2)], "movie_id string, n int")
    found = {r.movie_id: r.title for r in lookup_with_fallback(facts, movies, "movie_id", "title").collect()}
    assert found == {"5": want["5"][0], "99": "99"}


def test_without_positions_a_dimension_stays_as_it_is(spark):
    dim = spark.createDataFrame([("1", "M", 3), ("1", "F", 4)], "user_id string, gender string, age int")
    assert rows(listed_once(dim, "user_id", "gender")) == [("1", "F"), ("1", "M")]


def test_reports_count_a_repeated_user_and_occupation_by_the_last_line(spark, tmp_path):
    users = REC.ingest_users(REC.scan_lines(spark, write(tmp_path / "u", "f", "1,M,20,7,z", "1,F,60,8,z", "2,M,20,7,z"), position=True)).rows
    names = REC.ingest_occupations(REC.scan_lines(spark, write(tmp_path / "o", "f", "7,Old", "8,Baker", "7,New"), position=True)).rows
    movies = REC.ingest_movies(REC.scan_lines(spark, write(tmp_path / "m", "f", "m,First,A|B", "m,Last,C"), position=True)).rows
    ratings = spark.createDataFrame([("1", "m", 4.0, 0), ("2", "m", 2.0, 0)], "user_id string, movie_id string, rating double, ts bigint")
    assert rows(R.movie_gender_stats(ratings, users, movies)) == [("m", "Last", 2.0, 1, 4.0, 1)]
    assert rows(R.occupation_rating_stats(ratings, users, names)) == [("Baker", 4.0, 1), ("New", 2.0, 1)]
    assert rows(R.genre_rating_stats(ratings, movies)) == [("C", 3.0, 2)]
    ages = R.movie_age_group_stats(ratings, users, movies).first()
    assert (ages.age_18_35_n, ages.age_50_plus_n) == (1, 1)


HEADERS = {
    "plain": ["MovieID,Title,Genres", "1,A,x"],
    "blank": ["", "   ", "\t", "  movieID , Title, Genres", "2,B,x"],
    "none": ["3,C,x", "MovieID,Title,Genres", "4,D,x"],
    "inside": ["# the MovieID,Title,Genres", "5,E,x"],
    "long": ["6,F,x"] + [f"{k},long title of movie {k},x" for k in range(100, 130)] + ["movieid,in,middle"],
    "only_blank": [" ", ""],
    "empty": [],
}


@pytest.mark.parametrize("form", ["prefix", "contains"])
def test_header_on_the_first_line_of_each_file(small_splits, tmp_path, form):
    spark = small_splits
    want = []
    for name, lines in HEADERS.items():
        write(tmp_path / "in", name, *lines)
        said = [line.strip() for line in lines if line.strip()]
        if said:
            low = said[0].lower()
            said = said[1:] if (low.startswith("movieid") if form == "prefix" else "movieid" in low) else said
        want += [line.split(",")[0].strip() for line in said]
    lines = REC.scan_lines(spark, str(tmp_path / "in"), position=True, first_line=True)
    got = REC.ingest_movies(lines, first_line_only=True, header_form=form)
    assert sorted(r.movie_id for r in got.rows.collect()) == sorted(want)
    assert got.rejects.where("reason = 'header'").count() == (2 if form == "prefix" else 3)
    everywhere = REC.ingest_movies(lines)
    assert everywhere.rejects.where("reason = 'header'").count() == 4
    with pytest.raises(ValueError):
        REC.ingest_movies(lines, header_form="suffix")


def test_grammar_of_numbers(spark):
    texts = ["4.5f", "4.5D", "4.5", " 5 ", ".5", "1e3f", "0x1.8p1", "NaN", "Infinity", "-Infinity", "inf", "nan", "infinity", "4.5ff", "f", "", "1_0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    java = {r.t: str(r.v) for r in df.select("t", to_java_double("t").alias("v")).collect() if r.v is not None}
    assert java == {
        "4.5f": "4.5", "4.5D": "4.5", "4.5": "4.5", " 5 ": "5.0", ".5": "0.5", "1e3f": "1000.0", "0x1.8p1": "3.0",
        "NaN": "nan", "Infinity": "inf", "-Infinity": "-inf",
    }
    plain = {r.t for r in df.select("t", to_double("t").alias("v")).collect() if r.v is not None}
    assert "4.5" in plain and not plain & {"4.5f", "4.5D", "1e3f"}
    lines = spark.createDataFrame([("1,2,4.5f,0",)], "value string")
    assert [r.rating for r in REC.ingest_ratings(lines, min_fields=3).rows.collect()] == [4.5]
    assert REC.ingest_ratings(lines).rows.count() == 0

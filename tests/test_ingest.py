from __future__ import annotations

import itertools

from conftest import lines, rows
from pyspark.sql import functions as F

from marquee.functions.scalar import strip_ws
from marquee.sources import records as REC
from marquee.sources import reviews as RV
from marquee.sources import sinks as SK
from marquee.session import scratch_path


def test_movies_rejoin_titles_genres_and_rejects(spark):
    src = lines(
        spark,
        "MovieID,Title,Genres",  # header
        "  movieId, something",  # header in mixed case, not first line
        "",
        "   \r",
        "1043, Toy Story (1995), Animation|Children|Comedy\r",
        "7,Crouching Tiger, Hidden Dragon (2000),Action| |Drama|Action",
        "8,Short",  # too few fields
        " ,No Id,Drama",
        "9, ,Drama",
    )
    res = REC.ingest_movies(src)
    assert rows(res.rows) == [
        ("1043", "Toy Story (1995)", ["Animation", "Children", "Comedy"]),
        ("7", "Crouching Tiger, Hidden Dragon (2000)", ["Action", "Drama", "Action"]),
    ]
    reasons = sorted(r.reason for r in res.rejects.collect())
    assert reasons == ["blank", "blank", "blank_field", "blank_field", "header", "header", "too_few_fields"]


def test_movies_second_field_title_cuts_commas(spark):
    src = lines(spark, "7,Crouching Tiger, Hidden Dragon (2000),Action")
    res = REC.ingest_movies(src, title_mode="second_field")
    assert rows(res.rows, "title") == [("Crouching Tiger",)]


def test_movies_quoted_title(spark):
    src = lines(spark, '5,"The Good, the Bad and the ""Ugly""",Western', '6,Plain,Drama')
    res = REC.ingest_movies(src, quoted=True)
    assert rows(res.rows, "movie_id", "title") == [
        ("5", 'The Good, the Bad and the "Ugly"'),
        ("6", "Plain"),
    ]


def test_ratings_numbers_and_rejects(spark):
    src = lines(
        spark,
        "UserID,MovieID,Rating,Timestamp",
        "537, 1043, 4.0, 964982703\r",
        "7,1020,4.5,1577836800",
        "7,1020,abc,1577836800",
        "7,1020,4.5,12.5",  # timestamp must be an integer
        "7,1020,4.5",
        "\t",
    )
    res = REC.ingest_ratings(src)
    assert rows(res.rows) == [("537", "1043", 4.0, 964982703), ("7", "1020", 4.5, 1577836800)]
    reasons = sorted(r.reason for r in res.rejects.collect())
    assert reasons == ["bad_number", "bad_number", "blank", "header", "too_few_fields"]


def test_ratings_three_fields_variant_ignores_timestamp(spark):
    src = lines(spark, "7,1020,4.5", "7,1020,4.0,not-a-number", "7,1020")
    res = REC.ingest_ratings(src, min_fields=3)
    assert rows(res.rows, "rating", "ts") == [(4.0, None), (4.5, None)]
    assert [r.reason for r in res.rejects.collect()] == ["too_few_fields"]


def test_users_age_must_parse(spark):
    src = lines(spark, "UserID,Gender,Age,Occupation,Zip-code", "1,M,28,3,12345", "2,F,-1,4,999", "3,F,abc,4,1", "4,M,30,3")
    res = REC.ingest_users(src)
    assert rows(res.rows) == [("1", "M", 28, "3", "12345"), ("2", "F", -1, "4", "999")]
    assert sorted(r.reason for r in res.rejects.collect()) == ["bad_number", "header", "too_few_fields"]


def test_occupations_rejoin_and_headers(spark):
    src = lines(spark, "ID,Occupation", "OccupationID,Name", "1,Programmer", "2,Sales, Marketing", "3", "4, ")
    res = REC.ingest_occupations(src)
    assert rows(res.rows) == [("1", "Programmer"), ("2", "Sales, Marketing")]
    assert sorted(r.reason for r in res.rejects.collect()) == [
        "blank_field",
        "header",
        "header",
        "too_few_fields",
    ]


def test_scan_lines_unions_files(spark):
    a = scratch_path(spark, "lines_a")
    b = scratch_path(spark, "lines_b")
    lines(spark, "1,2,3.0,4", "dup").write.text(a)
    lines(spark, "dup").write.text(b)
    got = sorted(r.value for r in REC.scan_lines(spark, [a, b]).collect())
    assert got == ["1,2,3.0,4", "dup", "dup"]


def test_review_file_semicolon_no_quotes(spark):
    path = scratch_path(spark, "reviews")
    lines(
        spark,
        '1;Phòng "đẹp", sạch;COMFORT;ROOMS;positive',
        "2;short",
        "x;bad id;PRICES;HOTEL;negative",
        "3;a;b;c;d;extra;fields",
    ).write.text(path)
    got = {tuple(r) for r in RV.read_reviews(spark, path).collect()}
    assert got == {
        (1, 'Phòng "đẹp", sạch', "COMFORT", "ROOMS", "positive"),
        (2, "short", None, None, None),
        (None, "bad id", "PRICES", "HOTEL", "negative"),
        (3, "a", "b", "c", "d"),
    }


def test_review_comma_variant_four_columns(spark):
    path = scratch_path(spark, "reviews4")
    lines(spark, "great stay,GENERAL,HOTEL,positive").write.text(path)
    df = RV.read_reviews(spark, path, sep=",", schema=RV.REVIEW_SCHEMA_NO_ID)
    assert [tuple(r) for r in df.collect()] == [("great stay", "GENERAL", "HOTEL", "positive")]


def test_review_lines_from_stream_shape(spark):
    df = RV.parse_review_lines(lines(spark, "5;x y;T;A;negative"))
    assert [tuple(r) for r in df.collect()] == [(5, "x y", "T", "A", "negative")]


def test_stopwords_keep_duplicates_and_phrases(spark):
    path = scratch_path(spark, "sw")
    lines(spark, "và", "của", "và", "bởi vì", "là\tignored").write.text(path)
    assert sorted(r.word for r in RV.read_stopwords(spark, path, delimiter="\t").collect()) == sorted(
        ["và", "của", "và", "bởi vì", "là"]
    )


def test_quotes_count_only_at_the_start_of_a_field(spark):
    df = lines(
        spark,
        '5,The 5" Floppy,Drama',
        '6,"A, B",Drama',
        '7,"say ""hi"", you" there,X|Y',
        '8, "not quoted, here",Z',
        '9,"open, to the end,W',
    )
    got = {r.movie_id: r.title for r in REC.ingest_movies(df).rows.collect()}
    assert got == {"5": 'The 5" Floppy', "6": "A, B", "7": 'say "hi", you there', "8": '"not quoted, here"'}
    plain = {r.movie_id: r.title for r in REC.ingest_movies(df, title_mode="second_field").rows.collect()}
    assert plain["6"] == '"A'


def test_a_long_line_of_quotes_is_one_more_line(spark):
    df = lines(spark, "1," + '"' * 1_000_000 + ",Drama", '2,"' + '"",' * 300_000 + '",Drama', "3,ok,Drama")
    got = {r.movie_id: len(r.title) for r in REC.ingest_movies(df).rows.collect()}
    assert got["3"] == 2 and got["2"] == 600_000


def test_gender_lookup_needs_no_age(spark):
    df = lines(spark, "5,F", "6,M,xx", "7,F,33,1,z", "8")
    got = rows(REC.ingest_users(df, min_fields=2).rows, "user_id", "gender", "age")
    assert got == [("5", "F", None), ("6", "M", None), ("7", "F", 33)]


def test_timestamps_out_of_the_calendar_are_rejected(spark):
    df = lines(spark, "1,2,4.0,9223372036854775807", "1,2,4.0,964982703", "1,2,4.5f,964982703")
    res = REC.ingest_ratings(df)
    assert rows(res.rows, "ts") == [(964982703,)]
    assert rows(res.rejects, "reason") == [("bad_number",), ("bad_number",)]


def test_delimited_files_hold_the_values_as_they_are(spark, tmp_path):
    df = spark.createDataFrame([("a,b", "", None, 1), ('q"u', "x", "y\\", 2)], "a string, b string, c string, n int")
    SK.write_delimited(df, f"{tmp_path}/csv", sep=",", null_value="NULL")
    assert rows(spark.read.text(f"{tmp_path}/csv")) == [("a,b,,NULL,1",), ('q"u,x,y\\,2',)]
    SK.write_delimited(df, f"{tmp_path}/tsv", sep="\t", null_value="NULL")
    assert rows(spark.read.text(f"{tmp_path}/tsv"))[0] == ("a,b\t\tNULL\t1",)
    back = SK.read_delimited(spark, f"{tmp_path}/tsv", "a string, b string, c string, n int", null_value="NULL")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_a_line_is_made_and_split_once(spark):
    # the line's own expression, and what the parser makes of it, stand once in the plan
    made = spark.range(3).select(F.reverse(F.concat_ws(",", "id", "id", "id", "id", "id")).alias("value"))
    for res in (REC.ingest_ratings(made, min_fields=3), REC.ingest_ratings(made, quoted=False), REC.ingest_users(made, quoted=False), REC.ingest_movies(made, quoted=False), REC.ingest_occupations(made, quoted=False)):
        for df in (res.rows, res.rejects):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("reverse(") == 1
            assert plan.count("split(__text") == 1


def test_strip_ws_is_the_regular_expression(spark):
    pieces = ["", " ", "\t", "\r", "\n", "\x0b", "\f", "\x85", " ", " ", "\xa0", "a", "é b"]
    texts = ["".join(p) for n in range(4) for p in itertools.product(pieces, repeat=n)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "s string")
    assert df.where(~strip_ws("s").eqNullSafe(F.regexp_replace("s", r"^\s+|\s+$", ""))).count() == 0

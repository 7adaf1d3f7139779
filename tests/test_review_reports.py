from __future__ import annotations

import pytest

from marquee.operators.join import word_list_frame
from marquee.plans import reviews as V

SCHEMA = "id int, review string, topic string, aspect string, sentiment string"


@pytest.fixture()
def reviews(spark):
    data = [
        (1, "Giá rẻ, phòng đẹp (rất) đẹp", "PRICES", "HOTEL", "positive"),
        (1, "Giá rẻ, phòng đẹp (rất) đẹp", "PRICES", "ROOMS", "positive"),
        (2, "phòng BẨN*bẩn \"quá\"", "COMFORT", "ROOMS", "negative"),
        (3, "Nhân viên tốt", "GENERAL", "SERVICE", "positive"),
        (None, "không id", "GENERAL", "SERVICE", "negative"),
        (4, None, None, "HOTEL", "negative"),
        (5, "comment", "GENERAL", "HOTEL", "positive"),
        (0, "zero id row", "PRICES", "HOTEL", "positive"),
        (6, "ok", "PRICES", None, "negative"),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_review_tokens_bag_without_stopwords(spark, reviews):
    sw = word_list_frame(spark, ["rất", "rất", "quá", "giá rẻ"])
    got = [tuple(r) for r in V.review_tokens(reviews, sw).where("topic = 'PRICES' AND aspect = 'HOTEL' AND sentiment = 'positive'").collect()]
    words = sorted(w for w, *_ in got)
    # one row per occurrence; "rất" removed (duplicate list entry does not matter);
    # the two-word entry never matches a token
    assert words == sorted(["giá", "rẻ", "phòng", "đẹp", "đẹp", "zero", "id", "row"])
    neg = [r.word for r in V.review_tokens(reviews, sw).where("topic = 'COMFORT'").collect()]
    assert sorted(neg) == ["bẩn", "bẩn", "phòng"]  # '*' and quotes split, "quá" removed


def test_review_tokens_null_review_gives_no_rows(spark, reviews):
    sw = word_list_frame(spark, ["x"])
    assert V.review_tokens(reviews, sw).where("topic IS NULL").count() == 0


def test_frequent_words_threshold_is_exclusive_and_cleaning(spark):
    data = [(i, t, "T", "A", "positive") for i, t in enumerate(
        ["a,b a,b 7up", "ab x-y", "c\\d ab", "ab? ab.", "n2n"]
    )]
    df = spark.createDataFrame(data, SCHEMA)
    sw = word_list_frame(spark, ["up"])
    got = {r.word: r.freq for r in V.frequent_words(df, sw, min_freq=1).collect()}
    # "a,b" -> "ab" (punctuation deleted), digits/backslash/'-' -> blank
    assert got == {"ab": 6, "n": 2}
    assert {r.word for r in V.frequent_words(df, sw, min_freq=2).collect()} == {"ab"}
    assert V.frequent_words(df, sw, min_freq=6).count() == 0  # equal to the threshold: excluded


def test_comments_count_distinct_ids(reviews):
    got = {r.aspect: r.num_comments for r in V.comments_by_aspect(reviews).collect()}
    # id 1 appears twice for HOTEL? no: once per (id, aspect); NULL id not counted
    assert got == {"HOTEL": 4, "ROOMS": 2, "SERVICE": 1, None: 1}
    topics = {r.topic: r.num_comments for r in V.comments_by_topic(reviews).collect()}
    assert topics == {"PRICES": 3, "COMFORT": 1, "GENERAL": 2, None: 1}


def test_sentiment_extremes_count_rows_and_break_ties(spark):
    data = [
        (1, "x", "T", "ROOMS", "negative"),
        (2, "x", "T", "ROOMS", "negative"),
        (3, "x", "T", "FOOD", "negative"),
        (4, "x", "T", "FOOD", "negative"),
        (5, "x", "T", "HOTEL", "positive"),
        (5, "x", "T", "HOTEL", "positive"),
        (6, "comment", "T", "SERVICE", "positive"),
        (7, "comment", "T", "SERVICE", "positive"),
        (8, "x", "T", "SERVICE", "positive"),
        (9, None, "T", "SERVICE", "positive"),
        (10, "x", "T", None, "positive"),
        (11, "x", "T", None, "positive"),
        (12, "x", "T", None, "positive"),
    ]
    got = [tuple(r) for r in V.sentiment_extreme_aspects(spark.createDataFrame(data, SCHEMA)).collect()]
    # FOOD/ROOMS tie at 2: smaller name. Header and NULL-review rows dropped.
    # NULL aspect rows count 0 (bag COUNT skips NULL first fields).
    assert got == [("MOST_NEGATIVE", "FOOD", 2), ("MOST_POSITIVE", "HOTEL", 2)]


def test_top_words_ties_at_rank_five(spark):
    text = "e e e d d c c b b a a z"
    df = spark.createDataFrame([(1, text, "P", "A", "positive"), (2, "q q", "P", "A", "negative")], SCHEMA)
    got = [(r.word, r.freq) for r in V.topic_top_words(df).collect()]
    # b, c, d, a all have 2: ranks 2..5 go to a, b, c, d (word order); q has 2 too
    assert got == [("e", 3), ("a", 2), ("b", 2), ("c", 2), ("d", 2)]
    both = [tuple(r) for r in V.topic_sentiment_top_words(df).collect()]
    assert both[0] == ("positive", "P", "e", 3)
    assert ("negative", "P", "q", 2) in both and len(both) == 6


def test_top_words_drop_id_zero_and_headers(reviews):
    words = {r.word for r in V.topic_sentiment_top_words(reviews).collect()}
    assert "zero" not in words  # id 0 dropped
    assert "không" not in words  # NULL id dropped
    assert "comment" not in words  # header row dropped
    all_words = {r.word for r in V.topic_top_words(reviews, k=20).collect()}
    assert "zero" in all_words and "không" in all_words and "comment" not in all_words


def test_top_words_null_topic_counts_zero(spark):
    df = spark.createDataFrame([(1, "w w", None, "A", "positive")], SCHEMA)
    assert [tuple(r) for r in V.topic_top_words(df).collect()] == [(None, "w", 0)]


def test_top_words_without_stopwords(spark):
    df = spark.createDataFrame([(1, "the the cat dog cat the", "t", "a", "positive")], SCHEMA)
    sw = word_list_frame(spark, ["the"])
    assert [r.word for r in V.topic_top_words(df, k=1).collect()] == ["the"]
    assert [r.word for r in V.topic_top_words(df, k=1, stopwords=sw).collect()] == ["cat"]
    assert [r.word for r in V.topic_sentiment_top_words(df, k=1, stopwords=sw).collect()] == ["cat"]

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marquee.functions.scalar import age_group, epoch_year, strip_ws, to_double
from marquee.functions.text import clean_text, delimiter_pattern, tokenize
from marquee.operators.aggregate import avg_count, conditional_stats, count_distinct_ids, count_non_null, merge_sum_count, sum_count
from marquee.operators import join as J
from marquee.operators.join import anti_join, left_outer, lookup_with_fallback, prefiltered_left_join, salted_join, word_list_frame
from marquee.operators.reshape import explode_list, fold_bags, group_bags, top_k_bag, unnest_group
from marquee.operators.topk import top_k_per_group, with_order_rank
from marquee.plans import text_reports as TR

from conftest import rows


def test_strip_handles_cr_and_tabs(spark):
    df = spark.createDataFrame([(" \t a b \r\n",)], "s string")
    assert df.select(strip_ws("s")).first()[0] == "a b"


def test_tokenize_pig_delimiters(spark):
    df = spark.createDataFrame([('(a,b) "c"*d  e\tf\ng',)], "s string")
    assert df.select(tokenize("s")).first()[0] == ["a", "b", "c", "d", "e", "f", "g"]
    assert delimiter_pattern(' ",()*') == '[ ",()*]+'


def test_clean_text_order(spark):
    df = spark.createDataFrame([("a,b? 10% x-y c\\d e@f <g>",)], "s string")
    assert df.select(clean_text("s")).first()[0] == "ab     x y c d ef  g "


def test_age_group_and_year(spark):
    df = spark.createDataFrame([(a,) for a in (-1, 17, 18, 34, 35, 49, 50, None)], "a int")
    assert [r[0] for r in df.select(age_group("a")).collect()] == [
        "0-18", "0-18", "18-35", "18-35", "35-50", "35-50", "50+", None
    ]
    ts = spark.createDataFrame([(-1,), (0,), (1577836799,), (1577836800,)], "t bigint")
    assert [r[0] for r in ts.select(epoch_year("t")).collect()] == [1969, 1970, 2019, 2020]


def test_number_text_half_up_and_half_even(spark):
    df = spark.createDataFrame([(4.25,), (None,), (3.14159,)], "x double")
    half_up = df.select(TR.fmt_number(F.col("x"), 1, "half_up")).collect()
    assert [r[0] for r in half_up] == ["4.3", "NA", "3.1"]
    half_even = df.select(TR.fmt_number(F.col("x"), 1, "half_even")).collect()
    assert [r[0] for r in half_even] == ["4.2", "NA", "3.1"]


def test_conditional_stats_missing_cells(spark):
    df = spark.createDataFrame([("m1", "M", 4.0), ("m1", "m", 2.0), ("m2", "X", 1.0)], "k string, g string, rating double")
    exact = {r.k: tuple(r)[1:] for r in conditional_stats(df, ["k"], "g", [("M", "m"), ("F", "f")]).collect()}
    assert exact == {"m1": (4.0, 1, None, 0), "m2": (None, 0, None, 0)}
    loose = {
        r.k: tuple(r)[1:]
        for r in conditional_stats(df, ["k"], "g", [("M", "m")], missing_avg=0.0, ignore_case=True).collect()
    }
    assert loose == {"m1": (3.0, 2), "m2": (0.0, 0)}


def test_count_non_null_keeps_group(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), ("t", "a")], "first string, k string")
    got = {(r.first, r.k): r.n for r in count_non_null(df, ["first", "k"], "first", "n").collect()}
    assert got == {(None, "a"): 0, ("t", "a"): 1}


def test_anti_join_null_survives_duplicates_harmless(spark):
    toks = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "word string")
    sw = word_list_frame(spark, ["a", "a"])
    assert sorted(r.word or "" for r in anti_join(toks, sw, "word").collect()) == ["", "b"]
    outer = left_outer(toks, sw, "word", "stop")
    assert outer.where("stop IS NOT NULL").count() == 4  # each 'a' matches both list entries


def test_lookup_falls_back_to_key(spark):
    facts = spark.createDataFrame([("1",), ("2",)], "movie_id string")
    dim = spark.createDataFrame([("1", "One")], "movie_id string, title string")
    got = sorted(tuple(r) for r in lookup_with_fallback(facts, dim, "movie_id", "title").collect())
    assert got == [("1", "One"), ("2", "2")]


def test_explode_list_blank_and_repeat(spark):
    df = spark.createDataFrame([("1", "Action| |Drama||Action ")], "id string, g string")
    got = [r.genre for r in explode_list(df, "g", "genre", ["id"], separator="|").collect()]
    assert got == ["Action", "Drama", "Action"]


def test_top_k_and_top_k_bag(spark):
    df = spark.createDataFrame([("t", w, f) for w, f in [("a", 3), ("b", 3), ("c", 1), ("d", 5)]], "topic string, word string, freq int")
    top = top_k_per_group(df, ["topic"], [F.desc("freq"), F.asc("word")], 2, rank_col="rank")
    assert [(r.word, r.rank) for r in top.orderBy("rank").collect()] == [("d", 1), ("a", 2)]
    bag = top_k_bag(df, ["topic"], [F.desc("freq"), F.asc("word")], 3, ["word", "freq"])
    assert [(e.word, e.freq) for e in bag.first().bag] == [("d", 5), ("a", 3), ("b", 3)]
    flat = unnest_group(bag, ["topic"])
    assert flat.columns == ["topic", "word", "freq"] and flat.count() == 3


def test_global_rank_across_partitions(spark):
    df = spark.range(0, 1000, numPartitions=7).select(((F.col("id") * 7919) % 1000).alias("k"))
    ranked = with_order_rank(df, [F.desc("k")])
    got = sorted((r.rank, r.k) for r in ranked.collect())
    assert got == [(i + 1, 999 - i) for i in range(1000)]


def test_text_report_lines(spark):
    stats = spark.createDataFrame([("Psycho (1960)", 4.0, 2)], "title string, avg_rating double, n bigint")
    assert TR.average_lines(stats, "title").first().line == "Psycho (1960)\tAverage Rating: 4.00\tTotal Ratings: 2"
    g = spark.createDataFrame([("Psycho (1960)", None, 0, 4.0, 2)], "title string, m_avg double, m_n bigint, f_avg double, f_n bigint")
    assert TR.gender_lines(g).first().line == "Psycho (1960)\tM: NA (n=0)\tF: 4.00 (n=2)"
    mr = spark.createDataFrame([("Toy Story (1995)", 4.25, 2)], "title string, avg_rating double, n bigint")
    assert TR.mr_movie_lines(mr).first().line == "Toy Story (1995)\tAverage rating: 4.3 (Total ratings: 2)"


def test_two_decimals_as_the_exact_binary_value_rounds(spark):
    values = sorted({k / 2 / n for n in (8, 40, 100, 120, 200, 400) for k in range(0, 10 * n + 1, 1 + n // 60)})
    values += [2.675, 2.345, 4.125, 1.015, 0.995, 0.005, 0.015, 99.995, 1e-9, -2.675, -0.125, 123456789.125, 2.0**53, 1e17]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select("x", TR.fmt_number(F.col("x")).alias("t"), TR.fmt_number(F.col("x"), 1).alias("t1")).collect()
    assert [(r.t, r.t1) for r in got] == [(f"{r.x:.2f}", f"{r.x:.1f}") for r in got]


def test_numbers_years_and_counts_at_the_edges(spark):
    df = spark.createDataFrame([("4.5f",), ("4.5d",), ("4.",), ("inf",), (" 3 ",), ("1e3",)], "x string")
    assert [r[0] for r in df.select(to_double(strip_ws("x"))).collect()] == [None, None, 4.0, float("inf"), 3.0, 1000.0]
    ts = spark.createDataFrame([(9223372036854775807,), (-9223372036854775808,), (253402300799,), (-62135596800,)], "t bigint")
    assert [r[0] for r in ts.select(epoch_year("t")).collect()] == [None, None, 9999, 1]
    rated = spark.createDataFrame([("m", 4.0), ("m", None)], "movie_id string, rating double")
    assert tuple(avg_count(rated, ["movie_id"]).first()) == ("m", 4.0, 1)
    assert tuple(merge_sum_count(sum_count(rated, ["movie_id"]), ["movie_id"]).first()) == ("m", 4.0, 1)


def test_a_key_listed_twice_gives_one_row(spark):
    facts = spark.createDataFrame([("m", 1), ("x", 2)], "k string, v int")
    dim = spark.createDataFrame([("m", "Old"), ("m", "New"), ("m", None)], "k string, title string")
    assert rows(lookup_with_fallback(facts, dim, "k", "title"), "k", "title") == [("m", "Old"), ("x", "x")]


def test_salted_join_splits_a_hot_key(spark):
    facts = spark.range(2000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    dim = spark.createDataFrame([("hot", "h"), ("cold", "c")], "k string, d string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(facts, dim, "k", "v")
        assert joined.count() == 2000 and joined.columns == ["k", "v", "d"]
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 4 and max(r["count"] for r in sizes) < 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_whole_groups_as_bounded_bags(spark):
    """A hot key with over a third of all rows, equal rows, NULL keys and fields."""
    data = [(None if k % 50 == 0 else ("hot" if k % 5 < 2 else f"k{k % 7}"), None if k % 11 == 0 else k % 4, "x") for k in range(1000)]
    df = spark.createDataFrame(data, "key string, v int, chunk string").repartition(5)
    bags = group_bags(df, ["key"], ["v"], chunk_rows=30)
    assert bags.columns == ["key", "chunk", "bag"]
    held = bags.collect()
    assert max(len(r.bag) for r in held) == 30
    assert len({(r.key, r.chunk) for r in held}) == len(held)
    assert sum(r.key == "hot" for r in held) > 5
    order = lambda t: (t[0] or "", t[1] is None, t[1] or 0)
    assert sorted(map(tuple, unnest_group(bags, ["key"]).collect()), key=order) == sorted(((k, v) for k, v, _ in data), key=order)

    total = F.aggregate("bag", F.lit(0), lambda acc, e: acc + F.coalesce(e["v"], F.lit(0)))
    folded = fold_bags(bags, ["key"], {"total": (total, F.sum("total")), "n": (F.size("bag"), F.sum("n"))})
    want = {}
    for k, v, _ in data:
        want[k] = (want.get(k, (0, 0))[0] + (v or 0), want.get(k, (0, 0))[1] + 1)
    assert {r.key: (r.total, r.n) for r in folded.collect()} == want
    assert group_bags(df.where("false"), ["key"], ["v"]).count() == 0


def test_a_hot_group_is_nested_by_several_tasks(spark):
    df = spark.range(8000, numPartitions=8).select(F.lit("hot").alias("key"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        bags = group_bags(df, ["key"], ["id"], chunk_rows=500).withColumn("task", F.spark_partition_id())
        per_task = {r.task: r.n for r in bags.groupBy("task").agg(F.sum(F.size("bag")).alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_task) > 1 and sum(per_task.values()) == 8000


@pytest.fixture
def shuffled_joins(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_only_facts_that_may_match_are_shuffled(shuffled_joins):
    spark = shuffled_joins
    facts = spark.createDataFrame([(None if k % 97 == 0 else k % 3000 - 500, f"text {k}") for k in range(4000)], "id bigint, text string")
    dim = spark.createDataFrame([(k, "p" if k % 2 else None) for k in range(-10, 200, 3)] + [(5, "again"), (None, "no id"), (10**12, "far")], "id bigint, sentiment string")
    order = lambda t: tuple((x is not None, x) for x in t)
    plain = sorted(map(tuple, facts.join(dim, "id", "left").collect()), key=order)
    for bits in (1 << 27, 1 << 15):
        joined = prefiltered_left_join(facts, dim, "id", bits)
        assert joined.columns == ["id", "text", "sentiment"]
        assert sorted(map(tuple, joined.collect()), key=order) == plain
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan
    inner = joined.where(F.col("sentiment").isin("p"))
    assert "Union" not in inner._jdf.queryExecution().optimizedPlan().toString()
    sent = J._with_maybe(facts, dim.select("id"), "id", 1 << 27).where("__maybe")
    known = {r.id for r in dim.collect()}
    assert {r.id for r in sent.collect()} == {r.id for r in facts.collect() if r.id in known and r.id is not None}
    none = prefiltered_left_join(facts, dim.where("false"), "id")
    assert none.count() == 4000 and none.where("sentiment is not null").count() == 0


def test_a_small_dimension_is_joined_plainly(spark):
    df = spark.range(5).withColumn("v", F.lit("a"))
    assert "bitmap" not in prefiltered_left_join(df, df.select("id", F.lit(1).alias("w")), "id")._jdf.queryExecution().optimizedPlan().toString()


def test_distinct_ids_by_bitmaps(spark):
    dense = [(f"k{k % 3}" if k % 10 else None, (k * 7) % 40_000 - 200 if k % 13 else None) for k in range(60_000)] + [("only null", None)]
    sparse = [("a", 2**62), ("a", -(2**62)), ("a", 2**62), ("b", 0), ("b", None)]
    for data, by_bitmap in ((dense, True), (sparse, False), ([], False)):
        df = spark.createDataFrame(data, "key string, id bigint")
        counted = count_distinct_ids(df, "key", "id", "n")
        assert ("bitmap" in counted._jdf.queryExecution().optimizedPlan().toString()) == by_bitmap
        want = {}
        for k, i in data:
            want.setdefault(k, set()).update({i} - {None})
        assert {r.key: r.n for r in counted.collect()} == {k: len(v) for k, v in want.items()}
    text = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y")], "key string, id string")
    assert count_distinct_ids(text, "key", "id", "n").first().n == 2

"""A hot key (a third or more of all rows) must give exact results."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import join as J
from marquee.plans import ratings as R
from marquee.plans import reviews as V


def test_hot_user_and_movie(spark):
    n = 3000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("user_id"),
        F.when(F.col("id") % 2 == 0, F.lit("m0")).otherwise((F.col("id") % 13).cast("string")).alias("movie_id"),
        ((F.col("id") % 10) / 2).alias("rating"),
        F.lit(0).cast("bigint").alias("ts"),
    )
    users = (
        base.select("user_id").distinct()
        .withColumn("gender", F.when(F.col("user_id") == "hot", "F").otherwise("M"))
        .withColumn("age", F.lit(30))
        .withColumn("occupation_id", F.when(F.col("user_id") == "hot", "1").otherwise("2"))
        .withColumn("zip_code", F.lit("z"))
    )
    occupations = spark.createDataFrame([("1", "A"), ("2", "B")], "occupation_id string, occupation_name string")
    movies = spark.createDataFrame([("m0", "Zero", ["G"])], "movie_id string, title string, genres array<string>")

    local = [tuple(r) for r in base.collect()]
    hot = [r for r in local if r[0] == "hot"]
    occ = {r.occupation_name: (r.avg_rating, r.n) for r in R.occupation_rating_stats(base, users, occupations).collect()}
    assert occ["A"][1] == len(hot) == n // 3
    assert abs(occ["A"][0] - sum(r[2] for r in hot) / len(hot)) < 1e-12

    g = {r.movie_id: r for r in R.movie_gender_stats(base, users, movies).collect()}
    m0 = [r for r in local if r[1] == "m0"]
    assert g["m0"].f_n == sum(1 for r in m0 if r[0] == "hot")
    assert g["m0"].m_n == sum(1 for r in m0 if r[0] != "hot")


def test_hot_topic_top_words(spark):
    rows = [(i, "a b c d e f" if i % 2 else "a a b", "HOT" if i < 900 else "COLD", "X", "positive") for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, review string, topic string, aspect string, sentiment string")
    got = {(r.topic, r.word): r.freq for r in V.topic_top_words(df).collect()}
    # brute force
    counts: dict = {}
    for _, text, topic, *_ in rows:
        for w in text.split():
            counts[(topic, w)] = counts.get((topic, w), 0) + 1
    for topic in ("HOT", "COLD"):
        expect = sorted(((k[1], v) for k, v in counts.items() if k[0] == topic), key=lambda t: (-t[1], t[0]))[:5]
        assert sorted((w, f) for (t, w), f in got.items() if t == topic) == sorted(expect)


def test_only_heavy_users_are_split(spark):
    """A user with a third of all ratings is dealt over several tasks; every other user is sent once."""
    n = 6000
    facts = spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("user_id"),
        (F.col("id") % 301).cast("string").alias("movie_id"),
        F.col("id").alias("rating"),
    )
    users = spark.range(2000).select(F.col("id").cast("string").alias("user_id"), F.lit("M").alias("gender"))
    users = users.unionAll(spark.createDataFrame([("hot", "F")], "user_id string, gender string"))
    want = sorted(map(tuple, facts.join(users, "user_id").collect()))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert J.heavy_keys(facts, "user_id") == ["hot"]
        assert J.heavy_keys(facts.where("user_id <> 'hot'"), "user_id") == []
        assert J.heavy_keys(facts.where("false"), "user_id") == []
        assert J.repeat_heavy(users, "user_id", ["hot"]).count() == 2001 + J.SALTS - 1
        joined = J.split_heavy_join(facts, users, "user_id", "movie_id")
        per_task = {r.task: r.n for r in joined.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()}
        assert sorted(map(tuple, joined.collect())) == want
        assert max(per_task.values()) < n / 4 < max(r["count"] for r in facts.groupBy("user_id").count().collect())
        plain = J.split_heavy_join(facts.where("user_id <> 'hot'"), users, "user_id", "movie_id")
        assert "__salt" not in plain._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "__salt" not in J.split_heavy_join(facts, users.limit(5), "user_id", "movie_id")._jdf.queryExecution().optimizedPlan().toString()

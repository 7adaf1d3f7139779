"""Ingest, sink and operator checks over the parquet test tables.

Each function takes (spark, sf_dir) and returns a DataFrame over the whole
tables. Text inputs are rendered from the tables with ``concat_ws`` (so the
typed table is the oracle), plus a handful of fixed noise lines (header,
blank, short, non-numeric) that must all be rejected. Files are written
below the session's checkpoint folder, never to a machine-local path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.functions.scalar import age_group, is_header, strip_ws
from marquee.functions.text import clean_text, lower_trim, tokenize
from marquee.operators.aggregate import avg_count, count_non_null
from marquee.operators.join import anti_join, left_outer, lookup_with_fallback
from marquee.operators.reshape import explode_list, explode_tokens, fold_bags, group_bags, top_k_bag, unnest_group
from marquee.operators.topk import top_one, with_order_rank
from marquee.plans import ratings as R
from marquee.plans import reviews as V
from marquee.plans import text_reports as TR
from marquee.session import scratch_path
from marquee.sources import records as REC
from marquee.sources import reviews as RV
from marquee.sources import sinks as SK
from marquee.sources import testdata as T

# Noise lines injected into rendered text inputs.
MOVIE_NOISE = ("MovieID,Title,Genres", "  movieid, title", "", "   \r", "12345", " ,No Id,Drama", "777, ,Drama")
RATING_NOISE = (
    "UserID,MovieID,Rating,Timestamp",
    "userid;movieid",
    "",
    "\t",
    "1,2,3",
    "1,2,abc,964982703",
    "1,2,4.0,12.5",
    "1,2,4.0,",
)
USER_NOISE = ("UserID,Gender,Age,Occupation,Zip-code", "", "5,F,abc,3,12345", "6,M,30,3")
OCCUPATION_NOISE = ("ID,Occupation", "OccupationID,Name", "", "9", "10, ")
REVIEW_NOISE = ("1;short", "x1;bad id;en;src0;positive", "2;extra;en;src1;negative;more;fields")


def _noise(spark: SparkSession, lines: tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame([(s,) for s in lines], "value string")


def _write_lines(df: DataFrame, spark: SparkSession, name: str) -> str:
    path = scratch_path(spark, name)
    df.select("value").write.mode("overwrite").text(path)
    return path


def _movie_lines(spark: SparkSession, d: str) -> DataFrame:
    """``id, title, genres`` with a comma in every title, blank list elements and CRLF."""
    part = T.table(spark, d, "part")
    genres = F.regexp_replace(F.col("p_name"), " ", "| |")
    title = F.concat(F.col("p_name"), F.lit(", "), F.col("p_brand"))
    line = F.concat(F.concat_ws(", ", F.col("p_partkey").cast("string"), title, genres), F.lit("\r"))
    return part.select(line.alias("value"))


def _rating_lines(spark: SparkSession, d: str) -> DataFrame:
    li = T.table(spark, d, "lineitem")
    ts = T._epoch_seconds("l_shipdate")
    line = F.concat_ws(
        ",",
        F.col("l_orderkey").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_quantity").cast("string"),
        ts.cast("string"),
    )
    return li.select(line.alias("value"), "l_linestatus")


# ---------------------------------------------------------------- ingest


def ingest_movies(spark: SparkSession, d: str) -> DataFrame:
    lines = _movie_lines(spark, d).unionByName(_noise(spark, MOVIE_NOISE))
    rows = REC.ingest_movies(lines).rows
    return rows.select("movie_id", "title", F.array_join("genres", "|").alias("genres"))


def ingest_quoted(spark: SparkSession, d: str) -> DataFrame:
    part = T.table(spark, d, "part")
    quoted_title = F.when(
        F.col("p_size") % 2 == 0, F.concat(F.lit('"'), F.col("p_name"), F.lit(', ""'), F.col("p_brand"), F.lit('"""'))
    ).otherwise(F.concat(F.lit('The 5" '), F.col("p_name"), F.lit(', "'), F.col("p_brand")))
    line = F.concat_ws(",", F.col("p_partkey").cast("string"), quoted_title, F.regexp_replace("p_name", " ", "|"))
    lines = part.select(line.alias("value")).unionByName(_noise(spark, MOVIE_NOISE))
    rows = REC.ingest_movies(lines, quoted=True).rows
    return rows.select("movie_id", "title", F.array_join("genres", "|").alias("genres"))


def ingest_movies_second_field(spark: SparkSession, d: str) -> DataFrame:
    """Titles as the second field only: what follows a comma in the title is cut."""
    lines = _movie_lines(spark, d).unionByName(_noise(spark, MOVIE_NOISE))
    return REC.ingest_movies(lines, title_mode="second_field").rows.select("movie_id", "title")


def ingest_ratings_three_fields(spark: SparkSession, d: str) -> DataFrame:
    """Ratings that need no timestamp: lines without one, or with a bad one, stay, and so do numbers with a type suffix."""
    li = T.table(spark, d, "lineitem")
    suffix = F.when(F.col("l_linenumber") == 1, F.lit("f")).when(F.col("l_linenumber") == 2, F.lit("D")).otherwise(F.lit(""))
    quantity = F.concat(F.col("l_quantity").cast("string"), suffix)
    fields = [F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), quantity]
    line = F.when(F.col("l_tax") == 0, F.concat_ws(",", *fields)).otherwise(F.concat_ws(",", *fields, F.lit("x")))
    lines = li.select(line.alias("value")).unionByName(_noise(spark, RATING_NOISE))
    return REC.ingest_ratings(lines, min_fields=3).rows.select("user_id", "movie_id", "rating")


def ingest_user_genders(spark: SparkSession, d: str) -> DataFrame:
    """Id-to-gender lookup: two fields are enough, and a bad age rejects nothing."""
    c = T.table(spark, d, "customer")
    key, gender = F.col("c_custkey").cast("string"), F.substring("c_mktsegment", 1, 1)
    age = F.when(F.col("c_nationkey") % 3 == 0, F.lit("xx")).otherwise(F.floor(F.col("c_acctbal") / 100).cast("string"))
    line = F.when(F.col("c_nationkey") % 2 == 0, F.concat_ws(",", key, gender)).otherwise(F.concat_ws(",", key, gender, age))
    lines = c.select(line.alias("value")).unionByName(_noise(spark, USER_NOISE))
    return REC.ingest_users(lines, min_fields=2).rows.select("user_id", "gender", "age")


def ingest_reviews_comma(spark: SparkSession, d: str) -> DataFrame:
    """The 4-column, comma-separated review file without ids, parsed line by line."""
    reviews = T.reviews(spark, d)
    text = F.regexp_replace(F.col("review"), "[,\r\n]", " ")
    line = F.concat_ws(",", text, "topic", "aspect", F.coalesce("sentiment", F.lit("")))
    path = _write_lines(reviews.select(line.alias("value")), spark, "reviews_comma")
    return RV.read_reviews(spark, path, sep=",", schema=RV.REVIEW_SCHEMA_NO_ID)


def movie_lines_by_id(spark: SparkSession, d: str) -> DataFrame:
    """The MapReduce report lines (one decimal) numbered in order of the movie id as text."""
    stats = R.movie_rating_stats(T.ratings(spark, d), T.movies(spark, d), ordered=False)
    ranked = with_order_rank(stats, [F.asc("movie_id")])
    line = TR.mr_movie_line()
    return ranked.select("rank", line.alias("line"))


def _write_in_order(lines: DataFrame, spark: SparkSession, name: str) -> str:
    """(value, file, seq) as text files, one per ``file``, with their lines in order of ``seq``."""
    path = scratch_path(spark, name)
    ordered = lines.repartition("file").sortWithinPartitions("file", "seq").select("value", "file")
    ordered.write.partitionBy("file").text(path)
    return path


def _listing_files(spark: SparkSession, d: str) -> list[str]:
    """Two folders of movie files in which many movies are listed again further down, or in the second folder.

    A file holds the parts of 200 numbers. Every third one starts with a blank
    line and a header, every third with a line that holds the header's name
    further on; all have a header-like line among the records.
    """
    part = T.table(spark, d, "part")
    file = F.floor(F.col("p_partkey") / 200)
    genres, key = F.regexp_replace("p_name", " ", "|"), F.col("p_partkey").cast("string")

    def listed(rows: DataFrame, title, seq) -> DataFrame:
        return rows.select(F.concat_ws(",", key, title, genres).alias("value"), file.alias("file"), seq.alias("seq"))

    files = part.select(file.alias("file")).distinct()
    top = F.when(F.col("file") % 3 == 0, F.lit("MovieID,Title,Genres")).otherwise(F.lit("List of MovieID,and title,and genres"))
    first = listed(part.where("p_size <= 40"), F.col("p_name"), F.col("p_partkey"))
    first = first.unionAll(listed(part.where("p_size <= 25"), F.col("p_type"), 10**12 - F.col("p_partkey")))
    first = first.unionAll(files.where("file % 3 < 2").select(top.alias("value"), "file", F.lit(-1).cast("bigint").alias("seq")))
    first = first.unionAll(files.where("file % 3 = 0").select(F.lit("  ").alias("value"), "file", F.lit(-2).cast("bigint").alias("seq")))
    middle = F.concat(F.lit("movieid "), F.col("file").cast("string"), F.lit(",middle,a|b"))
    first = first.unionAll(files.select(middle.alias("value"), "file", (F.col("file") * 200 + 100).alias("seq")))
    second = listed(part.where("p_size <= 10"), F.col("p_brand"), F.col("p_partkey"))
    return [_write_in_order(first, spark, "listing_1"), _write_in_order(second, spark, "listing_2")]


def ingest_movies_first_line(spark: SparkSession, d: str) -> DataFrame:
    """The header test on the first non-blank line of each file only; header-like lines further down are records."""
    lines = REC.scan_lines(spark, _listing_files(spark, d), first_line=True)
    rows = REC.ingest_movies(lines, first_line_only=True).rows
    return rows.select("movie_id", "title", F.array_join("genres", "|").alias("genres"))


def ingest_movies_first_line_contains(spark: SparkSession, d: str) -> DataFrame:
    """The same with the form that looks for the header's name anywhere in the line."""
    lines = REC.scan_lines(spark, _listing_files(spark, d), first_line=True)
    rows = REC.ingest_movies(lines, first_line_only=True, header_form="contains").rows
    return rows.select("movie_id", "title", F.array_join("genres", "|").alias("genres"))


def _listed_movies(spark: SparkSession, d: str) -> DataFrame:
    return REC.ingest_movies(REC.scan_lines(spark, _listing_files(spark, d), position=True)).rows


def movie_rating_stats_last_listed(spark: SparkSession, d: str) -> DataFrame:
    """Per-movie statistics with the title that was listed last; movies never listed fall back to the id."""
    return R.movie_rating_stats(T.ratings(spark, d), _listed_movies(spark, d), ordered=False)


def genre_rating_stats_last_listed(spark: SparkSession, d: str) -> DataFrame:
    """Per-genre statistics with each movie's genres as listed last: a repeated movie counts once."""
    movies = _listed_movies(spark, d)
    last_word = F.slice("genres", -1, 1)
    retitled = movies.withColumn("genres", F.when(F.col("title").startswith("Brand"), last_word).otherwise(F.col("genres")))
    return R.genre_rating_stats(T.ratings(spark, d), retitled, ordered=False)


def ingest_user_ages(spark: SparkSession, d: str) -> DataFrame:
    """Id-to-age lookup: three fields are enough, and an age that is no number rejects the line."""
    c = T.table(spark, d, "customer")
    key, gender = F.col("c_custkey").cast("string"), F.substring("c_mktsegment", 1, 1)
    age = F.when(F.col("c_nationkey") % 3 == 0, F.lit("xx")).otherwise(F.floor(F.col("c_acctbal") / 100).cast("string"))
    line = F.when(F.col("c_nationkey") % 5 == 0, F.concat_ws(",", key, gender)).otherwise(F.concat_ws(",", key, gender, age))
    lines = c.select(line.alias("value")).unionByName(_noise(spark, USER_NOISE))
    return REC.ingest_users(lines, min_fields=3).rows.select("user_id", "age")


def ingest_ratings(spark: SparkSession, d: str) -> DataFrame:
    lines = _rating_lines(spark, d).select("value").unionByName(_noise(spark, RATING_NOISE))
    return REC.ingest_ratings(lines).rows


def ingest_users(spark: SparkSession, d: str) -> DataFrame:
    c = T.table(spark, d, "customer")
    line = F.concat_ws(
        ", ",
        F.col("c_custkey").cast("string"),
        F.substring("c_mktsegment", 1, 1),
        F.floor(F.col("c_acctbal") / 100).cast("string"),
        F.col("c_nationkey").cast("string"),
        F.col("c_name"),
    )
    lines = c.select(line.alias("value")).unionByName(_noise(spark, USER_NOISE))
    return REC.ingest_users(lines).rows


def ingest_occupations(spark: SparkSession, d: str) -> DataFrame:
    n = T.table(spark, d, "nation")
    line = F.concat_ws(",", F.col("n_nationkey").cast("string"), F.col("n_name"), F.col("n_regionkey").cast("string"))
    lines = n.select(line.alias("value")).unionByName(_noise(spark, OCCUPATION_NOISE))
    return REC.ingest_occupations(lines).rows


def ingest_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Documents rendered as ``;``-separated review lines (the whole text, with
    ``;`` and line breaks blanked), written as a file, read back."""
    reviews = T.reviews(spark, d)
    text = F.regexp_replace(F.col("review"), "[;\r\n]", " ")
    line = F.concat_ws(";", F.col("id").cast("string"), text, "topic", "aspect", F.coalesce("sentiment", F.lit("")))
    lines = reviews.select(line.alias("value")).unionByName(_noise(spark, REVIEW_NOISE))
    path = _write_lines(lines, spark, "reviews")
    return RV.read_reviews(spark, path, sep=";")


def ingest_stopwords(spark: SparkSession, d: str) -> DataFrame:
    """Part names as a stopword file (repeats and two-word entries), tab-separated
    with the brand as a second field that must be ignored."""
    part = T.table(spark, d, "part")
    lines = part.select(F.concat_ws("\t", "p_name", "p_brand").alias("value"))
    path = _write_lines(lines, spark, "stopwords")
    return RV.read_stopwords(spark, path, delimiter="\t")


def scan_lines(spark: SparkSession, d: str) -> DataFrame:
    part = T.table(spark, d, "part")
    line = F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name", "p_brand", "p_type", F.col("p_size").cast("string"))
    path = _write_lines(part.select(line.alias("value")), spark, "lines")
    return REC.scan_lines(spark, path).select(F.col("value").alias("line"))


def union_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Ratings split by line status into two files, scanned as one table, parsed."""
    lines = _rating_lines(spark, d)
    first = _write_lines(lines.where(F.col("l_linestatus") == "O").unionByName(_noise(spark, RATING_NOISE), allowMissingColumns=True), spark, "ratings_1")
    second = _write_lines(lines.where(F.col("l_linestatus") != "O"), spark, "ratings_2")
    return REC.ingest_ratings(REC.scan_lines(spark, [first, second])).rows


def stream_ingest_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Rating files landing in a folder, ingested by a streaming query
    (process everything available, then stop), read back as a table."""
    from marquee.streaming import read_ingested, start_ingest, stream_lines

    lines = _rating_lines(spark, d)
    landing = scratch_path(spark, "landing")
    lines.where(F.col("l_linestatus") == "O").select("value").write.text(landing + "/part=1")
    lines.where(F.col("l_linestatus") != "O").select("value").unionByName(
        _noise(spark, RATING_NOISE)
    ).write.text(landing + "/part=2")
    out = scratch_path(spark, "ingested")
    query = start_ingest(
        stream_lines(spark, landing + "/*"), REC.ingest_ratings, out, scratch_path(spark, "stream_ckpt")
    )
    query.awaitTermination()
    return read_ingested(spark, out).select("user_id", "movie_id", "rating", "ts")


def _reason_counts(ingested: REC.Ingested) -> DataFrame:
    """Lines per reject reason, accepted ones as ``ok``, in one pass over the input."""
    reason = F.coalesce("reason", F.lit("ok")).alias("reason")
    return ingested.tagged.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def op_skip_header(spark: SparkSession, d: str) -> DataFrame:
    """Reject reasons of movie lines: headers (any case, any position), blanks, blank fields."""
    lines = _movie_lines(spark, d).unionByName(_noise(spark, MOVIE_NOISE))
    return _reason_counts(REC.ingest_movies(lines))


def op_drop_malformed(spark: SparkSession, d: str) -> DataFrame:
    """Reject reasons of rating lines where a zero discount blanks the rating
    to ``n/a`` and a zero tax drops the timestamp field."""
    li = T.table(spark, d, "lineitem")
    rating = F.when(F.col("l_discount") == 0, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string"))
    ts = T._epoch_seconds("l_shipdate").cast("string")
    fields = F.when(
        F.col("l_tax") == 0,
        F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), rating),
    ).otherwise(F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), rating, ts))
    lines = li.select(fields.alias("value")).unionByName(_noise(spark, RATING_NOISE))
    return _reason_counts(REC.ingest_ratings(lines))


# ---------------------------------------------------------------- sinks


def _sink_rows(spark: SparkSession, d: str) -> DataFrame:
    """Parts whose titles hold both separators and a quote, with empty and NULL fields."""
    part = T.table(spark, d, "part")
    title = F.concat("p_name", F.lit(", \"the\"\t"), "p_type")
    empty = F.when(F.col("p_size") % 2 == 0, F.lit("")).otherwise(F.col("p_type"))
    return part.select("p_partkey", title.alias("title"), F.expr("nullif(p_brand, 'Brand#11')").alias("brand"), empty.alias("type"), "p_size")


def sink_tsv(spark: SparkSession, d: str) -> DataFrame:
    """Parts as tab-separated lines, read back as they are."""
    path = scratch_path(spark, "parts_tsv")
    SK.write_delimited(_sink_rows(spark, d), path, sep="\t", null_value="NULL")
    return spark.read.text(path).select(F.col("value").alias("line"))


def sink_csv(spark: SparkSession, d: str) -> DataFrame:
    """Parts as comma-separated lines, read back as they are."""
    path = scratch_path(spark, "parts_csv")
    SK.write_delimited(_sink_rows(spark, d), path, sep=",")
    return spark.read.text(path).select(F.col("value").alias("line"))


def sink_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """Written twice to the same path as a single file; only the second copy remains."""
    report = R.occupation_rating_stats(T.ratings(spark, d, with_user=True), T.users(spark, d), T.occupations(spark, d))
    path = scratch_path(spark, "occupation_overwrite")
    SK.write_delimited(report, path, sep="\t", single_file=True)
    SK.write_delimited(report, path, sep="\t", mode="overwrite", single_file=True)
    return SK.read_delimited(spark, path, "occupation_name string, avg_rating double, n bigint", sep="\t")


def sink_single_file(spark: SparkSession, d: str) -> DataFrame:
    """All orders in order of price as one file, joined from the parts of the tasks, read back with their line numbers."""
    orders = T.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = scratch_path(spark, "orders_single")
    SK.write_delimited(orders.orderBy(F.desc("o_totalprice"), "o_orderkey"), path, sep=",", single_file=True)
    lines = REC.scan_lines(spark, path, position=True).select("value", "position.file", "position.start", "position.line")
    ranked = with_order_rank(lines, [F.asc("file"), F.asc("start"), F.asc("line")])
    return ranked.select("rank", F.element_at(F.split("value", ","), 1).cast("bigint").alias("o_orderkey"))


def op_format_avg(spark: SparkSession, d: str) -> DataFrame:
    """The per-movie text report with its summary line, written and read back."""
    report = R.movie_rating_report(T.ratings(spark, d), T.movies(spark, d))
    path = scratch_path(spark, "movie_report_text")
    SK.write_text(TR.movie_report_lines(report, R.DEFAULT_MIN_RATINGS), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


# ---------------------------------------------------------------- operators


def op_filter_ne(spark: SparkSession, d: str) -> DataFrame:
    p = T.table(spark, d, "part").select("p_partkey", F.expr("nullif(p_brand, 'Brand#11')").alias("brand"))
    return p.where(F.col("brand") != F.lit("Brand#12"))


def op_filter_and(spark: SparkSession, d: str) -> DataFrame:
    p = T.table(spark, d, "part").select("p_partkey", "p_name", F.expr("nullif(p_size, 1)").alias("size"))
    return p.where((F.col("size") != F.lit(2)) & (F.col("p_name") != F.lit("blue bolt")))


def op_filter_eq(spark: SparkSession, d: str) -> DataFrame:
    r = T.reviews(spark, d)
    return r.where(F.col("sentiment") == F.lit("negative")).select("id", "topic", "aspect")


def op_inner_join(spark: SparkSession, d: str) -> DataFrame:
    """Lines joined to the parts of size at most 25; lines of other parts drop out."""
    li = T.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    parts = T.table(spark, d, "part").where(F.col("p_size") <= 25).select("p_partkey", "p_name")
    return li.join(parts, "p_partkey").select("l_orderkey", "l_linenumber", "p_name")


def op_broadcast_join(spark: SparkSession, d: str) -> DataFrame:
    """Customers joined to nation. Nation has 25 rows by definition of the
    schema, so the hint is on a table whose size cannot grow with the data."""
    c = T.table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = T.table(spark, d, "nation").select("n_nationkey", "n_name")
    return c.join(F.broadcast(n), "n_nationkey").select("c_custkey", "n_name")


def op_left_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Per-part statistics with titles from the parts of size at most 25; others fall back to the id.

    Parts of size at most 10 are listed under two titles; the larger one counts."""
    stats = avg_count(T.ratings(spark, d), ["movie_id"])
    listed = T.table(spark, d, "part").where(F.col("p_size") <= 25)
    key = F.col("p_partkey").cast("string").alias("movie_id")
    titles = listed.select(key, F.col("p_name").alias("title")).unionAll(
        listed.where(F.col("p_size") <= 10).select(key, F.concat(F.lit("the "), "p_name").alias("title"))
    )
    return lookup_with_fallback(stats, titles, "movie_id", "title").select("movie_id", "title", "avg_rating", "n")


def _doc_tokens(spark: SparkSession, d: str) -> DataFrame:
    docs = T.reviews(spark, d, with_sentiment=False)
    return explode_tokens(docs, F.lower(F.col("review")), ["topic"])


def op_left_outer(spark: SparkSession, d: str) -> DataFrame:
    """Token counts by (word, matched stopword); a repeated stopword doubles its matches."""
    joined = left_outer(_doc_tokens(spark, d), T.stopwords(spark), "word", "stop_word")
    return joined.groupBy("word", "stop_word").agg(F.count(F.lit(1)).alias("n"))


def op_left_anti(spark: SparkSession, d: str) -> DataFrame:
    """Token counts after removing stopwords; the token ``and`` is turned into
    NULL first, and a NULL token is never removed."""
    toks = _doc_tokens(spark, d).withColumn("word", F.expr("nullif(word, 'and')"))
    return anti_join(toks, T.stopwords(spark), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def op_group_count(spark: SparkSession, d: str) -> DataFrame:
    p = T.table(spark, d, "part").withColumn("brand", F.expr("nullif(p_brand, 'Brand#11')"))
    return p.groupBy("p_size").agg(
        F.count("brand").alias("n_non_null"), F.count(F.lit(1)).alias("n_rows")
    )


def op_group_multi_key(spark: SparkSession, d: str) -> DataFrame:
    docs = T.reviews(spark, d, with_sentiment=False)
    return count_non_null(docs, ["topic", "aspect"], "topic", "n")


def op_nested_group(spark: SparkSession, d: str) -> DataFrame:
    """Per market segment a bag of the 3 richest customers, flattened again."""
    c = T.table(spark, d, "customer")
    bags = top_k_bag(
        c, ["c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")], 3, ["c_custkey", "c_acctbal"]
    )
    return unnest_group(bags, ["c_mktsegment"])


def op_group_bags(spark: SparkSession, d: str) -> DataFrame:
    """All customers of each market segment as bags of at most 100 entries, flattened again."""
    c = T.table(spark, d, "customer")
    return unnest_group(group_bags(c, ["c_mktsegment"], ["c_custkey", "c_acctbal"], chunk_rows=100), ["c_mktsegment"])


def op_group_bag_stats(spark: SparkSession, d: str) -> DataFrame:
    """From the bags of all order lines of each supplier: entries, returned ones, smallest and largest quantity;
    chunks over their limit, and chunk numbers given twice (none)."""
    lines = T.table(spark, d, "lineitem")
    bags = group_bags(lines, ["l_suppkey"], ["l_quantity", "l_returnflag"], chunk_rows=50)
    quantity = F.transform("bag", lambda e: e["l_quantity"])
    returned = F.size(F.filter("bag", lambda e: e["l_returnflag"] == F.lit("R")))
    measures = {
        "n": (F.size("bag"), F.sum("n")),
        "n_returned": (returned, F.sum("n_returned")),
        "least": (F.array_min(quantity), F.min("least")),
        "most": (F.array_max(quantity), F.max("most")),
        "too_long": ((F.size("bag") > 50).cast("int"), F.sum("too_long")),
        "twice": (F.col("chunk"), F.count("twice") - F.count_distinct("twice")),
    }
    return fold_bags(bags, ["l_suppkey"], measures)


def op_distinct(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "orders").select("o_custkey", "o_orderstatus").distinct()


def op_pivot(spark: SparkSession, d: str) -> DataFrame:
    """``pivot`` on the return flag: average quantity and line count per supplier."""
    li = T.table(spark, d, "lineitem")
    piv = (
        li.groupBy("l_suppkey")
        .pivot("l_returnflag", ["A", "N", "R"])
        .agg(F.avg("l_quantity").alias("avg_qty"), F.count(F.lit(1)).alias("n"))
    )
    cols = [F.col("l_suppkey")]
    for v in ("A", "N", "R"):
        cols += [F.col(f"{v}_avg_qty"), F.coalesce(F.col(f"{v}_n"), F.lit(0)).alias(f"{v}_n")]
    return piv.select(*cols)


def op_explode_list(spark: SparkSession, d: str) -> DataFrame:
    """Part names as ``|`` lists with blank elements and the brand repeated twice."""
    p = T.table(spark, d, "part")
    listed = F.concat_ws("|", F.regexp_replace("p_name", " ", "| |"), F.col("p_brand"), F.lit(" "), F.col("p_brand"))
    return explode_list(p.withColumn("list", listed), "list", "item", ["p_partkey"], separator="|")


def op_tokenize(spark: SparkSession, d: str) -> DataFrame:
    docs = T.table(spark, d, "documents")
    toks = tokenize(F.lower(F.col("text")))
    return docs.select(
        "doc_id", F.size(toks).alias("n_tokens"), F.md5(F.array_join(toks, " ")).alias("tokens_md5")
    )


def op_lower_trim(spark: SparkSession, d: str) -> DataFrame:
    docs = T.table(spark, d, "documents")
    return docs.select("doc_id", F.md5(lower_trim("text")).alias("text_md5"))


def op_clean_text(spark: SparkSession, d: str) -> DataFrame:
    docs = T.table(spark, d, "documents")
    return docs.select("doc_id", F.md5(clean_text(F.lower(F.col("text")))).alias("text_md5"))


def op_sort_asc(spark: SparkSession, d: str) -> DataFrame:
    stats = R.movie_rating_stats(T.ratings(spark, d), T.movies(spark, d), ordered=False)
    return with_order_rank(stats, [F.asc("title"), F.asc("movie_id")])


def op_sort_desc(spark: SparkSession, d: str) -> DataFrame:
    counts = V.comments_by_aspect(T.reviews(spark, d, with_sentiment=False), ordered=False)
    return with_order_rank(counts, [F.desc("num_comments"), F.asc("aspect")])


def op_top_k(spark: SparkSession, d: str) -> DataFrame:
    """The 10 best-rated parts (average, then count, then id), numbered."""
    stats = avg_count(T.ratings(spark, d), ["movie_id"])
    order = [F.desc("avg_rating"), F.desc("n"), F.asc("movie_id")]
    ten = stats.orderBy(*order).limit(10)
    return ten.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("bigint"))


def op_top_one(spark: SparkSession, d: str) -> DataFrame:
    """Oldest order of the most expensive kind: a global top-1."""
    o = T.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return top_one(o, [F.desc("o_totalprice"), F.asc("o_orderkey")])


def op_union_all(spark: SparkSession, d: str) -> DataFrame:
    """Customer keys from orders and from customer, labelled; duplicates kept."""
    a = T.table(spark, d, "orders").select(F.lit("orders").alias("src"), F.col("o_custkey").alias("custkey"))
    b = T.table(spark, d, "customer").select(F.lit("customer").alias("src"), F.col("c_custkey").alias("custkey"))
    return a.unionByName(b)


def op_bucket(spark: SparkSession, d: str) -> DataFrame:
    """Age buckets of the derived ages (-10..99 covers 17/18, 34/35, 49/50 and negatives)."""
    u = T.users(spark, d)
    return u.select("user_id", "age", age_group("age").alias("age_group"))


def op_header_test(spark: SparkSession, d: str) -> DataFrame:
    """Case-insensitive prefix and contains tests on rendered lines."""
    names = T.table(spark, d, "part").select("p_partkey", F.concat(F.lit("  "), F.upper("p_name")).alias("line"))
    return names.select(
        "p_partkey",
        is_header(F.col("line"), "small").alias("starts_small"),
        F.lower(strip_ws("line")).contains("bolt").alias("has_bolt"),
    )


def queries() -> dict:
    fns = [
        scan_lines, union_ratings, ingest_movies, ingest_quoted, ingest_ratings, ingest_users,
        ingest_movies_second_field, ingest_ratings_three_fields, ingest_user_genders, ingest_user_ages, ingest_movies_first_line, ingest_movies_first_line_contains,
        movie_rating_stats_last_listed, genre_rating_stats_last_listed, ingest_reviews_comma,
        movie_lines_by_id, ingest_occupations, ingest_reviews, ingest_stopwords, stream_ingest_ratings, op_skip_header, op_drop_malformed,
        sink_tsv, sink_csv, sink_overwrite, sink_single_file, op_format_avg, op_filter_ne, op_filter_and, op_filter_eq,
        op_inner_join, op_broadcast_join, op_left_lookup, op_left_outer, op_left_anti, op_group_count,
        op_group_multi_key, op_nested_group, op_group_bags, op_group_bag_stats, op_distinct, op_pivot, op_explode_list, op_tokenize,
        op_lower_trim, op_clean_text, op_sort_asc, op_sort_desc, op_top_k, op_top_one, op_union_all,
        op_bucket, op_header_test,
    ]
    return {f.__name__: f for f in fns}

"""Equivalent SQL for every registered query, runnable by DuckDB over the
same parquet tables (views named after the tables).

Column names match the Spark results. Text regular expressions are the same
strings on both sides; DuckDB needs the ``'g'`` flag to replace every match.
"""

from __future__ import annotations

from marquee.functions.text import (
    PUNCTUATION_DELETED,
    SYMBOLS_TO_BLANK,
    TOKEN_DELIMITERS,
    delimiter_pattern,
)
from marquee.sources.testdata import TEST_STOPWORDS

TOKEN_RE = delimiter_pattern(TOKEN_DELIMITERS)


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


RATINGS = """ratings AS (
  SELECT CAST(l_partkey AS VARCHAR) AS movie_id, l_quantity AS rating,
         CAST(epoch(l_shipdate) AS BIGINT) AS ts
  FROM lineitem)"""

RATINGS_WITH_USER = """ratings AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS user_id, CAST(l.l_partkey AS VARCHAR) AS movie_id,
         l.l_quantity AS rating, CAST(epoch(l.l_shipdate) AS BIGINT) AS ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

MOVIES = """movies AS (
  SELECT CAST(p_partkey AS VARCHAR) AS movie_id, p_name AS title FROM part)"""

MOVIE_GENRES = """movie_genres AS (
  SELECT movie_id, genre FROM (
    SELECT CAST(p_partkey AS VARCHAR) AS movie_id, trim(unnest(string_split(p_name, ' '))) AS genre
    FROM part) g
  WHERE genre <> '')"""

USERS = """users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, substr(c_mktsegment, 1, 1) AS gender,
         CAST(floor(c_acctbal / 100) AS INTEGER) AS age, CAST(c_nationkey AS VARCHAR) AS occupation_id
  FROM customer)"""

OCCUPATIONS = """occupations AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS occupation_id, n_name AS occupation_name FROM nation)"""

REVIEWS = """reviews AS (
  SELECT d.doc_id AS id, d.text AS review, d.lang AS topic, d.source AS aspect,
         CASE l.quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' END AS sentiment
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

REVIEWS_PLAIN = """reviews AS (
  SELECT doc_id AS id, text AS review, lang AS topic, source AS aspect FROM documents)"""

STOPWORDS = "stopwords AS (SELECT * FROM (VALUES {}) t(word))".format(
    ", ".join(f"({_sql_str(w)})" for w in TEST_STOPWORDS)
)

MOVIE_STATS = """stats AS (
  SELECT movie_id, avg(rating) AS avg_rating, count(*) AS n FROM ratings GROUP BY movie_id),
titled AS (
  SELECT s.movie_id, coalesce(mv.title, s.movie_id) AS title, s.avg_rating, s.n
  FROM stats s LEFT JOIN movies mv ON s.movie_id = mv.movie_id)"""

AGE_BUCKET = """CASE WHEN age < 18 THEN '0-18' WHEN age < 35 THEN '18-35'
            WHEN age < 50 THEN '35-50' ELSE '50+' END"""


def _cond(cat: str, value: str, prefix: str) -> str:
    return (
        f"avg(CASE WHEN {cat} = '{value}' THEN rating END) AS {prefix}_avg, "
        f"count(CASE WHEN {cat} = '{value}' THEN 1 END) AS {prefix}_n"
    )


def _tokens(text_expr: str, cols: str, source: str, where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    return (
        f"SELECT {cols}{', ' if cols else ''}unnest(string_split_regex({text_expr}, '{TOKEN_RE}')) AS word "
        f"FROM {source}{w}"
    )


def _report_sql() -> dict[str, str]:
    cleaned = (
        f"regexp_replace(regexp_replace(lower(review), '{PUNCTUATION_DELETED}', '', 'g'), "
        f"'{SYMBOLS_TO_BLANK}', ' ', 'g')"
    )
    return {
        "movie_rating_stats": f"""WITH {RATINGS}, {MOVIES}, {MOVIE_STATS}
SELECT movie_id, title, avg_rating, n FROM titled""",
        "top_rated_movie": f"""WITH {RATINGS}, {MOVIES}, {MOVIE_STATS}
SELECT movie_id, title, avg_rating, n FROM titled WHERE n >= 5
ORDER BY avg_rating DESC, n DESC, title ASC, movie_id ASC LIMIT 1""",
        "top_rated_movie_lab1": f"""WITH {RATINGS}, {MOVIES}, {MOVIE_STATS}
SELECT movie_id, title, avg_rating, n FROM titled WHERE n >= 5
ORDER BY avg_rating DESC, movie_id ASC LIMIT 1""",
        "movie_rating_report": f"""WITH {RATINGS}, {MOVIES}, {MOVIE_STATS},
best AS (SELECT title, avg_rating, n FROM titled WHERE n >= 5
         ORDER BY avg_rating DESC, n DESC, title ASC, movie_id ASC LIMIT 1)
SELECT 'detail' AS row_kind, title, avg_rating, n FROM titled
UNION ALL
SELECT CASE WHEN b.n IS NULL THEN 'none' ELSE 'top' END AS row_kind, b.title, b.avg_rating, b.n
FROM (SELECT 1 AS one) x LEFT JOIN best b ON TRUE""",
        "genre_rating_stats": f"""WITH {RATINGS}, {MOVIE_GENRES}
SELECT g.genre, avg(r.rating) AS avg_rating, count(*) AS n
FROM ratings r JOIN movie_genres g ON r.movie_id = g.movie_id GROUP BY g.genre""",
        "movie_gender_stats": f"""WITH {RATINGS_WITH_USER}, {USERS}, {MOVIES},
j AS (SELECT r.movie_id, r.rating, u.gender FROM ratings r JOIN users u ON r.user_id = u.user_id),
s AS (SELECT movie_id, {_cond('gender', 'M', 'm')}, {_cond('gender', 'F', 'f')} FROM j GROUP BY movie_id)
SELECT s.movie_id, coalesce(mv.title, s.movie_id) AS title, m_avg, m_n, f_avg, f_n
FROM s LEFT JOIN movies mv ON s.movie_id = mv.movie_id""",
        "movie_gender_stats_zero": f"""WITH {RATINGS_WITH_USER}, {USERS}, {MOVIES},
j AS (SELECT mv.title, r.rating, upper(u.gender) AS g
      FROM ratings r JOIN users u ON r.user_id = u.user_id JOIN movies mv ON r.movie_id = mv.movie_id)
SELECT title, coalesce(avg(CASE WHEN g = 'M' THEN rating END), 0.0) AS m_avg,
       coalesce(avg(CASE WHEN g = 'F' THEN rating END), 0.0) AS f_avg
FROM j GROUP BY title""",
        "movie_age_group_stats": f"""WITH {RATINGS_WITH_USER}, {USERS}, {MOVIES},
j AS (SELECT r.movie_id, r.rating, {AGE_BUCKET} AS bucket
      FROM ratings r JOIN users u ON r.user_id = u.user_id),
s AS (SELECT movie_id, {_cond('bucket', '0-18', 'age_0_18')}, {_cond('bucket', '18-35', 'age_18_35')},
             {_cond('bucket', '35-50', 'age_35_50')}, {_cond('bucket', '50+', 'age_50_plus')}
      FROM j GROUP BY movie_id)
SELECT s.movie_id, coalesce(mv.title, s.movie_id) AS title,
       age_0_18_avg, age_0_18_n, age_18_35_avg, age_18_35_n,
       age_35_50_avg, age_35_50_n, age_50_plus_avg, age_50_plus_n
FROM s LEFT JOIN movies mv ON s.movie_id = mv.movie_id""",
        "movie_age_group_stats_title": f"""WITH {RATINGS_WITH_USER}, {USERS}, {MOVIES},
j AS (SELECT mv.title, r.rating, {AGE_BUCKET} AS bucket
      FROM ratings r JOIN users u ON r.user_id = u.user_id JOIN movies mv ON r.movie_id = mv.movie_id),
s AS (SELECT title, {_cond('bucket', '0-18', 'age_0_18')}, {_cond('bucket', '18-35', 'age_18_35')},
             {_cond('bucket', '35-50', 'age_35_50')}, {_cond('bucket', '50+', 'age_50_plus')}
      FROM j GROUP BY title)
SELECT title, age_0_18_avg, age_18_35_avg, age_35_50_avg, age_50_plus_avg FROM s""",
        "occupation_rating_stats": f"""WITH {RATINGS_WITH_USER}, {USERS}, {OCCUPATIONS}
SELECT o.occupation_name, avg(r.rating) AS avg_rating, count(*) AS n
FROM ratings r JOIN users u ON r.user_id = u.user_id JOIN occupations o ON u.occupation_id = o.occupation_id
GROUP BY o.occupation_name""",
        "yearly_rating_stats": f"""WITH {RATINGS}
SELECT CAST(year(epoch_ms(ts * 1000)) AS INTEGER) AS year, avg(rating) AS avg_rating, count(*) AS n
FROM ratings GROUP BY 1""",
        "review_tokens": f"""WITH {REVIEWS}, {STOPWORDS},
tok AS ({_tokens('lower(review)', 'topic, aspect, sentiment', 'reviews')})
SELECT word, topic, aspect, sentiment FROM tok
WHERE word <> '' AND NOT EXISTS (SELECT 1 FROM stopwords s WHERE s.word = tok.word)""",
        "frequent_words": f"""WITH {REVIEWS_PLAIN}, {STOPWORDS},
tok AS ({_tokens(cleaned, '', 'reviews')})
SELECT word, count(word) AS freq FROM tok
WHERE word <> '' AND NOT EXISTS (SELECT 1 FROM stopwords s WHERE s.word = tok.word)
GROUP BY word HAVING count(word) > 500""",
        "comments_by_topic": f"""WITH {REVIEWS_PLAIN}
SELECT topic, count(DISTINCT id) AS num_comments FROM reviews GROUP BY topic""",
        "comments_by_aspect": f"""WITH {REVIEWS_PLAIN}
SELECT aspect, count(DISTINCT id) AS num_comments FROM reviews GROUP BY aspect""",
        "sentiment_extreme_aspects": f"""WITH {REVIEWS},
c AS (SELECT sentiment, aspect, count(aspect) AS "count" FROM reviews
      WHERE review <> 'comment' AND sentiment IN ('negative', 'positive') GROUP BY sentiment, aspect),
r AS (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY "count" DESC, aspect ASC NULLS LAST) AS rn FROM c)
SELECT CASE WHEN sentiment = 'negative' THEN 'MOST_NEGATIVE' ELSE 'MOST_POSITIVE' END AS label,
       aspect, "count" FROM r WHERE rn = 1""",
        "topic_sentiment_top_words": f"""WITH {REVIEWS},
tok AS ({_tokens('lower(review)', 'topic, sentiment', 'reviews',
                 "id <> 0 AND review <> 'comment' AND sentiment IN ('positive', 'negative')")}),
c AS (SELECT topic, sentiment, word, count(topic) AS freq FROM tok WHERE word <> '' GROUP BY topic, sentiment, word),
r AS (SELECT *, row_number() OVER (PARTITION BY topic, sentiment ORDER BY freq DESC, word ASC) AS rn FROM c)
SELECT sentiment, topic, word, freq FROM r WHERE rn <= 5""",
        "topic_top_words": f"""WITH {REVIEWS_PLAIN},
tok AS ({_tokens('lower(review)', 'topic', 'reviews', "review <> 'comment'")}),
c AS (SELECT topic, word, count(topic) AS freq FROM tok WHERE word <> '' GROUP BY topic, word),
r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY freq DESC, word ASC) AS rn FROM c)
SELECT topic, word, freq FROM r WHERE rn <= 5""",
    }


LISTED = """listed AS (
  SELECT 0 AS path, p_partkey AS seq, p_partkey, p_name AS title, p_name FROM part WHERE p_size <= 40
  UNION ALL SELECT 0, 1000000000000 - p_partkey, p_partkey, p_type, p_name FROM part WHERE p_size <= 25
  UNION ALL SELECT 1, p_partkey, p_partkey, p_brand, p_name FROM part WHERE p_size <= 10),
last_listed AS (
  SELECT CAST(p_partkey AS VARCHAR) AS movie_id, arg_max(title, path * 1000000000000000 + seq) AS title, any_value(p_name) AS p_name
  FROM listed GROUP BY p_partkey)"""


def _first_line_rows(header_kept: str) -> str:
    """Rows of the listing files; the second kind of header line is a record unless its form is looked for."""
    return f"""WITH {LISTED}, files AS (SELECT DISTINCT CAST(floor(p_partkey / 200) AS BIGINT) AS file FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS movie_id, title, replace(p_name, ' ', '|') AS genres FROM listed
UNION ALL SELECT 'movieid ' || file, 'middle', 'a|b' FROM files
UNION ALL SELECT 'List of MovieID', 'and title', 'and genres' FROM files WHERE {header_kept}"""


RATING_ROWS = """SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS movie_id,
       l_quantity AS rating, CAST(epoch(l_shipdate) AS BIGINT) AS ts FROM lineitem"""

DOC_TOKENS = f"""tok AS (
  SELECT word, topic FROM ({_tokens('lower(review)', 'topic', 'reviews')}) t WHERE word <> '')"""


def _check_sql() -> dict[str, str]:
    cleaned = (
        f"regexp_replace(regexp_replace(lower(text), '{PUNCTUATION_DELETED}', '', 'g'), "
        f"'{SYMBOLS_TO_BLANK}', ' ', 'g')"
    )
    reports = _report_sql()
    return {
        "scan_lines": """SELECT concat_ws(',', CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type,
       CAST(p_size AS VARCHAR)) AS line FROM part""",
        "union_ratings": RATING_ROWS,
        "ingest_ratings": RATING_ROWS,
        "stream_ingest_ratings": RATING_ROWS,
        "ingest_movies": """SELECT CAST(p_partkey AS VARCHAR) AS movie_id, p_name || ', ' || p_brand AS title,
       array_to_string(list_filter(string_split(p_name, ' '), lambda x: x <> ''), '|') AS genres FROM part""",
        "ingest_quoted": """SELECT CAST(p_partkey AS VARCHAR) AS movie_id,
       CASE WHEN p_size % 2 = 0 THEN p_name || ', "' || p_brand || '"' ELSE 'The 5" ' || p_name || ', "' || p_brand END AS title,
       array_to_string(list_filter(string_split(p_name, ' '), lambda x: x <> ''), '|') AS genres FROM part""",
        "ingest_movies_second_field": """SELECT CAST(p_partkey AS VARCHAR) AS movie_id, p_name AS title FROM part""",
        "ingest_ratings_three_fields": """SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS movie_id,
       l_quantity AS rating FROM lineitem
UNION ALL SELECT '1', '2', 3.0 UNION ALL SELECT '1', '2', 4.0 UNION ALL SELECT '1', '2', 4.0""",
        "ingest_user_genders": """SELECT CAST(c_custkey AS VARCHAR) AS user_id, substr(c_mktsegment, 1, 1) AS gender,
       CASE WHEN c_nationkey % 2 <> 0 AND c_nationkey % 3 <> 0 THEN CAST(floor(c_acctbal / 100) AS INTEGER) END AS age
FROM customer
UNION ALL SELECT '5', 'F', NULL UNION ALL SELECT '6', 'M', 30""",
        "ingest_user_ages": """SELECT CAST(c_custkey AS VARCHAR) AS user_id, CAST(floor(c_acctbal / 100) AS INTEGER) AS age
FROM customer WHERE c_nationkey % 5 <> 0 AND c_nationkey % 3 <> 0
UNION ALL SELECT '6', 30""",
        "ingest_movies_first_line": _first_line_rows("file % 3 = 1"),
        "ingest_movies_first_line_contains": _first_line_rows("FALSE"),
        "movie_rating_stats_last_listed": f"""WITH {RATINGS}, {LISTED},
stats AS (SELECT movie_id, avg(rating) AS avg_rating, count(*) AS n FROM ratings GROUP BY movie_id)
SELECT s.movie_id, coalesce(l.title, s.movie_id) AS title, s.avg_rating, s.n
FROM stats s LEFT JOIN last_listed l ON l.movie_id = s.movie_id""",
        "genre_rating_stats_last_listed": f"""WITH {RATINGS}, {LISTED}, genres AS (
  SELECT movie_id, unnest(CASE WHEN starts_with(title, 'Brand') THEN string_split(p_name, ' ')[-1:] ELSE string_split(p_name, ' ') END) AS genre
  FROM last_listed)
SELECT g.genre, avg(r.rating) AS avg_rating, count(*) AS n FROM ratings r JOIN genres g ON g.movie_id = r.movie_id GROUP BY g.genre""",
        "ingest_reviews_comma": f"""WITH {REVIEWS}
SELECT regexp_replace(review, '[,\r\n]', ' ', 'g') AS review, topic, aspect, sentiment FROM reviews""",
        "movie_lines_by_id": f"""WITH {RATINGS}, {MOVIES}, {MOVIE_STATS}
SELECT row_number() OVER (ORDER BY movie_id) AS rank,
       title || chr(9) || 'Average rating: ' || printf('%.1f', CAST(round(CAST(CAST(avg_rating AS VARCHAR) AS DECIMAL(28, 12)), 1) AS DOUBLE))
       || ' (Total ratings: ' || n || ')' AS line FROM titled""",
        "ingest_users": """SELECT CAST(c_custkey AS VARCHAR) AS user_id, substr(c_mktsegment, 1, 1) AS gender,
       CAST(floor(c_acctbal / 100) AS INTEGER) AS age, CAST(c_nationkey AS VARCHAR) AS occupation_id,
       c_name AS zip_code FROM customer""",
        "ingest_occupations": """SELECT CAST(n_nationkey AS VARCHAR) AS occupation_id,
       n_name || ',' || CAST(n_regionkey AS VARCHAR) AS occupation_name FROM nation""",
        "ingest_reviews": f"""WITH {REVIEWS}
SELECT CAST(id AS INTEGER) AS id, regexp_replace(review, '[;\r\n]', ' ', 'g') AS review, topic, aspect, sentiment
FROM reviews
UNION ALL SELECT * FROM (VALUES (1, 'short', NULL, NULL, NULL),
  (NULL, 'bad id', 'en', 'src0', 'positive'), (2, 'extra', 'en', 'src1', 'negative'))
  t(id, review, topic, aspect, sentiment)""",
        "ingest_stopwords": "SELECT p_name AS word FROM part",
        "op_skip_header": """SELECT 'ok' AS reason, count(*) AS n FROM part
UNION ALL SELECT reason, CAST(n AS BIGINT) AS n FROM (VALUES ('header', 2), ('blank', 2),
  ('too_few_fields', 1), ('blank_field', 2)) t(reason, n)""",
        "op_drop_malformed": """WITH c AS (
  SELECT CASE WHEN l_tax = 0 THEN 'too_few_fields' WHEN l_discount = 0 THEN 'bad_number' ELSE 'ok' END AS reason
  FROM lineitem
  UNION ALL SELECT * FROM (VALUES ('header'), ('header'), ('blank'), ('blank'), ('too_few_fields'),
    ('bad_number'), ('bad_number'), ('bad_number')) t(reason))
SELECT reason, count(*) AS n FROM c GROUP BY reason""",
        "sink_tsv": """SELECT concat_ws(chr(9), CAST(p_partkey AS VARCHAR), p_name || ', "the"' || chr(9) || p_type,
       coalesce(nullif(p_brand, 'Brand#11'), 'NULL'), CASE WHEN p_size % 2 = 0 THEN '' ELSE p_type END,
       CAST(p_size AS VARCHAR)) AS line FROM part""",
        "sink_csv": """SELECT concat_ws(',', CAST(p_partkey AS VARCHAR), p_name || ', "the"' || chr(9) || p_type,
       coalesce(nullif(p_brand, 'Brand#11'), ''), CASE WHEN p_size % 2 = 0 THEN '' ELSE p_type END,
       CAST(p_size AS VARCHAR)) AS line FROM part""",
        "sink_single_file": """SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank, o_orderkey FROM orders""",
        "op_format_avg": f"""WITH {RATINGS}, {MOVIES}, {MOVIE_STATS},
best AS (SELECT title, avg_rating, n FROM titled WHERE n >= 5
         ORDER BY avg_rating DESC, n DESC, title ASC, movie_id ASC LIMIT 1)
SELECT title || chr(9) || 'Average Rating: ' || printf('%.2f', avg_rating) || chr(9) || 'Total Ratings: ' || n AS line FROM titled
UNION ALL
SELECT '>>> TOP RATED >>>' || chr(9) || CASE WHEN b.n IS NULL THEN 'No movie has at least 5 ratings.'
       ELSE b.title || ' is the highest rated movie with an average rating of ' || printf('%.2f', b.avg_rating)
            || ' among movies with at least 5 ratings (Total Ratings: ' || b.n || ').' END
FROM (SELECT 1 AS one) x LEFT JOIN best b ON TRUE""",
        "sink_overwrite": reports["occupation_rating_stats"],
        "op_filter_ne": """SELECT p_partkey, nullif(p_brand, 'Brand#11') AS brand FROM part
WHERE nullif(p_brand, 'Brand#11') <> 'Brand#12'""",
        "op_filter_and": """SELECT p_partkey, p_name, nullif(p_size, 1) AS size FROM part
WHERE nullif(p_size, 1) <> 2 AND p_name <> 'blue bolt'""",
        "op_filter_eq": f"""WITH {REVIEWS}
SELECT id, topic, aspect FROM reviews WHERE sentiment = 'negative'""",
        "op_inner_join": """SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_size <= 25""",
        "op_broadcast_join": """SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""",
        "op_left_lookup": f"""WITH {RATINGS},
stats AS (SELECT movie_id, avg(rating) AS avg_rating, count(*) AS n FROM ratings GROUP BY movie_id),
mv AS (SELECT CAST(p_partkey AS VARCHAR) AS movie_id,
              CASE WHEN p_size <= 10 THEN greatest(p_name, 'the ' || p_name) ELSE p_name END AS title
       FROM part WHERE p_size <= 25)
SELECT s.movie_id, coalesce(mv.title, s.movie_id) AS title, s.avg_rating, s.n
FROM stats s LEFT JOIN mv ON s.movie_id = mv.movie_id""",
        "op_left_outer": f"""WITH {REVIEWS_PLAIN}, {STOPWORDS}, {DOC_TOKENS}
SELECT tok.word, s.word AS stop_word, count(*) AS n
FROM tok LEFT JOIN stopwords s ON tok.word = s.word GROUP BY tok.word, s.word""",
        "op_left_anti": f"""WITH {REVIEWS_PLAIN}, {STOPWORDS}, {DOC_TOKENS},
t2 AS (SELECT nullif(word, 'and') AS word FROM tok)
SELECT word, count(*) AS n FROM t2
WHERE NOT EXISTS (SELECT 1 FROM stopwords s WHERE s.word = t2.word) GROUP BY word""",
        "op_group_count": """SELECT p_size, count(nullif(p_brand, 'Brand#11')) AS n_non_null, count(*) AS n_rows
FROM part GROUP BY p_size""",
        "op_group_multi_key": """SELECT lang AS topic, source AS aspect, count(lang) AS n FROM documents
GROUP BY lang, source""",
        "op_nested_group": """SELECT c_mktsegment, c_custkey, c_acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn
  FROM customer) t WHERE rn <= 3""",
        "op_group_bags": "SELECT c_mktsegment, c_custkey, c_acctbal FROM customer",
        "op_group_bag_stats": """SELECT l_suppkey, count(*) AS n, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_returned,
       min(l_quantity) AS least, max(l_quantity) AS most, 0::BIGINT AS too_long, 0::BIGINT AS twice FROM lineitem GROUP BY l_suppkey""",
        "op_distinct": "SELECT DISTINCT o_custkey, o_orderstatus FROM orders",
        "op_pivot": """SELECT l_suppkey,
  avg(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS A_avg_qty, count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS A_n,
  avg(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS N_avg_qty, count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS N_n,
  avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS R_avg_qty, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS R_n
FROM lineitem GROUP BY l_suppkey""",
        "op_explode_list": """SELECT p_partkey, item FROM (
  SELECT p_partkey, trim(unnest(string_split(
    replace(p_name, ' ', '| |') || '|' || p_brand || '| |' || p_brand, '|'))) AS item FROM part) t
WHERE item <> ''""",
        "op_tokenize": f"""SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, md5(array_to_string(toks, ' ')) AS tokens_md5
FROM (SELECT doc_id, list_filter(string_split_regex(lower(text), '{TOKEN_RE}'), lambda x: x <> '') AS toks
      FROM documents) t""",
        "op_lower_trim": """SELECT doc_id, md5(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) AS text_md5
FROM documents""",
        "op_clean_text": f"SELECT doc_id, md5({cleaned}) AS text_md5 FROM documents",
        "op_sort_asc": f"""WITH {RATINGS}, {MOVIES}, {MOVIE_STATS}
SELECT movie_id, title, avg_rating, n, row_number() OVER (ORDER BY title, movie_id) AS rank FROM titled""",
        "op_sort_desc": f"""WITH {REVIEWS_PLAIN},
c AS (SELECT aspect, count(DISTINCT id) AS num_comments FROM reviews GROUP BY aspect)
SELECT aspect, num_comments, row_number() OVER (ORDER BY num_comments DESC, aspect) AS rank FROM c""",
        "op_top_k": f"""WITH {RATINGS},
s AS (SELECT movie_id, avg(rating) AS avg_rating, count(*) AS n FROM ratings GROUP BY movie_id)
SELECT movie_id, avg_rating, n, row_number() OVER (ORDER BY avg_rating DESC, n DESC, movie_id) AS rank
FROM s ORDER BY avg_rating DESC, n DESC, movie_id LIMIT 10""",
        "op_top_one": """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1""",
        "op_union_all": """SELECT 'orders' AS src, o_custkey AS custkey FROM orders
UNION ALL SELECT 'customer' AS src, c_custkey AS custkey FROM customer""",
        "op_bucket": f"""WITH {USERS}
SELECT user_id, age, {AGE_BUCKET} AS age_group FROM users""",
        "op_header_test": """SELECT p_partkey,
  starts_with(lower(regexp_replace('  ' || upper(p_name), '^\\s+|\\s+$', '', 'g')), 'small') AS starts_small,
  contains(lower(regexp_replace('  ' || upper(p_name), '^\\s+|\\s+$', '', 'g')), 'bolt') AS has_bolt
FROM part""",
    }


def oracle_sql() -> dict[str, str]:
    out = _report_sql()
    out.update(_check_sql())
    return out

"""Review-text reports: tokens, frequent words, counts per topic/aspect,
extreme aspects per sentiment, top words per topic (and sentiment).

``reviews``: id int/bigint, review string, topic string, aspect string,
sentiment string (only the reports that read sentiment need the column).
``stopwords``: one column ``word`` (duplicates allowed).

Scale notes: tokens are produced with ``explode`` inside the scan stage;
every count is a partial + final aggregate, so a word or topic holding a
large share of all tokens reaches the exchange as one row per task. Top-k
per group gets a partial ``WindowGroupLimit`` before its exchange, so a topic
with a huge vocabulary sends at most k rows per task. Whether the stopword
list is broadcast is left to the planner's size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import SYMBOL_DELIMITERS, TOKEN_DELIMITERS, delete_punctuation
from marquee.operators.aggregate import count_distinct_ids, count_non_null
from marquee.operators.join import anti_join
from marquee.operators.reshape import explode_tokens
from marquee.operators.topk import top_k_per_group

# The header marker of the review column and the two sentiments.
HEADER_REVIEW = "comment"
POSITIVE, NEGATIVE = "positive", "negative"
# Labels of the extreme-aspect rows.
MOST_NEGATIVE, MOST_POSITIVE = "MOST_NEGATIVE", "MOST_POSITIVE"
DEFAULT_MIN_FREQ = 500
DEFAULT_TOP_K = 5


def _not_header(df: DataFrame) -> DataFrame:
    # Three-valued logic on purpose: a NULL review is dropped as well.
    return df.where(F.col("review") != F.lit(HEADER_REVIEW))


def review_tokens(
    reviews: DataFrame, stopwords: DataFrame, delimiters: str = TOKEN_DELIMITERS
) -> DataFrame:
    """One row per non-stopword token occurrence: (word, topic, aspect, sentiment)."""
    tokens = explode_tokens(
        reviews, F.lower(F.col("review")), ["topic", "aspect", "sentiment"], delimiters=delimiters
    )
    return anti_join(tokens, stopwords, "word").select("word", "topic", "aspect", "sentiment")


def frequent_words(
    reviews: DataFrame,
    stopwords: DataFrame,
    min_freq: int = DEFAULT_MIN_FREQ,
    delimiters: str = TOKEN_DELIMITERS,
    ordered: bool = True,
) -> DataFrame:
    """Words (after cleaning, without stopwords) occurring more than ``min_freq`` times.

    The stopword anti join runs on the per-word counts (the vocabulary), not
    on every token; the result is the same because a word is either wholly
    a stopword or not. Symbols are not blanked first but are delimiters of
    the split, which saves a pass over every text.
    """
    kept = delete_punctuation(F.lower(F.col("review")))
    tokens = explode_tokens(reviews, kept, [], delimiters=delimiters + SYMBOL_DELIMITERS)
    counts = count_non_null(tokens, ["word"], "word", "freq")
    out = anti_join(counts, stopwords, "word").where(F.col("freq") > F.lit(min_freq))
    return out.orderBy(F.desc("freq"), F.asc("word")) if ordered else out


def comments_by(reviews: DataFrame, category: str, ordered: bool = True) -> DataFrame:
    """Number of distinct review ids per category value (``topic`` or ``aspect``).

    Dense integer ids travel as bitmaps (see :func:`count_distinct_ids`).
    """
    out = count_distinct_ids(reviews, category, "id", "num_comments")
    return out.orderBy(F.desc("num_comments"), F.asc_nulls_last(category)) if ordered else out


def comments_by_topic(reviews: DataFrame, ordered: bool = True) -> DataFrame:
    return comments_by(reviews, "topic", ordered)


def comments_by_aspect(reviews: DataFrame, ordered: bool = True) -> DataFrame:
    return comments_by(reviews, "aspect", ordered)


def sentiment_extreme_aspects(reviews: DataFrame) -> DataFrame:
    """The aspect with most negative rows and the one with most positive rows.

    Rows, not distinct reviews, are counted (rows with a NULL aspect count 0).
    Ties go to the smaller aspect name. Both sentiments come from one scan
    and one aggregation.
    """
    rows = _not_header(reviews).where(F.col("sentiment").isin(NEGATIVE, POSITIVE))
    counts = count_non_null(rows, ["sentiment", "aspect"], "aspect", "count")
    best = top_k_per_group(counts, ["sentiment"], [F.desc("count"), F.asc_nulls_last("aspect")], 1)
    label = F.when(F.col("sentiment") == F.lit(NEGATIVE), F.lit(MOST_NEGATIVE)).otherwise(
        F.lit(MOST_POSITIVE)
    )
    return best.select(label.alias("label"), "aspect", "count").orderBy("label")


def topic_sentiment_top_words(
    reviews: DataFrame,
    k: int = DEFAULT_TOP_K,
    delimiters: str = TOKEN_DELIMITERS,
    stopwords: DataFrame | None = None,
) -> DataFrame:
    """Top-k words per (topic, sentiment) for positive and negative reviews.

    No cleaning; stopwords are removed, from the counts, only if given. Rows with id 0 or NULL, and header
    rows, are dropped. Ties on frequency go to the smaller word.
    """
    rows = (
        reviews.where((F.col("id") != F.lit(0)) & (F.col("review") != F.lit(HEADER_REVIEW)))
        .where(F.col("sentiment").isin(POSITIVE, NEGATIVE))
    )
    tokens = explode_tokens(rows, F.lower(F.col("review")), ["topic", "sentiment"], delimiters=delimiters)
    counts = count_non_null(tokens, ["topic", "sentiment", "word"], "topic", "freq")
    if stopwords is not None:
        counts = anti_join(counts, stopwords, "word")
    top = top_k_per_group(counts, ["topic", "sentiment"], [F.desc("freq"), F.asc("word")], k)
    return top.select("sentiment", "topic", "word", "freq").orderBy(
        F.desc("sentiment"), F.asc_nulls_last("topic"), F.desc("freq"), F.asc("word")
    )


def topic_top_words(
    reviews: DataFrame,
    k: int = DEFAULT_TOP_K,
    delimiters: str = TOKEN_DELIMITERS,
    stopwords: DataFrame | None = None,
) -> DataFrame:
    """Top-k words per topic over all non-header reviews, without the stopwords if given."""
    tokens = explode_tokens(_not_header(reviews), F.lower(F.col("review")), ["topic"], delimiters=delimiters)
    counts = count_non_null(tokens, ["topic", "word"], "topic", "freq")
    if stopwords is not None:
        counts = anti_join(counts, stopwords, "word")
    top = top_k_per_group(counts, ["topic"], [F.desc("freq"), F.asc("word")], k)
    return top.select("topic", "word", "freq").orderBy(
        F.asc_nulls_last("topic"), F.desc("freq"), F.asc("word")
    )

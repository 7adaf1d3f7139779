"""Text lines of the reports, for the text sinks.

Results stay numeric everywhere else; these functions only render a
``line`` column. Two renderings exist because the two report families
round differently:

* ``half_even`` (default, the RDD-program reports): the exact binary value is
  rounded, exact ties go to even (4.125 -> 4.12, and 2.675, which is stored
  as a little less, -> 2.67).
* ``half_up`` (the MapReduce reports): ``format_string`` rounds the decimal
  digits half-up (4.25 -> 4.3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalar import AGE_GROUPS
from marquee.plans.ratings import AGE_GROUP_PREFIXES, GENDERS

# Line formats of the reports.
AVG_LINE = "%s\tAverage Rating: %s\tTotal Ratings: %d"
TOP_LINE = (
    ">>> TOP RATED >>>\t%s is the highest rated movie with an average rating of %s "
    "among movies with at least %d ratings (Total Ratings: %d)."
)
NO_TOP_LINE = ">>> TOP RATED >>>\tNo movie has at least %d ratings."
CELL = "%s: %s (n=%d)"
MR_MOVIE_LINE = "%s\tAverage rating: %s (Total ratings: %d)"
MR_GENRE_LINE = "%s\tAvg Rating: %s, Total Ratings: %d"
MR_GENDER_LINE = "%s\tMale: %s, Female: %s"
MR_AGE_CELL = "%s: %s"
MR_AGE_SEP = "  "
NA = "NA"


def exact_decimals(c: Column, decimals: int = 2) -> Column:
    """``c`` with ``decimals`` digits after the point, rounded from its exact binary value, ties to even.

    The fraction is taken as a whole number of 2**-60 (exact from 2**-8 up,
    and below that too small to reach a tie), so the comparison with one half
    is between integers. Values of 2**53 and more have no fraction.
    """
    size, unit = F.abs(c), 1 << 60
    whole = F.floor(size).cast("bigint")
    parts = ((size - F.floor(size)) * F.lit(float(unit))).cast("bigint").cast("decimal(20,0)") * F.lit(10**decimals).cast("decimal(6,0)")
    rest = parts % F.lit(unit).cast("decimal(20,0)")
    down = ((parts - rest) / F.lit(unit).cast("decimal(20,0)")).cast("bigint")
    half = F.lit(unit // 2).cast("decimal(20,0)")
    up = (rest > half) | ((rest == half) & (down % 2 == 1))
    digits = down + F.when(up, 1).otherwise(0)
    front = whole + F.when(digits >= 10**decimals, 1).otherwise(0)
    back = F.lpad((digits % 10**decimals).cast("string"), decimals, "0")
    sign = F.when(c < 0, F.lit("-")).otherwise(F.lit(""))
    text = F.concat(sign, front.cast("string"), F.lit("."), back)
    return F.when(size < float(1 << 53), text).otherwise(F.format_string(f"%.{decimals}f", c))


def fmt_number(c: Column, decimals: int = 2, rounding: str = "half_even") -> Column:
    if rounding == "half_even":
        text = exact_decimals(c, decimals)
    elif rounding == "half_up":
        text = F.format_string(f"%.{decimals}f", c)
    else:
        raise ValueError(f"unknown rounding {rounding!r}")
    return F.when(c.isNull(), F.lit(NA)).otherwise(text)


def average_lines(df: DataFrame, key: str, avg: str = "avg_rating", n: str = "n") -> DataFrame:
    """``key<TAB>Average Rating: x.xx<TAB>Total Ratings: n`` (movie, genre, occupation, year)."""
    line = F.format_string(AVG_LINE, F.col(key).cast("string"), fmt_number(F.col(avg)), F.col(n))
    return df.select(line.alias("line"))


def movie_report_lines(report: DataFrame, min_ratings: int) -> DataFrame:
    """Lines of :func:`marquee.plans.ratings.movie_rating_report`."""
    detail = F.format_string(AVG_LINE, F.col("title"), fmt_number(F.col("avg_rating")), F.col("n"))
    top = F.format_string(
        TOP_LINE, F.col("title"), fmt_number(F.col("avg_rating")), F.lit(min_ratings), F.col("n")
    )
    none = F.format_string(NO_TOP_LINE, F.lit(min_ratings))
    line = (
        F.when(F.col("row_kind") == "detail", detail)
        .when(F.col("row_kind") == "top", top)
        .otherwise(none)
    )
    return report.select(line.alias("line"))


def _cells(labels: Sequence[str], prefixes: Sequence[str]) -> Column:
    cells = [
        F.format_string(CELL, F.lit(label), fmt_number(F.col(f"{p}_avg")), F.col(f"{p}_n"))
        for label, p in zip(labels, prefixes)
    ]
    return F.concat_ws("\t", *cells)


def gender_lines(df: DataFrame, genders: Sequence[tuple[str, str]] = GENDERS) -> DataFrame:
    cells = _cells([g for g, _ in genders], [p for _, p in genders])
    return df.select(F.concat_ws("\t", F.col("title"), cells).alias("line"))


def age_group_lines(df: DataFrame) -> DataFrame:
    cells = _cells(AGE_GROUPS, AGE_GROUP_PREFIXES)
    return df.select(F.concat_ws("\t", F.col("title"), cells).alias("line"))


def mr_movie_line() -> Column:
    return F.format_string(MR_MOVIE_LINE, F.col("title"), fmt_number(F.col("avg_rating"), 1, "half_up"), F.col("n"))


def mr_movie_lines(df: DataFrame) -> DataFrame:
    return df.select(mr_movie_line().alias("line"))


def mr_genre_lines(df: DataFrame) -> DataFrame:
    avg = fmt_number(F.col("avg_rating"), 2, "half_up")
    return df.select(F.format_string(MR_GENRE_LINE, F.col("genre"), avg, F.col("n")).alias("line"))


def mr_gender_lines(df: DataFrame) -> DataFrame:
    """Lines of :func:`marquee.plans.ratings.movie_gender_stats_zero`."""
    m = fmt_number(F.col("m_avg"), 2, "half_up")
    f = fmt_number(F.col("f_avg"), 2, "half_up")
    return df.select(F.format_string(MR_GENDER_LINE, F.col("title"), m, f).alias("line"))


def mr_age_group_lines(df: DataFrame) -> DataFrame:
    """Lines of :func:`marquee.plans.ratings.movie_age_group_stats_title`."""
    cells = [
        F.format_string(MR_AGE_CELL, F.lit(label), fmt_number(F.col(f"{p}_avg"), 2, "half_up"))
        for label, p in zip(AGE_GROUPS, AGE_GROUP_PREFIXES)
    ]
    return df.select(F.concat(F.col("title"), F.lit("\t"), F.concat_ws(MR_AGE_SEP, *cells)).alias("line"))


def csv_lines(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``a,b,c`` lines, as the review reports store them."""
    return df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("line"))

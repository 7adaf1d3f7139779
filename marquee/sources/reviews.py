"""Delimited review files and stopword lists.

Review files are delimiter-separated without any quoting: a field may
contain a double quote or the other delimiter. Missing trailing fields are
NULL, extra fields are ignored, a non-integer id is NULL. The schema is
always given, never inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REVIEW_SCHEMA = "id int, review string, topic string, aspect string, sentiment string"
# The 4-column, comma-separated variant (no id column).
REVIEW_SCHEMA_NO_ID = "review string, topic string, aspect string, sentiment string"

_CSV_OPTIONS = {"quote": "", "escape": "", "mode": "PERMISSIVE", "header": "false"}


def read_reviews(
    spark: SparkSession, paths: str | list[str], sep: str = ";", schema: str = REVIEW_SCHEMA
) -> DataFrame:
    return spark.read.schema(schema).options(sep=sep, **_CSV_OPTIONS).csv(paths)


def parse_review_lines(lines: DataFrame, sep: str = ";", schema: str = REVIEW_SCHEMA) -> DataFrame:
    """Same parsing for a frame of text lines (``value``), e.g. from a stream."""
    parsed = F.from_csv(F.col("value"), schema, {"sep": sep, **_CSV_OPTIONS})
    return lines.select(parsed.alias("r")).select("r.*")


def read_stopwords(spark: SparkSession, paths: str | list[str], delimiter: str | None = None) -> DataFrame:
    """One entry per line; with ``delimiter`` only the first field of a line.

    Entries are kept as they are: duplicates and multi-word entries stay
    (a multi-word entry can never equal a single token, and duplicates do not
    change an anti join).
    """
    lines = spark.read.text(paths)
    word = F.col("value") if delimiter is None else F.split(F.col("value"), _escape(delimiter)).getItem(0)
    return lines.select(word.alias("word"))


def _escape(delimiter: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+?^$|-" else c for c in delimiter)

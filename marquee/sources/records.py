"""Text-line ingest: comma-separated record lines to typed frames, with rejects.

Every parser takes a frame with one string column ``value`` (one input line
per row, as ``spark.read.text`` or ``spark.readStream.text`` produce it) and
returns :class:`Ingested` with the typed rows and the rejected lines with a
reason. Parsing is a few projections of built-in expressions, so it runs inside
the scan stage and needs no shuffle; batch and streaming frames both work. A
line is read, stripped, split and typed once, whatever is asked of the result.

Rules, applied to every line:

* the line is stripped of surrounding whitespace (CR included);
* a blank line is rejected (``blank``);
* a line whose lower-cased text starts with the header name of the first
  column is rejected (``header``), on every line; :func:`ingest_movies` can
  limit the test to the first non-blank line of each file;
* fewer fields than required: ``too_few_fields``;
* a number that does not parse: ``bad_number``;
* a required text field that is blank: ``blank_field``.

Fields are split on commas. With ``quoted=True`` a field that starts with a
double quote may hold commas, and its quotes are removed (``""`` is one
quote); a quote inside a field is an ordinary character. It is the default
of the full record forms; the reduced forms (``title_mode="second_field"``,
fewer ``min_fields``) split on every comma unless told otherwise.

Lines that were scanned with their position keep it as the column
``position``, by which the reports let the last line of a repeated key win.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.scalar import in_calendar, is_header, strip_ws, to_double, to_int, to_java_double, to_long
from marquee.functions.text import split_list

# Header names of the first column, compared as a lower-case prefix.
MOVIE_HEADER = ("movieid",)
RATING_HEADER = ("userid",)
USER_HEADER = ("userid",)
OCCUPATION_HEADER = ("id", "occupationid")

# One field after its comma. A quote counts only as the first character of a
# field; there ``""`` is one quote, and what follows the closing quote belongs
# to the field. Possessive throughout, so a line is read once, without backtracking.
_FIELD = ',((?:"(?:[^"]++|"")*+"?+)?+[^,]*+)'
_QUOTED = '(?s)^"((?:[^"]++|"")*+)"?+(.*+)$'


@dataclass(frozen=True)
class Ingested:
    """``rows``: typed records; ``rejects``: (line, reason);
    ``tagged``: every line once, typed columns plus ``line`` and ``reason``
    (NULL for accepted lines), for writers that keep both in one pass."""

    rows: DataFrame
    rejects: DataFrame
    tagged: DataFrame


def scan_lines(spark: SparkSession, paths: str | list[str], position: bool = False, first_line: bool = False) -> DataFrame:
    """All lines of one or more text files as one frame (bag union of the files).

    ``position`` adds a struct that orders the lines as they are read one after
    the other: place of the path in ``paths``, file, start of the split in the
    file, place in the split. It costs nothing: a split is read in order by one
    task. ``first_line`` adds a flag on the first non-blank line of each file.
    """
    listed = paths if isinstance(paths, list) else [paths]
    if not (position or first_line):
        return spark.read.text(listed)
    frames = []
    for number, path in enumerate(listed):
        lines = spark.read.text(path)
        said = ["value"]
        if position:
            where = F.struct(
                F.lit(number).alias("path"),
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("start"),
                F.monotonically_increasing_id().alias("line"),
            )
            lines = lines.withColumn("position", where)
            said.append("position")
        if first_line:
            lines = mark_first_lines(lines, said)
        frames.append(lines)
    return reduce(DataFrame.unionByName, frames)


def mark_first_lines(lines: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` of a text scan's lines, and ``first_line``: the first non-blank line of its file.

    A file starts in the split that starts at 0, and a task reads a split's
    lines in order, so one pass over the batches finds it: no shuffle, no task
    per file. A first split of blank lines only has no such line.
    """
    scanned = lines.select(*keep, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scanned.schema.fields if f.name in keep)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        looking_in = None  # the file whose first line is still to come, or was found (False)
        for batch in batches:
            if not batch.num_rows:
                continue
            file = pc.dictionary_encode(batch["__file"])
            codes, names = file.indices.to_numpy(), file.dictionary
            starts = batch["__start"].to_numpy()
            said = pc.not_equal(pc.utf8_trim_whitespace(batch["value"]), "").to_numpy(zero_copy_only=False)
            first = np.zeros(batch.num_rows, dtype=bool)
            turns = np.flatnonzero(np.concatenate(([True], (codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1]))))
            for lo, hi in zip(turns, np.concatenate((turns[1:], [batch.num_rows])), strict=True):
                split = (names[int(codes[lo])].as_py(), int(starts[lo]))
                if looking_in is None or looking_in[0] != split:
                    looking_in = (split, split[1] == 0)
                if looking_in[1] and said[lo:hi].any():
                    first[lo + int(said[lo:hi].argmax())] = True
                    looking_in = (split, False)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(first)], names=[*keep, "first_line"])

    return scanned.mapInArrow(mark, f"{fields}, first_line boolean")


TEXT, FIELDS = "__text", "__fields"  # columns: the stripped line, and its fields


def _fields(stripped: str, quoted: bool) -> Column:
    if not quoted:
        return F.split(stripped, ",")
    parts = F.regexp_extract_all(F.concat(F.lit(","), stripped), F.lit(_FIELD), 1)

    def unquote(x: Column) -> Column:
        inner = F.replace(F.regexp_extract(x, _QUOTED, 1), F.lit('""'), F.lit('"'))
        return F.when(x.startswith('"'), F.concat(inner, F.regexp_extract(x, _QUOTED, 2))).otherwise(x)

    return F.transform(parts, unquote)


def _split_result(lines: DataFrame, quoted: bool, typed: list[Column], reason: Column) -> Ingested:
    """``typed`` are columns of ``TEXT`` and ``FIELDS``; ``reason`` may name them, too.

    A filter on the reason would be pushed below the projections, and every
    expression from the line's own on repeated in it wherever it is named. A
    generator stops it: one row per line, its reason exploded from an array of one.
    """
    read = lines.select(*(c for c in lines.columns if c in ("value", "position", "first_line")), strip_ws("value").alias(TEXT))
    split = read.withColumn(FIELDS, _fields(TEXT, quoted))
    parsed = split.select(*split.columns, *typed)
    names = [c for c in parsed.columns if c not in ("value", "first_line", "position", TEXT, FIELDS)]
    names += [c for c in parsed.columns if c == "position"]
    tagged = parsed.select(*names, F.col("value").alias("line"), F.explode(F.array(reason)).alias("reason"))
    rows = tagged.where(F.col("reason").isNull()).select(*names)
    rejects = tagged.where(F.col("reason").isNotNull()).select("line", "reason")
    return Ingested(rows, rejects, tagged)


def _base_reason(header: Column, min_fields: int) -> Column:
    return (
        F.when(F.col(TEXT) == F.lit(""), F.lit("blank"))
        .when(header, F.lit("header"))
        .when(F.size(FIELDS) < F.lit(min_fields), F.lit("too_few_fields"))
    )


def _anywhere(header_form: str) -> bool:
    if header_form not in ("prefix", "contains"):
        raise ValueError(f"unknown header_form {header_form!r}")
    return header_form == "contains"


def ingest_movies(
    lines: DataFrame,
    title_mode: str = "rejoin",
    quoted: bool | None = None,
    first_line_only: bool = False,
    header_form: str = "prefix",
) -> Ingested:
    """``id, title, genres``: at least 3 fields; genres is the last field split on ``|``.

    ``title_mode="rejoin"``: the title is every field between the first and
    the last joined back with commas (unquoted commas in titles survive).
    ``title_mode="second_field"``: the title is the second field only (titles
    with commas are cut). Blank genres are dropped, repeats kept. A blank id
    or title rejects the line.

    ``first_line_only`` tests only the first non-blank line of each file for a
    header (``lines`` from ``scan_lines(first_line=True)``); a header-like line
    further down is a record like any other. ``header_form`` is ``"prefix"``,
    or ``"contains"`` for a line that holds the name anywhere.
    """
    is_first = F.col("first_line") if first_line_only else F.lit(True)
    header = is_first & is_header(TEXT, *MOVIE_HEADER, anywhere=_anywhere(header_form))
    if title_mode == "rejoin":
        title = strip_ws(F.array_join(F.slice(FIELDS, 2, F.greatest(F.size(FIELDS) - 2, F.lit(0))), ","))
    elif title_mode == "second_field":
        title = strip_ws(F.get(FIELDS, 1))
    else:
        raise ValueError(f"unknown title_mode {title_mode!r}")
    genres = split_list(F.element_at(FIELDS, -1), "|")
    reason = _base_reason(header, 3).when((F.col("movie_id") == F.lit("")) | (F.col("title") == F.lit("")), F.lit("blank_field"))
    return _split_result(
        lines,
        title_mode == "rejoin" if quoted is None else quoted,
        [strip_ws(F.get(FIELDS, 0)).alias("movie_id"), title.alias("title"), genres.alias("genres")],
        reason,
    )


def ingest_ratings(lines: DataFrame, min_fields: int = 4, quoted: bool | None = None) -> Ingested:
    """``user, movie, rating, timestamp``; rating double, timestamp Unix seconds.

    ``min_fields=3`` accepts lines without a timestamp (ts NULL), as the
    per-movie reports never read it, and reads ratings by the wider grammar of
    :func:`to_java_double` (``4.5f`` is a number there).
    """
    to_rating = to_double if min_fields >= 4 else to_java_double
    ts = F.col("ts")
    # With fewer than 4 required fields the timestamp is never validated.
    bad_ts = ts.isNull() | ~in_calendar(ts) if min_fields >= 4 else F.lit(False)
    reason = _base_reason(is_header(TEXT, *RATING_HEADER), min_fields).when(F.col("rating").isNull() | bad_ts, F.lit("bad_number"))
    return _split_result(
        lines,
        min_fields >= 4 if quoted is None else quoted,
        [
            strip_ws(F.get(FIELDS, 0)).alias("user_id"),
            strip_ws(F.get(FIELDS, 1)).alias("movie_id"),
            to_rating(strip_ws(F.get(FIELDS, 2))).alias("rating"),
            to_long(strip_ws(F.get(FIELDS, 3))).alias("ts"),
        ],
        reason,
    )


def ingest_users(lines: DataFrame, min_fields: int = 5, quoted: bool | None = None) -> Ingested:
    """``user, gender, age, occupation, zip``; an age that is not an integer rejects the line.

    ``min_fields=2`` is the id-to-gender lookup: the age is read if it is a
    number and NULL if not, and never rejects a line.
    """
    reason = _base_reason(is_header(TEXT, *USER_HEADER), min_fields).when(
        F.col("age").isNull() if min_fields >= 3 else F.lit(False), F.lit("bad_number")
    )
    return _split_result(
        lines,
        min_fields >= 5 if quoted is None else quoted,
        [
            strip_ws(F.get(FIELDS, 0)).alias("user_id"),
            strip_ws(F.get(FIELDS, 1)).alias("gender"),
            to_int(strip_ws(F.get(FIELDS, 2))).alias("age"),
            strip_ws(F.get(FIELDS, 3)).alias("occupation_id"),
            strip_ws(F.get(FIELDS, 4)).alias("zip_code"),
        ],
        reason,
    )


def ingest_occupations(lines: DataFrame, quoted: bool = True) -> Ingested:
    """``id, name``; the name is every field after the first joined with commas."""
    name = strip_ws(F.array_join(F.slice(FIELDS, 2, F.greatest(F.size(FIELDS) - 1, F.lit(1))), ","))
    blank = (F.col("occupation_id") == F.lit("")) | (F.col("occupation_name") == F.lit(""))
    reason = _base_reason(is_header(TEXT, *OCCUPATION_HEADER), 2).when(blank, F.lit("blank_field"))
    return _split_result(lines, quoted, [strip_ws(F.get(FIELDS, 0)).alias("occupation_id"), name.alias("occupation_name")], reason)

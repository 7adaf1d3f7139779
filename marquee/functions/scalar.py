"""Scalar column helpers: whitespace, header tests, safe casts, buckets, years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The age buckets of the reports, lower bound inclusive.
# (upper bound exclusive, label): below 18, below 35, below 50, everything else.
AGE_GROUPS = ("0-18", "18-35", "35-50", "50+")
AGE_UPPER_BOUNDS = (18, 35, 50)
# What the regular expression ``\s`` matches, and the other ends of line before which ``$`` matches.
WHITESPACE = " \t\n\x0b\f\r"
LINE_ENDS = ("\x85", "\u2028", "\u2029")
# Unix seconds of 0001-01-01 and of the last second of 9999.
MIN_EPOCH, MAX_EPOCH = -62_135_596_800, 253_402_300_799


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Trim leading and trailing whitespace, including tab, CR and LF.

    ``trim`` is told what to remove. A regular expression, which costs many times
    as much, is left for texts that end in one of ``LINE_ENDS``: there whitespace
    before that character goes too.
    """
    text = _col(c)
    odd = F.substring(text, -1, 1).isin(*LINE_ENDS)
    return F.when(odd, F.regexp_replace(text, r"^\s+|\s+$", "")).otherwise(F.trim(text, F.lit(WHITESPACE)))


def is_header(line: Column | str, *first_column_names: str, anywhere: bool = False) -> Column:
    """Case-insensitive test whether the stripped line starts with (``anywhere``: holds) one of the names."""
    stripped = F.lower(strip_ws(line))
    cond = F.lit(False)
    for name in first_column_names:
        cond = cond | (stripped.contains(name.lower()) if anywhere else stripped.startswith(name.lower()))
    return cond


def to_double(c: Column | str) -> Column:
    """String to double; unparsable text becomes NULL (the row is then rejected).

    Spark's cast also reads type suffixes (``4.5f``, ``4.5d``); they are no numbers here.
    """
    text = _col(c)
    return F.when(~text.rlike(r"[0-9.][fFdD]\s*$"), _try_cast(text, "double"))


def to_java_double(c: Column | str) -> Column:
    """String to double by the grammar of ``Double.parseDouble``; anything else becomes NULL.

    Unlike :func:`to_double` it takes type suffixes (``4.5f``, ``4.5d``), and
    of the special words only the exact ``NaN`` and ``Infinity``.
    """
    text = _col(c)
    any_word, exact = text.rlike(r"(?i)^\s*[+-]?(?:inf|infinity|nan)\s*$"), text.rlike(r"^\s*[+-]?(?:Infinity|NaN)\s*$")
    return F.when(~any_word | exact, _try_cast(text, "double"))


def to_int(c: Column | str) -> Column:
    return _try_cast(_col(c), "int")


def to_long(c: Column | str) -> Column:
    return _try_cast(_col(c), "bigint")


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


def age_group(age: Column | str) -> Column:
    """Bucket an age: <18, <35, <50, rest. Negative ages land in the first bucket."""
    a = _col(age)
    expr = F.when(a.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(AGE_UPPER_BOUNDS, AGE_GROUPS):
        expr = expr.when(a < bound, F.lit(label))
    return expr.otherwise(F.lit(AGE_GROUPS[-1]))


def epoch_year(ts: Column | str) -> Column:
    """Calendar year (UTC) of a Unix-seconds value, independent of the session zone; NULL out of range."""
    seconds = _col(ts)
    days = F.floor(F.when(in_calendar(seconds), seconds) / F.lit(86400)).cast("int")
    return F.year(F.date_from_unix_date(days))


def in_calendar(ts: Column | str) -> Column:
    """Whether a Unix-seconds value lies in the years 1 to 9999."""
    return _col(ts).between(MIN_EPOCH, MAX_EPOCH)

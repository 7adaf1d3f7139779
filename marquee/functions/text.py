"""Text expressions: lower/strip, punctuation cleaning, tokenizing, list split.

All of them are JVM-side regular-expression functions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.scalar import strip_ws

# Fixed values. Delimiters of Pig's TOKENIZE: blank, double quote, comma,
# left and right parenthesis, star.
PIG_TOKEN_DELIMITERS = ' ",()*'
# Our default adds tab, CR and LF so multi-line texts split at line ends too.
TOKEN_DELIMITERS = PIG_TOKEN_DELIMITERS + "\t\r\n"

# Fixed values. Cleaning step 1 deletes these characters: @ ! ^ ? . ,
PUNCTUATION_DELETED = "[@!^?.,]"
# Fixed values. Cleaning step 2 turns digits and these symbols into a blank:
# % \ - ? + / & : = ~ < >
SYMBOLS_TO_BLANK = r"[0-9%\\\-?+/&:=~<>]"
# The same characters as delimiters: blanking and then splitting is splitting at them.
SYMBOL_DELIMITERS = "0123456789%\\-?+/&:=~<>"

_ESCAPES = {"\t": r"\t", "\r": r"\r", "\n": r"\n"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def delimiter_pattern(delimiters: str) -> str:
    """Regular expression matching one or more of the given delimiter characters."""
    parts = []
    for ch in delimiters:
        if ch in _ESCAPES:
            parts.append(_ESCAPES[ch])
        elif ch in "\\]^-[":
            parts.append("\\" + ch)
        else:
            parts.append(ch)
    return "[" + "".join(parts) + "]+"


def lower_trim(c: Column | str) -> Column:
    return F.lower(strip_ws(c))


def delete_punctuation(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), PUNCTUATION_DELETED, "")


def symbols_to_space(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), SYMBOLS_TO_BLANK, " ")


def clean_text(c: Column | str) -> Column:
    """Punctuation deleted first (``a,b`` becomes ``ab``), then digits/symbols blanked."""
    return symbols_to_space(delete_punctuation(c))


def tokenize(c: Column | str, delimiters: str = TOKEN_DELIMITERS) -> Column:
    """Array of the non-empty tokens of a text (NULL text gives NULL)."""
    return F.filter(F.split(_col(c), delimiter_pattern(delimiters)), lambda t: t != F.lit(""))


def split_list(c: Column | str, separator: str = "|") -> Column:
    """Split a delimited list, strip every element, drop blank elements.

    Repeated elements are kept (each occurrence counts).
    """
    pattern = "[" + ("\\" + separator if separator in "\\]^-[" else separator) + "]"
    parts = F.transform(F.split(_col(c), pattern), lambda x: strip_ws(x))
    return F.filter(parts, lambda x: x != F.lit(""))

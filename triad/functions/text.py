"""Text expressions (all JVM-side, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.isspace() defines it (so strip()/split() agree
# with the reference): the Unicode White_Space property plus U+001C..U+001F.
WS_CHARS = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
WS_RUN = r"(?U)[\s\x1c-\x1f]+"
WORD = r"(?U)[^\s\x1c-\x1f]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Strip leading and trailing whitespace of any kind (Spark's trim cuts spaces only)."""
    return F.trim(_c(col), F.lit(WS_CHARS))


def lstrip_ws(col) -> Column:
    return F.ltrim(_c(col), F.lit(WS_CHARS))


def split_ws(col) -> Column:
    """Whitespace tokenisation with Python ``str.split()`` semantics: '' gives [].

    Splitting the untrimmed text leaves at most an empty first and last piece,
    which ``array_remove`` drops (one pass, no lambda).
    """
    return F.array_remove(F.split(_c(col), WS_RUN), "")


def word_count(col) -> Column:
    """Number of whitespace-separated words (no token array is built)."""
    return F.regexp_count(F.coalesce(_c(col), F.lit("")), F.lit(WORD))


def first_words(col, n: int) -> Column:
    """The first ``n`` words joined by single spaces; reads only the start of the text."""
    head = F.slice(F.split(lstrip_ws(col), WS_RUN, n + 1), 1, n)
    return F.array_join(F.filter(head, lambda w: w != ""), " ")


def collapse_ws(col) -> Column:
    """Every whitespace run becomes one space, then strip."""
    return F.trim(F.regexp_replace(_c(col), WS_RUN, " "), F.lit(" "))


def split_sentences(col) -> Column:
    """Collapse whitespace, then split after '.', '!' or '?' followed by blanks.

    An empty or blank text gives an empty array.
    """
    return F.array_remove(F.split(collapse_ws(col), r"(?<=[.!?]) "), "")


def replace_escaped_newline(col) -> Column:
    """Replace the two characters backslash + n by a space (not a real line break)."""
    return F.replace(_c(col), F.lit("\\n"), F.lit(" "))

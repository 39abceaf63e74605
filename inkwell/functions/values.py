"""Scalar parsing and text helpers shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


#: Text that is a decimal number (not Java's type suffixes such as ``12d``).
FLOAT_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip_ws(col: Column | str) -> Column:
    """Trim all Unicode white space (``trim`` alone removes only spaces)."""
    return F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", "")


def parse_int(col: Column | str) -> Column:
    """Trimmed text to bigint; unparsable or null gives 0.  Like Python's
    ``int``, ``'12.0'`` is not an integer (0)."""
    return F.coalesce(_try_cast(strip_ws(col), "bigint"), F.lit(0).cast("bigint"))


def parse_float(col: Column | str) -> Column:
    """Trimmed text to double; unparsable or null gives 0.0."""
    text = strip_ws(col)
    return F.coalesce(F.when(text.rlike(FLOAT_RE), _try_cast(text, "double")), F.lit(0.0))


def _try_cast(col: Column, to: str) -> Column:
    return col.try_cast(to)


def lines_of(text: Column | str) -> Column:
    """Non-blank lines of a text (``splitlines`` + blank filter)."""
    return F.filter(F.split(_c(text), r"\r\n|\n|\r"), lambda l: ~l.rlike(r"(?U)^\s*$"))


def truncate_words(text: Column | str, n: int = 1000) -> Column:
    """R2: first ``n`` whitespace-separated words joined by one space; the text
    is returned unchanged when it has at most ``n`` words."""
    words = F.filter(F.split(_c(text), r"(?U)\s+"), lambda w: w != "")
    return F.when(F.size(words) <= n, _c(text)).otherwise(F.array_join(F.slice(words, 1, n), " "))


def truncate_chars(text: Column | str, n: int = 2000) -> Column:
    """First ``n`` characters."""
    return F.substring(_c(text), 1, n)

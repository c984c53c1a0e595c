"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col, strip_all

TRUE_TOKENS = ("Y", "Yes", "1", "True", "true")
FALSE_TOKENS = ("N", "No", "0", "False", "false")


def finite_or_null(c: str | Column) -> Column:
    """Infinity and NaN become NULL."""
    c = col(c)
    bad = F.isnan(c) | c.isin(float("inf"), float("-inf"))
    return F.when(~bad, c)


def guarded_ratio(num: str | Column, den: str | Column, scale: float = 1.0) -> Column:
    """num / den * scale, and 0 where the denominator is not positive."""
    num, den = col(num), col(den)
    return F.when(den > 0, num / den * F.lit(scale)).otherwise(F.lit(0.0))


def percent_change(now: str | Column, before: str | Column) -> Column:
    """Percentage change rounded to two places; NULL when there is no base."""
    now, before = col(now), col(before)
    return F.round((now - before) * F.lit(100.0) / F.nullif(before, F.lit(0.0)), 2)


def lenient_cast(c: str | Column, to: str | T.DataType) -> Column:
    """Text -> number, NULL where it reads as none.

    Whitespace, which costs more than the reading, is stripped only from text
    that does not read as it is; a number that reads does so stripped or not.
    """
    text = col(c).cast("string")
    return F.coalesce(text.try_cast(to), strip_all(text).try_cast(to))


def lenient_long(c: str | Column, to: str = "bigint") -> Column:
    """Text -> integer; anything else (blank, '12.0', words) becomes NULL."""
    return lenient_cast(c, to)


def lenient_double(c: str | Column) -> Column:
    """Text -> double; Java's 'd' / 'f' suffixes are not numbers here."""
    text = col(c).cast("string")
    # The pattern is tried on text with such a letter only.
    lettered = F.contains(text, F.lit("d")) | F.contains(text, F.lit("D")) | F.contains(text, F.lit("f")) | F.contains(text, F.lit("F"))
    return F.when(~(lettered & text.rlike(r"[0-9.][dDfF]\s*$")), lenient_cast(text, "double"))


def flag(c: str | Column) -> Column:
    """Known true / false words -> boolean, everything else NULL."""
    c = col(c)
    return F.when(c.isin(*TRUE_TOKENS), F.lit(True)).when(c.isin(*FALSE_TOKENS), F.lit(False))


def standard_decimal(c: str | Column) -> Column:
    return col(c).cast("decimal(18,4)")

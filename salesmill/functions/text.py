"""String expressions. All are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as whitespace. Plain trim only removes the
# space character; feeds also carry tabs, line breaks and Unicode spaces.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_all(c: str | Column) -> Column:
    """Remove every kind of leading and trailing whitespace."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def blank_to_null(c: str | Column) -> Column:
    """Strip, then turn an empty string into NULL."""
    return F.nullif(strip_all(c), F.lit(""))


def collapse_spaces(c: str | Column) -> Column:
    """Upper-case, strip, and squeeze inner whitespace to single spaces."""
    return F.regexp_replace(strip_all(F.upper(col(c))), r"\s+", " ")


def upper_trim(c: str | Column) -> Column:
    return F.upper(F.trim(col(c)))


def mail_key(c: str | Column) -> Column:
    """Lookup form of an e-mail address."""
    return F.trim(F.lower(col(c)))


def mail_path_element(c: str | Column) -> Column:
    """E-mail address as one element of a dot-separated hierarchy path.

    ``@`` and ``.`` become words, dashes and spaces become underscores, and
    whatever is then neither letter, digit nor underscore is dropped.
    """
    out = F.lower(strip_all(c))
    out = F.replace(out, F.lit("@"), F.lit("_at_"))
    out = F.replace(out, F.lit("."), F.lit("_dot_"))
    out = F.translate(out, "- ", "__")
    return F.regexp_replace(out, r"[^\p{L}\p{N}_]", "")


def joined_key(columns: list[str | Column], sep: str = "_", nulls: str = "text") -> Column:
    """Concatenate columns into one key.

    ``nulls`` says what a missing part does: ``text`` writes the word NULL,
    ``skip`` leaves the part out, ``empty_string`` keeps its place empty, and
    ``null`` makes the whole key NULL.
    """
    parts = [col(c).cast("string") for c in columns]
    if nulls == "skip":
        return F.concat_ws(sep, *parts)
    if nulls == "text":
        return F.concat_ws(sep, *[F.coalesce(p, F.lit("NULL")) for p in parts])
    if nulls == "empty_string":
        return F.concat_ws(sep, *[F.coalesce(p, F.lit("")) for p in parts])
    if nulls == "null":
        woven: list[Column] = []
        for i, p in enumerate(parts):
            woven += [F.lit(sep), p] if i else [p]
        return F.concat(*woven)
    raise ValueError(f"unknown null policy {nulls!r}")

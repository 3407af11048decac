"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text that stands for "no value" in the source files, and the white space
# characters of the source encoding (Latin-1).
NULL_TOKEN = "NULL"
WHITE_SPACE = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f "


def null_token(c: Column, token: str = NULL_TOKEN) -> Column:
    """The value, or NULL where the whole value is the token or empty."""
    return F.when(~c.isin(token, ""), c)


def blank_token(c: Column, token: str = NULL_TOKEN) -> Column:
    """The value, with a whole-value token replaced by empty text."""
    return F.regexp_replace(c, f"^{token}$", "")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def to_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalise(c: Column, token: str = NULL_TOKEN) -> Column:
    """Upper case, every occurrence of the token removed, stripped; NULL when nothing is left.

    The token is removed inside words too, so this is for code-like columns only.
    """
    shouted = F.upper(to_empty(c.cast("string")))
    return to_null(strip(F.replace(shouted, F.lit(token), F.lit(""))))


def joined_name(first: Column, last: Column) -> Column:
    """First and last name with one blank between; NULL if either is NULL."""
    return F.concat(first, F.lit(" "), last)

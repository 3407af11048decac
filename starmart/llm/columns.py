"""Small helpers on columns that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; null is empty.

    Only text with other than ASCII characters is translated letter by letter.
    """
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def in_class(id: Column, modulus: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves this rest; false for a null id."""
    return F.coalesce(F.crc32(id.cast("string")) % modulus == rest, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """The name with as many underscores before it as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Rows of a table that is broadcast after they were counted; a larger one is joined as Spark chooses.
BROADCAST_ROWS = 500_000
#: A group with at least this share of all rows is joined by broadcast; there are at most 1 / share such groups.
HOT_SHARE = 1 / 1000


def if_small(df: DataFrame, rows: int) -> DataFrame:
    """The table with a broadcast hint if its counted rows are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Rows with the columns of their group, of which ``groups`` has one row by ``keys`` with its ``size``.

    Rows of hot groups take a broadcast of those groups; all others are joined by sort and merge.
    """
    hot = F.broadcast(groups.filter((F.col(size) > 1) & (F.col(size) >= HOT_SHARE * total)))
    rest = rows.join(hot.select(*keys), keys, "left_anti")
    return rows.join(hot, keys).unionByName(rest.join(groups.hint("merge"), keys))

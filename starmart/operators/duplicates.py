"""Rows that are equal on a set of columns; NULL equals NULL here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import SLICE_ROWS, join_sliced

#: Equal rows that one task writes out at a time.
COPY_ROWS = 50_000


def number_copies(df: DataFrame, copies: str, number: str, copy_rows: int = COPY_ROWS) -> DataFrame:
    """Each row as often as its ``copies`` says, numbered from 0 under ``number``; the count goes.

    A count of more than ``copy_rows`` is cut into ranges first, which are dealt over all tasks before they are written
    out, so that no task and no array holds the copies of one row.
    """
    columns = [c for c in df.columns if c != copies]
    count, size = F.col(copies), F.lit(copy_rows).cast("long")

    def listed(rows: DataFrame, first: Column, last: Column) -> DataFrame:
        return rows.select(*columns, F.explode(F.sequence(first, last)).alias(number))

    few = listed(df.filter(count <= size), F.lit(0).cast("long"), count - 1)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = df.filter(count > size)
    many = many.select("*", F.posexplode(F.sequence(F.lit(0).cast("long"), count - 1, size)).alias("_from_range", "_from"))
    many = many.repartition(tasks, F.col("_from_range"))  # with a number, so that the few rows are not put together again
    return few.unionByName(listed(many, F.col("_from"), F.least(F.col("_from") + size, count) - 1))


def _place(df: DataFrame, compared: list[str], order: str) -> Column:
    """What sorts the rows of a group: the order (NULL last), then the other columns."""
    others = [c for c in df.columns if c not in compared and c != order]
    return F.struct(F.col(order).isNull().alias("_no_order"), F.col(order), *others)


def dedupe_first(df: DataFrame, compared: list[str], order: str) -> DataFrame:
    """Of every group of rows equal on ``compared`` the first one by ``order``; NULL comes last, ties go by content.

    An aggregation and not a window: each task reduces its copies to one row per group before the
    shuffle, so a group of any size ends as one row per task.
    """
    firsts = df.groupBy(*[F.col(c).alias(f"_by_{c}") for c in compared])
    firsts = firsts.agg(F.min(_place(df, compared, order)).alias("_first"))
    return firsts.select(
        *[(F.col(f"_by_{c}") if c in compared else F.col(f"_first.{c}")).alias(c) for c in df.columns]
    )


def flag_duplicates(
    df: DataFrame,
    compared: list[str],
    order: str,
    status: str = "duplicate_status",
    chosen: str | None = None,
    slice_rows: int = SLICE_ROWS,
    copy_rows: int = COPY_ROWS,
) -> DataFrame:
    """Every row, marked ``unique``, ``chosen`` (first of its group) or ``duplicate``.

    The first row is the one with the least ``order`` (NULL last); ties go by content, and of rows that are equal
    in every column exactly one is chosen. ``chosen`` names an optional column with the order value of the chosen
    row (NULL if unique). Equal rows are counted in their tasks before anything is shuffled; what is left of a large
    group meets the group's first row in slices, and the copies of one row are written out by all tasks.
    """
    same = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    same = same.select("*", F.struct(*compared).alias("_key"), _place(df, compared, order).alias("_place"))
    groups = same.groupBy("_key").agg(F.sum("_copies").alias("_rows"), F.min("_place").alias("_first"))
    joined = join_sliced(same, groups, ["_key"], slice_rows=slice_rows)
    marked = number_copies(joined, "_copies", "_nth", copy_rows)
    first = (F.col("_place") == F.col("_first")) & (F.col("_nth") == 0)
    mark = F.when(F.col("_rows") == 1, "unique").when(first, "chosen").otherwise("duplicate")
    extra = [mark.alias(status)]
    if chosen:
        extra.append(F.when(F.col("_rows") > 1, F.col(f"_first.{order}")).alias(chosen))
    return marked.select(*df.columns, *extra)

"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds at least 1/HOT_PARTS of the counted rows, so there are never more than
# HOT_PARTS hot keys and their table can be broadcast whatever the size of the input. Keys below
# SLICE_ROWS rows are left alone; a hot key is cut into slices of about that many rows.
HOT_PARTS = 10_000
SLICE_ROWS = 1_000_000
# Rows of the large side that a task sorts for a join whose size is known, so that its memory stays the same as rows grow.
TASK_ROWS = 1_000_000
# Rows of a dimension that Spark may broadcast. It judges a written table by the size of its files, where a row may take a
# few bytes; in the hash table, which the driver builds and every executor holds, a row takes 50 to some hundred bytes.
BROADCAST_ROWS = 500_000
SLICE = "_slice"
ROW = "_row"


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, pre-aggregated before the shuffle; rows without a key are not counted."""
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(has_key).groupBy(*keys).agg(F.count("*").alias("_rows"))


def hot_keys(counts: DataFrame, keys: list[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The hot keys of a ``key_counts`` frame and the number of slices to cut each into."""
    share = counts.agg(F.sum("_rows") / HOT_PARTS).scalar()
    rows = F.col("_rows")
    return counts.filter((rows >= slice_rows) & (rows >= share)).select(
        *keys, F.ceil(rows / F.lit(slice_rows)).cast("int").alias("_slices")
    )


def with_row_id(df: DataFrame) -> DataFrame:
    """Add ``_row``, a number that differs from row to row, by which ``cut`` deals the rows of hot keys.

    To be added to a scan of written data, which reads its rows in the same order when a task is repeated.
    """
    return df.withColumn(ROW, F.monotonically_increasing_id())


def cut(big: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Add a slice number: 0 for most rows, spread over its slices for a hot key.

    Rows with a ``_row`` are dealt by it, so that equal rows are spread as well, and lose it; others by their
    values and their input partition. Either way a repeated task cuts the same way. Rows without a key match
    nothing in a join and are spread as well.
    """
    columns = [c for c in big.columns if c != ROW]
    by = [F.col(ROW)] if ROW in big.columns else [F.spark_partition_id(), *[F.col(c) for c in columns]]
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    slices = F.when(no_key, F.lit(HOT_PARTS)).otherwise(F.col("_slices"))
    number = F.when(slices.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*by), slices))
    marked = big.join(F.broadcast(hot), keys, "left")
    return marked.select(*columns, number.cast("int").alias(SLICE))


def repeat(side: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Add a slice number, with one copy of the row for each slice of its key."""
    last = F.coalesce(F.col("_slices"), F.lit(1)) - 1
    marked = side.join(F.broadcast(hot), keys, "left")
    return marked.select(*side.columns, F.explode(F.sequence(F.lit(0), last)).alias(SLICE))


def deal(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """The frame, dealt by its keys for a join on them whose large side has so many ``rows``.

    Only where the session's partitions would hold more than ``TASK_ROWS`` of them each, it is dealt over more; to be
    done with both sides of the join alike, which then needs no other shuffle.
    """
    tasks = -(-rows // TASK_ROWS)
    few = tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df if few else df.repartition(tasks, *keys)


def join_cut(big: DataFrame, side: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join a ``cut`` with a ``repeat`` frame: the result is that of the plain join.

    ``how`` may be inner, left, left_semi or left_anti. Both sides are taken to be large: the join
    sorts and merges, which spills where a hash table would not fit, and broadcasts neither.
    """
    return big.hint("merge").join(side, [*keys, SLICE], how).drop(SLICE)


def join_sliced(
    big: DataFrame,
    side: DataFrame,
    keys: list[str],
    how: str = "inner",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Shuffle join in which the hot keys of ``big`` are spread over many tasks."""
    hot = hot_keys(key_counts(big, keys), keys, slice_rows)
    return join_cut(cut(big, hot, keys), repeat(side, hot, keys), keys, how)


def lookup(df: DataFrame, dimension: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi-join with a dimension that is unique on the key.

    Up to ``BROADCAST_ROWS`` rows without a hint: Spark broadcasts the dimension when the size of its files allows. A larger
    one is merged, which needs no hash table: both sides are shuffled, where adaptive execution splits the partitions of
    hot keys. So what the driver holds of a dimension does not grow with it.
    """
    large = dimension.count() > BROADCAST_ROWS
    return df.join(dimension.hint("merge") if large else dimension, key, how)


def existing(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in the parent table."""
    return df.join(parent.select(key), key, "left_semi")

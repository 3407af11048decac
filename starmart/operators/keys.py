"""Surrogate keys 1..n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import scratch_path

_POSITION_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the position in its low 33 bits


def dense_key(df: DataFrame, order_by: list[str | Column], name: str) -> DataFrame:
    """Put a key 1..n before the columns, in the stated order (which must have no ties).

    The rows are range-sorted over the cluster, whatever their number; see ``number_rows``.
    """
    return number_rows(df.sort(*order_by), name)


def number_rows(df: DataFrame, name: str) -> DataFrame:
    """Put a key 1..n before the columns, in the order in which the rows lie.

    The rows are written once to the shared scratch folder with the number of their task and their
    position in it. A row's key is its position plus the rows of all earlier tasks; the table of
    those offsets has one row per task, so it is small for any input. The written copy also keeps
    the keys the same however often the result is read and whichever executors are lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS))
    placing = df.select("*", F.spark_partition_id().alias("_task"), position.alias("_position"))
    placing.write.parquet(path)
    placed = spark.read.schema(placing.schema).parquet(path)
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_task")
        .agg(F.count("*").alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    key = (F.col("_before") + F.col("_position") + 1).alias(name)
    return placed.join(F.broadcast(offsets), "_task").select(key, *df.columns)


def sparse_key(df: DataFrame, name: str) -> DataFrame:
    """Put a unique, ascending key with gaps before the columns: no extra pass over the rows."""
    return df.select((F.monotonically_increasing_id() + 1).alias(name), *df.columns)

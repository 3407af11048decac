"""Places of rows within their groups, whatever the size of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.columns import join_groups
from starmart.operators.keys import dense_key
from starmart.session import scratch_path


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_places(rows: DataFrame, group: str, order: list[str | Column]) -> DataFrame:
    """Rows with ``pos``, their place in their group from 0, and ``n``, the number of its rows.

    The rows are sorted by group and order over the cluster and numbered; a place is the number less the least one
    of the group. A group of any size is spread over tasks: no task sorts or counts it alone. The group must not be
    null, and the order must have no ties within a group.
    """
    numbered = dense_key(rows, [group, *order], "_number")
    groups = written(numbered.groupBy(group).agg(F.min("_number").alias("_first"), F.count("*").alias("n")), "groups")
    placed = join_groups(numbered, groups, [group], "n", numbered.count())
    return placed.select(*rows.columns, (F.col("_number") - F.col("_first")).alias("pos"), "n")

"""Shares, ranks and row ranges over a whole result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.numbers import percent
from starmart.operators.keys import dense_key
from starmart.session import scratch_path


def share_of(df: DataFrame, value: str, within: list[str], name: str, digits: int) -> DataFrame:
    """Add the percentage that the value is of the total of its group.

    For aggregated frames: a group then holds one row per remaining grouping value, such as one row per product
    category, and all rows of a group meet in one task.
    """
    total = F.sum(value).over(Window.partitionBy(*within))
    return df.withColumn(name, percent(F.col(value), total, digits))


#: Distinct values of a ranking that one task sorts, and ranges of values at most.
RANGE_VALUES, RANK_RANGES = 100_000, 200


def rank_descending(df: DataFrame, value: str, key: str, name: str, range_values: int = RANGE_VALUES) -> DataFrame:
    """Add the rank by descending value over the whole frame; equal values share a rank, with gaps; NULL comes first.

    ``value`` is a number, date or timestamp; ``key`` only names the rows. The rows are written once, as they come, so
    that what they are made of is worked out once. They are counted by value before anything is shuffled, and more than
    ``range_values`` distinct values are dealt into ranges by bounds that one pass estimates (bounds move work, never
    ranks). A value's rank is one more than the rows of higher ranges and of higher values in its own: sums over a table
    of at most ``RANK_RANGES`` + 1 rows and over one range. Rows meet their value's rank in one lookup, where adaptive
    execution broadcasts the values if they are few and else splits the rows of a frequent one.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ranked")
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    counts = rows.groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_rows"))
    ranges = min(RANK_RANGES, -(-counts.count() // range_values))
    fall = F.col("_value").desc_nulls_first()
    before, offsets = Window.orderBy(fall), None
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        bounds = counts.agg(F.percentile_approx("_value", shares, F.lit(10 * ranges))).first()[0]
        chosen = F.array(*[F.lit(b) for b in sorted(set(bounds))])
        # The further a range is down, the more bounds are at or above its values.
        higher = F.size(F.filter(chosen, lambda b: b >= F.col("_value")))
        counts = counts.withColumn("_range", F.when(F.col("_value").isNull(), -1).otherwise(higher))
        before = Window.partitionBy("_range").orderBy(fall)
        sums = F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
        totals = counts.groupBy("_range").agg(F.sum("_rows").alias("_sum"))
        offsets = totals.select("_range", F.coalesce(sums, F.lit(0)).alias("_before"))
    earlier = F.sum("_rows").over(before.rowsBetween(Window.unboundedPreceding, -1))
    ranks = counts.withColumn(name, F.coalesce(earlier, F.lit(0)) + 1)
    if offsets is not None:
        ranks = ranks.join(F.broadcast(offsets), "_range").withColumn(name, F.col("_before") + F.col(name))
    return rows.join(ranks.select("_value", name), F.col(value).eqNullSafe(F.col("_value"))).select(*df.columns, name)


def top(df: DataFrame, order_by: list[Column], k: int) -> DataFrame:
    """The first k rows: every task keeps k rows of its own before they meet."""
    return df.orderBy(*order_by).limit(k)


def row_range(
    df: DataFrame, order_by: list[str | Column], skip: int = 0, rows: int | None = None
) -> DataFrame:
    """The rows after the first ``skip``, at most ``rows`` of them, in the stated order."""
    numbered = dense_key(df, order_by, "_number")
    wanted = F.col("_number") > skip
    if rows is not None:
        wanted = wanted & (F.col("_number") <= skip + rows)
    return numbered.filter(wanted).drop("_number")

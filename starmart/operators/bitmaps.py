"""Exact distinct counts that can be added up: sets of numbers as bitmaps.

A distinct count over groups can't be made of the distinct counts of smaller groups. A set of the numbers can: it is
kept as bitmaps of 4 KB, each for 32,768 neighbouring numbers, built once for the finest groups and joined by OR for
any coarser ones. Numbers without holes, such as ``dense_key`` gives, fill their bitmaps. A group of any size is a row
for each of its bitmaps, so it is spread over tasks; what one task adds up for a group is one number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "_bucket", "_bits"


def distinct_bitmaps(df: DataFrame, groups: list[str], number: str) -> DataFrame:
    """One row per group and bitmap: the distinct ``number`` values (NULL left out), which must be 0 or more."""
    number = F.when(F.col(number) < 0, F.raise_error(F.lit("a number below 0")).cast("long")).otherwise(F.col(number).cast("long"))
    rows = df.select(*groups, number.alias("_number")).filter(F.col("_number").isNotNull())
    placed = rows.select(*groups, F.bitmap_bucket_number("_number").alias(BUCKET), F.bitmap_bit_position("_number").alias("_place"))
    return placed.groupBy(*groups, BUCKET).agg(F.bitmap_construct_agg("_place").alias(BITS))


def merged(bitmaps: DataFrame, groups: list[str]) -> DataFrame:
    """The bitmaps of coarser groups."""
    return bitmaps.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, groups: list[str], name: str) -> DataFrame:
    """The number of distinct numbers of each group; without groups one row, also if there is no bitmap."""
    counted = merged(bitmaps, groups).select(*groups, F.bitmap_count(BITS).alias("_count"))
    return counted.groupBy(*groups).agg(F.coalesce(F.sum("_count"), F.lit(0)).alias(name))


def rolled_up(bitmaps: DataFrame, sets: list[list[str]], name: str) -> DataFrame:
    """Counts for several groupings, stacked: columns that a grouping lacks are NULL, and ``grouped_by`` names it."""
    columns = list(dict.fromkeys(c for group in sets for c in group))
    kinds = {f.name: f.dataType for f in bitmaps.schema.fields}
    parts = []
    for group in sets:
        counted = distinct_counts(bitmaps, group, name)
        shown = [F.col(c) if c in group else F.lit(None).cast(kinds[c]).alias(c) for c in columns]
        parts.append(counted.select(F.lit(",".join(group)).alias("grouped_by"), *shown, name))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found

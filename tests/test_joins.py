"""The sliced join gives what the plain join gives."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmart.operators import joins
from starmart.operators.joins import SLICE, cut, existing, hot_keys, join_cut, join_sliced, key_counts, lookup, repeat, with_row_id


def frames(spark):
    big = spark.createDataFrame(
        [(None if i % 5 == 0 else 1 if i % 3 == 0 else i % 40, i) for i in range(900)], "k int, v int"
    ).repartition(6)
    side = spark.createDataFrame([(k, f"s{k}") for k in range(0, 30)] + [(2, "again")], "k int, s string")
    return big, side


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("slice_rows", [1, 10, 1_000_000])
def test_same_as_plain_join(spark, rows, how, slice_rows):
    big, side = frames(spark)
    sliced = join_sliced(big, side, ["k"], how, slice_rows=slice_rows)
    plain = big.join(side, ["k"], how)
    assert sliced.columns == plain.columns
    assert rows(sliced) == rows(plain)


def test_hot_key_is_cut_into_slices(spark):
    big, _ = frames(spark)
    counts = key_counts(big, ["k"])
    hot = {r.k: r._slices for r in hot_keys(counts, ["k"], slice_rows=100).collect()}
    assert hot == {1: -(-counts.filter("k = 1").first()._rows // 100)}


def test_slices_spread_over_tasks(spark):
    big = spark.range(4000, numPartitions=8).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    side = spark.createDataFrame([(1, "x")], "k int, s string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = join_sliced(big, side, ["k"], slice_rows=50)
        tasks = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in tasks) == 4000
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 2000


def test_composite_keys(spark, rows):
    big = spark.createDataFrame([(i % 2, i % 3, i) for i in range(60)], "a int, b int, v int")
    side = spark.createDataFrame([(0, 0, "x"), (1, 2, "y")], "a int, b int, s string")
    assert rows(join_sliced(big, side, ["a", "b"], slice_rows=2)) == rows(big.join(side, ["a", "b"]))


def test_existing(spark):
    big, side = frames(spark)
    kept = existing(big, side, "k")
    assert kept.columns == big.columns
    assert kept.count() == sum(1 for i in range(900) if i % 5 and (i % 3 == 0 or i % 40 < 30))


def test_equal_rows_of_a_hot_key_use_all_slices(spark, rows):
    big = spark.range(1000, numPartitions=4).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    side = spark.createDataFrame([(1, "x")], "k int, s string")
    hot = hot_keys(key_counts(big, ["k"]), ["k"], slice_rows=10)
    dealt = cut(with_row_id(big), hot, ["k"])
    assert dealt.columns == ["k", "v", SLICE]
    sizes = [r["count"] for r in dealt.groupBy(SLICE).count().collect()]
    assert len(sizes) == 100 and max(sizes) < 40
    assert rows(join_cut(dealt, repeat(side, hot, ["k"]), ["k"])) == rows(big.join(side, "k"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_many_rows_in_a_small_file_are_not_broadcast(spark, tmp_path, how):
    """The files of the dimension are far smaller than the limit for broadcasts, its hash table is not."""
    key = F.lpad(F.col("id").cast("string"), 20, "0")
    spark.range(600_000).select(key.alias("k"), F.col("id").alias("v")).write.parquet(f"{tmp_path}/many", compression="zstd")
    dimension = spark.read.parquet(f"{tmp_path}/many")
    ids = [0, 1, 1, 599_999, 600_000, None]
    df = spark.createDataFrame([(i,) for i in ids], "id long").select(key.alias("k"), "id")
    assert sum(path.stat().st_size for path in tmp_path.glob("many/*.parquet")) < 10_000_000
    joined = lookup(df, dimension, "k", how)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    want = [(i, i if i is not None and i < 600_000 else None) for i in ids]
    got = [(r["id"], r["v"]) for r in joined.collect()]
    assert sorted(got, key=str) == sorted([w for w in want if how == "left" or w[1] is not None], key=str)


def test_few_rows_are_broadcast(spark, monkeypatch, rows):
    big, _ = frames(spark)
    side = spark.range(30).select(F.col("id").cast("int").alias("k"), F.col("id").alias("s"))
    few = lookup(big, side, "k")
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 29)
    many = lookup(big, side, "k")
    assert "Broadcast" not in many._jdf.queryExecution().executedPlan().toString()
    assert many.columns == few.columns and rows(many) == rows(few)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_merged_lookup_of_repeated_and_missing_keys(spark, monkeypatch, rows, how):
    big, side = frames(spark)
    side = side.unionByName(spark.createDataFrame([(None, "none")], side.schema))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    merged = lookup(big, side, "k", how)
    assert rows(merged) == rows(big.join(side, "k", how))

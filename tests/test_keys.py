"""Surrogate keys, ranks and row ranges over one and many tasks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from starmart.operators.keys import dense_key, number_rows, sparse_key
from starmart.operators.ranking import rank_descending, row_range, share_of, top


@pytest.mark.parametrize("partitions", [1, 4, 200])
@pytest.mark.parametrize("size", [0, 1, 1000])
def test_dense_keys_do_not_depend_on_the_partitions(spark, partitions, size):
    values = random.Random(1).sample(range(10_000), size)
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(partitions)
    keyed = dense_key(df, ["v"], "k").collect()
    assert {r.v: r.k for r in keyed} == {v: i for i, v in enumerate(sorted(values), 1)}


def test_one_value_holds_a_third_of_the_first_sort_column(spark):
    data = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(data, "a int, b int").repartition(20)
    keyed = sorted((r.k, r.a, r.b) for r in dense_key(df, ["a", "b"], "k").collect())
    assert [k for k, *_ in keyed] == list(range(1, 3001))
    assert [(a, b) for _, a, b in keyed] == sorted(data)


def test_number_rows_and_sparse_key(spark):
    df = spark.range(0, 1000, numPartitions=13).withColumnRenamed("id", "v")
    numbers = [r.k for r in number_rows(df, "k").collect()]
    assert sorted(numbers) == list(range(1, 1001))
    assert len({r.k for r in sparse_key(df, "k").collect()}) == 1000


def test_numbered_rows_read_the_same_twice(spark, rows):
    numbered = number_rows(spark.range(100).withColumn("x", F.rand()), "k")
    assert rows(numbered) == rows(numbered)


def test_rank_has_gaps_and_ties(spark):
    values = [random.Random(2).randint(0, 20) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(7)
    ranked = rank_descending(df, "v", "id", "r").collect()
    assert {x.id: x.r for x in ranked} == {
        i: 1 + sum(w > v for w in values) for i, v in enumerate(values)
    }


def test_share_and_top(spark):
    df = spark.createDataFrame([("q1", "a", 1), ("q1", "b", 3), ("q2", "a", 0)], "q string, c string, v int")
    shares = {(r.q, r.c): r.p for r in share_of(df, "v", ["q"], "p", 1).collect()}
    assert shares == {("q1", "a"): 25.0, ("q1", "b"): 75.0, ("q2", "a"): None}
    assert [r.v for r in top(df, [F.desc("v"), F.col("c")], 2).collect()] == [3, 1]


def test_row_range(spark):
    df = spark.range(0, 100, numPartitions=6)
    assert sorted(r.id for r in row_range(df, ["id"], skip=10, rows=5).collect()) == list(range(10, 15))
    assert row_range(df, ["id"], skip=90).count() == 10

"""Bucketed and partitioned tables, the pointer of a whole load, domains, bitmaps, merged files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from starmart.driver.marts import mart_by_year, new_namespace, source_file
from starmart.mapping import RAW
from starmart.operators import bitmaps, checks
from starmart.operators.duplicates import number_copies
from starmart.operators.ranking import rank_descending
from starmart.plans import warehouse
from starmart.plans.fact import fact_lines, fact_lines_by_bucket, line_orders, with_order_year
from starmart.session import scratch_path
from starmart.sources import tables
from starmart.sources.delimited import SAME, scan_merged
from starmart.sources.tables import Layout, publish, write_version

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def built(spark):
    return mart_by_year(spark, SF_DIR)


def test_the_join_of_lines_and_orders_has_no_exchange(built):
    joined = line_orders(built.tables["order_details"], built.tables["orders"])
    text = plan(joined)
    assert text.count("SortMergeJoin [order_id") == 2 and "Bucketed: true" in text and "Exchange" not in text
    assert joined.count() == built.tables["order_details"].count()


def test_a_year_is_read_from_its_folder(built):
    text = plan(built.fact.filter("order_year = 1996"))
    assert "PartitionFilters: [isnotnull(order_year" in text and "1996" in text


def test_both_joins_give_one_fact(built, rows):
    lines, orders = built.tables["order_details"], built.tables["orders"]
    sliced = with_order_year(fact_lines(lines, orders, built.dims), built.dims)
    assert rows(fact_lines_by_bucket(lines, orders, built.dims)) == rows(sliced)


def test_a_hot_order_is_spread_and_not_bucketed(spark, built, monkeypatch):
    monkeypatch.setattr(warehouse, "has_hot_orders", lambda lines: True)
    used = []
    real = warehouse.fact_lines
    monkeypatch.setattr(warehouse, "fact_lines", lambda *a: used.append(1) or real(*a))
    version = warehouse.write_fact(built.tables, built.dims, new_namespace(spark, "hot"), by_year=True, bucketed=True)
    assert used and version.rows.count() == built.fact.count()


def test_bucketed_and_partitioned_versions_replace_each_other(spark):
    name = f"{new_namespace(spark, 'layout')}.t"
    df = spark.range(100).select("id", (F.col("id") % 3).alias("third"))
    layouts = [Layout(), Layout(("id",), 4), Layout(("id",), 4), Layout(("id",), 6), Layout(partition_by=("third",)), Layout(partition_by=("third",)), Layout()]
    for n, layout in enumerate(layouts):
        publish([write_version(df.filter(F.col("id") < 50 + n), name, layout)])
        assert spark.table(name).count() == 50 + n and spark.table(name).columns == ["id", "third"]
        assert tables.buckets_of(spark, name) == (layout.buckets, list(layout.bucket_by))
    assert [t.name for t in spark.catalog.listTables(name.partition(".")[0])] == ["t"]


@pytest.fixture(scope="module")
def folder(spark):
    for file in RAW:
        place = source_file(spark, SF_DIR, file)
    return place


def test_a_whole_load_has_one_pointer(spark, folder, monkeypatch):
    location = scratch_path(spark, "warehouse")
    reports = warehouse.build_warehouse(spark, folder, location, by_year=True, buckets=4)
    expected = {name: df.count() for name, df in reports.items()}
    first = warehouse.open_warehouse(spark, location)
    assert {name: df.count() for name, df in warehouse.reports_of(first).items()} == expected

    def dying(versions):
        raise KeyboardInterrupt

    monkeypatch.setattr(warehouse, "publish", dying)
    with pytest.raises(KeyboardInterrupt):
        warehouse.build_warehouse(spark, folder, location, by_year=True, buckets=4)
    monkeypatch.undo()
    place = warehouse.table_set(spark, location)
    assert place.state().number == 2
    moved = warehouse.recover_names(spark, location)
    assert set(moved) == set(place.state().tables) and warehouse.recover_names(spark, location) == []
    second = warehouse.open_warehouse(spark, location)
    assert {name: df.count() for name, df in second.items()} == {name: df.count() for name, df in first.items()}
    assert spark.table("datamart.fact_orders").count() == second["datamart.fact_orders"].count()
    warehouse.build_warehouse(spark, folder, location, remove_old=True)
    assert place.state().number == 3 and warehouse.open_warehouse(spark, location)["staging.orders"].count() > 0
    assert len(place._numbers()) == 1


def test_ranks_of_values_that_are_null_or_far_apart(spark):
    draw = random.Random(5)
    values = [draw.choice([None, 0, 1, 10**12 + draw.randrange(50), draw.randrange(100), -5]) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v long").repartition(9)
    height = lambda v: float("inf") if v is None else v
    expected = {i: 1 + sum(height(w) > height(v) for w in values) for i, v in enumerate(values)}
    for range_values in (1, 20, 100_000):
        assert {r.id: r.r for r in rank_descending(df, "v", "id", "r", range_values).collect()} == expected
    assert rank_descending(df.limit(0), "v", "id", "r").count() == 0
    assert {r.r for r in rank_descending(df.withColumn("v", F.lit(None).cast("long")), "v", "id", "r").collect()} == {1}


def test_many_copies_are_written_by_all_tasks(spark):
    df = spark.createDataFrame([("a", 10_000_000), ("b", 1), ("c", 3)], "x string, n long")
    copies = number_copies(df, "n", "nth")
    parts = copies.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    large = [r.n for r in parts if r.n > 10]
    assert len(large) == 8 and max(large) < 0.3 * 10_000_000 and sum(r.n for r in parts) == 10_000_004
    small = number_copies(df.filter("n < 10").unionByName(spark.createDataFrame([("d", 25)], df.schema)), "n", "nth", copy_rows=10)
    assert sorted((r.x, r.nth) for r in small.collect()) == sorted([("b", 0)] + [("c", i) for i in range(3)] + [("d", i) for i in range(25)])


def test_foreign_keys_in_one_scan(spark, rows, tmp_path):
    child = [(1, "x", 5), (2, "y", None), (2, None, 7), (9, "x", 5)]
    spark.createDataFrame(child, "a long, b string, c int").write.parquet(f"{tmp_path}/child")
    df = spark.read.parquet(f"{tmp_path}/child")
    numbers = spark.createDataFrame([(1,), (2,)], "k long")
    texts = spark.createDataFrame([("x",), (None,)], "k string")
    found = checks.orphan_counts({"a": (df, "a", numbers, "k"), "b": (df, "b", texts, "k"), "c": (df, "c", numbers, "k"), "other": (numbers, "k", df, "a")})
    assert rows(found) == [("a", 1, 1), ("b", 1, 1), ("c", 2, 3), ("other", 0, 0)]
    one = checks.orphan_counts({"a": (df, "a", numbers, "k"), "b": (df, "b", texts, "k")})
    assert plan(one).count("FileScan parquet") == 1


def test_domains(spark, rows):
    data = [(i, "ab"[i % 2], None, f"t{i:02}", i % 5 if i % 2 else None) for i in range(30)]
    df = spark.createDataFrame(data, "id int, two string, none string, many string, five int")
    found = {(r.column_name, r.kind, r.value, r.rows, r.low, r.high) for r in checks.column_domains(df, list_values=5).collect()}
    assert {f for f in found if f[1] != "list"} == {("id", "bounds", None, None, "0", "29"), ("none", "empty", None, None, None, None), ("many", "bounds", None, None, "t00", "t29")}
    assert {f[:4] for f in found if f[1] == "list"} == {("two", "list", "a", 15), ("two", "list", "b", 15), *(("five", "list", str(i), 3) for i in range(5))}
    assert {r.kind for r in checks.column_domains(df.limit(0)).collect()} == {"empty"}


def test_bitmaps_equal_distinct_counts(spark, rows):
    draw = random.Random(3)
    data = [(draw.choice("ab"), draw.choice(["x", None]), draw.choice([None, draw.randrange(100_000), 5])) for _ in range(3000)]
    df = spark.createDataFrame(data, "g string, h string, n long").repartition(5)
    fine = bitmaps.distinct_bitmaps(df, ["g", "h"], "n")
    for groups in (["g", "h"], ["g"], ["h"], []):
        expected = df.filter("n IS NOT NULL").groupBy(*groups).agg(F.count_distinct("n").alias("c"))
        assert rows(bitmaps.distinct_counts(fine, groups, "c")) == rows(expected)
    assert bitmaps.distinct_counts(fine.limit(0), [], "c").collect()[0].c == 0
    with pytest.raises(Exception, match="below 0"):
        bitmaps.distinct_bitmaps(df.withColumn("n", F.lit(-1)), ["g"], "n").collect()


def write(spark, folder, name, text):
    spark.createDataFrame([(line,) for line in text.split("\n")], "value string").coalesce(1).write.text(f"{folder}/{name}")


def test_files_with_other_columns(spark, rows):
    folder = scratch_path(spark, "merge")
    write(spark, folder, "a", '# a comment\nid;"name; x";size\n1;"a;b";3\n2;;3000000000')
    write(spark, folder, "b", 'size;id\n1.5;3\n;4')
    write(spark, folder, "c", "id;note\n5;# no comment")
    found = scan_merged(spark, [f"{folder}/{n}" for n in "abc"])
    assert dict(found.dtypes) == {"id": "int", "name; x": "string", "size": "double", "note": "string"}
    assert rows(found.select("id", "`name; x`", "size", "note")) == [
        (1, "a;b", 3.0, None), (2, None, 3e9, None), (3, None, 1.5, None), (4, None, None, None), (5, None, None, "# no comment"),
    ]
    with pytest.raises(ValueError, match="headers differ"):
        scan_merged(spark, [f"{folder}/a", f"{folder}/b"], mode=SAME)
    write(spark, folder, "d", "id;size\n7;8")
    assert scan_merged(spark, [f"{folder}/b", f"{folder}/d"], mode=SAME).count() == 3
    write(spark, folder, "e", "id;id\n7;8")
    with pytest.raises(ValueError, match="repeats"):
        scan_merged(spark, [f"{folder}/e"])
    write(spark, folder, "none", "")
    with pytest.raises(ValueError, match="no file"):
        scan_merged(spark, [f"{folder}/none"])

"""What only shows on larger tables: keys of more digits, casts that fail, tasks whose memory grows with the input."""

from __future__ import annotations

import oracle
import pytest
from pyspark.sql import functions as F

from starmart import mapping
from starmart.driver import marts
from starmart.driver.marts import mart
from starmart.driver.oracles import ORACLES
from starmart.driver.queries import REGISTRY
from starmart.operators import bitmaps, joins
from starmart.plans import contracts, reports
from starmart.plans.fact import FACT_COLUMNS, fact_lines
from starmart.sources import delimited
from starmart.sources.tables import buckets_of

SF_DIR = "/root/testdata/sf0.001"
KEYS = {"customer": ["c_custkey"], "orders": ["o_custkey"]}


@pytest.fixture(scope="module")
def long_keys(spark, tmp_path_factory):
    """The small tables with customer keys of seven digits."""
    folder = tmp_path_factory.mktemp("long-keys")
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        df = mapping.table(spark, SF_DIR, name)
        df = df.withColumns({c: F.col(c) + 1_000_000 for c in KEYS.get(name, [])})
        df.coalesce(1).write.parquet(f"{folder}/{name}")
        (part,) = (folder / name).glob("*.parquet")
        part.rename(folder / f"{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["raw_to_fact", "raw_to_employee_performance"])
def test_customer_keys_of_more_than_five_digits(spark, long_keys, name):
    connection = oracle.connect(long_keys)
    assert oracle.differences(REGISTRY[name](spark, long_keys), connection, ORACLES[name]) is None


def test_other_widths_leave_the_declared_ones():
    wider = contracts.with_lengths(contracts.STAGING["customers"], customer_id=20)
    assert (wider.lengths["customer_id"], wider.lengths["phone"]) == (20, 30)
    assert contracts.STAGING["customers"].lengths["customer_id"] == 5


def test_inferred_kinds_equal_casts(spark, tmp_path):
    """Values that casts refuse, that fit one kind only, or that are at the bounds, alone and beside a number."""
    values = ["1", "+7", "-0", "2147483647", "2147483648", "-2147483648", "-2147483649", "9223372036854775807"]
    values += ["9223372036854775808", "00000000000000000000012", "1" * 25, "1.5", ".5", "5.", "1e3", "1E400", "1d", "NaN", "Infinity"]
    values += ["1,5", "12\x01", "\x7f12", "+", "-", ".", "e", "0x1", "many", "1 2", "12\x85", "12\n", "1.5\r\n", "1.5\n\n"]
    columns = {f"{i}_{j}": (v, w) for i, v in enumerate(values) for j, w in enumerate([None, "1", "1.5"])}
    df = spark.createDataFrame([tuple(v[k] for v in columns.values()) for k in (0, 1)], ",".join(f"`{c}` string" for c in columns))
    got = delimited.kinds_of(df)
    checks = [
        F.every(delimited.as_number(F.col(f"`{c}`"), kind).isNotNull() | F.col(f"`{c}`").isNull())
        for c in columns
        for kind in delimited.KINDS.values()
    ]
    fits = iter(df.select(*df.columns).agg(*checks).first())
    want = {c: next((k for k, fit in [(k, next(fits)) for k in delimited.KINDS] if fit), "string") for c in columns}
    assert [(columns[c], got[c], want[c]) for c in columns if got[c] != want[c]] == []


def test_texts_are_not_cast_to_find_that_they_do_not_fit(spark, monkeypatch):
    """Each refused cast throws inside the engine: values that are no whole numbers are told by their characters."""
    df = spark.range(1000).selectExpr("concat('x', id) AS a", "concat(id, '.5') AS b")
    strict = lambda text, kind: text.cast(kind)  # noqa: E731  (fails the job instead of giving NULL)
    monkeypatch.setattr("pyspark.sql.Column.try_cast", strict)
    monkeypatch.setattr("pyspark.sql.classic.column.Column.try_cast", strict)
    assert delimited.kinds_of(df) == {"a": "string", "b": "double"}


@pytest.mark.parametrize("report", ["shipping_analysis", "employee_performance"])
def test_no_amount_is_kept_per_order(spark, report):
    """What is shuffled for each order is its id and the key alone."""
    built = mart(spark, SF_DIR)
    frames = {
        "shipping_analysis": lambda: reports.shipping_analysis(built.fact, built.dims.shipping),
        "employee_performance": lambda: reports._totals(built.fact, "employee_key", total_revenue="total_amount"),
    }
    plan = frames[report]()._jdf.queryExecution().executedPlan().toString().splitlines()
    by_order = [line for line in plan if "Aggregate(keys=[" in line and "order_id" in line.partition("functions=")[0]]
    assert by_order and all("functions=[]" in line for line in by_order)


def test_totals_of_missing_keys_and_orders(spark, rows):
    lines = [(1, 10, "1.25"), (1, 10, "2.25"), (1, None, "0.50"), (None, 11, "3.00"), (None, 11, None), (2, 12, None)]
    fact = spark.createDataFrame(lines, "key long, order_id long, amount string").withColumn("amount", F.col("amount").cast("decimal(12,2)"))
    got = reports._totals(fact, "key", total="amount")
    nested = fact.groupBy("key", "order_id").agg(F.sum("amount").alias("a")).groupBy("key")
    want = nested.agg(F.sum("a").alias("total"), F.count("*").alias("order_count"))
    assert got.schema["total"].dataType == want.schema["total"].dataType
    assert rows(got.select("key", "total", "order_count")) == rows(want)


def test_tables_are_written_small(spark):
    built = mart(spark, SF_DIR)
    assert all(name.endswith(".zstd.parquet") for name in built.fact.inputFiles())


def test_rollup_numbers_of_a_group_lie_together(spark, monkeypatch):
    """Scattered numbers would fill a bitmap for each range of numbers and group."""
    seen = []
    make = bitmaps.distinct_bitmaps
    monkeypatch.setattr(bitmaps, "distinct_bitmaps", lambda df, *a: seen.append(df) or make(df, *a))
    REGISTRY["orders_by_rollup"](spark, SF_DIR)
    spans = seen[0].groupBy("country", "year").agg(
        (F.max("number") - F.min("number") + 1).alias("span"), F.count_distinct("number").alias("orders")
    )
    assert spans.count() > 50 and spans.filter("span <> orders").isEmpty()


def test_buckets_follow_the_lines(spark, monkeypatch, rows):
    monkeypatch.setattr(marts, "BUCKET_LINES", 500)
    built = marts.mart_by_year(spark, f"{SF_DIR}/.")  # another name, so that it is built anew
    lines = built.tables["order_details"].count()
    for name in ("orders", "order_details"):
        assert buckets_of(spark, f"{built.namespace}.{name}") == (-(-lines // 500), ["order_id"])
    assert rows(built.fact.select(*FACT_COLUMNS)) == rows(mart(spark, SF_DIR).fact.select(*FACT_COLUMNS))


def test_many_lines_are_joined_by_more_tasks(spark, monkeypatch, rows):
    built = mart(spark, SF_DIR)
    plain = fact_lines(built.tables["order_details"], built.tables["orders"], built.dims)
    monkeypatch.setattr(joins, "TASK_ROWS", 500)
    dealt = fact_lines(built.tables["order_details"], built.tables["orders"], built.dims)
    tasks = -(-built.tables["order_details"].count() // 500)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(order_id") >= 3 and plan.count(f", {tasks}), REPARTITION_BY_NUM") == 3
    assert rows(dealt) == rows(plain)


def test_large_dimensions_are_not_held_by_the_driver(spark, monkeypatch, rows):
    """Customers, products and employees are merged with the rows that name them; only lists stay to be broadcast."""
    built = mart(spark, SF_DIR)
    plain = fact_lines(built.tables["order_details"], built.tables["orders"], built.dims)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    merged = fact_lines(built.tables["order_details"], built.tables["orders"], built.dims)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    for key in ("customer_id", "product_id", "employee_id", "order_date"):
        assert f"SortMergeJoin [{key}" in plan and f"BroadcastHashJoin [{key}" not in plan
    assert rows(merged) == rows(plain)

"""Loads that are refused or fail leave every table as it was."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmart.driver.marts import new_namespace, source_file, stand_ins
from starmart.mapping import RAW
from starmart.plans import contracts, warehouse
from starmart.plans.contracts import Contract, RefusedRows, divide, require
from starmart.session import scratch_path
from starmart.sources import tables
from starmart.sources.delimited import write_delimited
from starmart.sources.raw_schemas import FILES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark):
    for file in RAW:
        place = source_file(spark, SF_DIR, file)
    return place


def doubled(spark, folder, file):
    """A folder like this one with one file's first row twice."""
    place = scratch_path(spark, "doubled")
    for other in RAW:
        df = RAW[other](spark, SF_DIR).select(*FILES[other])
        if other == file:
            key = df.columns[0]
            copy = df.filter(F.col(key) == df.agg(F.min(key)).scalar())
            name = df.columns[1]
            changed = copy.withColumn(name, F.lit("9") if name != "ProductName" else F.lit("other"))
            df = df.unionByName(changed.select(*df.columns))
        write_delimited(df, f"{place}/{other}.csv")
    return place


def test_the_load(spark, folder):
    staging, datamart = new_namespace(spark, "staging"), new_namespace(spark, "datamart")
    staged = warehouse.load_staging(spark, folder, staging)
    dims = warehouse.load_dimensions(spark, staged, datamart)
    fact = warehouse.load_fact(staged, dims, datamart)
    assert fact.count() > 0 and fact.select("fact_id").distinct().count() == fact.count()
    again = warehouse.load_staging(spark, folder, staging)
    assert again["orders"].count() == staged["orders"].count()


@pytest.mark.parametrize("file", ["Customers", "Products", "Orders", "Employees"])
def test_a_repeated_key_fails_the_staging_load(spark, folder, file):
    namespace = new_namespace(spark, "staging")
    before = warehouse.load_staging(spark, folder, namespace)
    counts = {name: df.count() for name, df in before.items()}
    with pytest.raises(RefusedRows):
        warehouse.load_staging(spark, doubled(spark, folder, file), namespace)
    assert {name: tables.scan_table(spark, f"{namespace}.{name}").count() for name in before} == counts


def test_refused_rows_can_be_put_aside(spark, folder):
    namespace = new_namespace(spark, "staging")
    place = doubled(spark, folder, "Customers")
    loaded = warehouse.load_staging(spark, place, namespace, refused=warehouse.DIVERT)
    assert loaded["customers"].count() == loaded["customers"].select("customer_id").distinct().count()
    assert [r.write_error for r in tables.scan_table(spark, f"{namespace}.customers_refused").collect()] == ["duplicate key"]


@pytest.mark.parametrize("table", ["customers", "products", "employees", "categories"])
def test_doubled_parents_fail_the_dimensions(spark, table):
    frames = stand_ins(spark, SF_DIR)
    namespace = new_namespace(spark, "datamart")
    warehouse.load_dimensions(spark, frames, namespace)
    before = tables.scan_table(spark, f"{namespace}.dim_product").count()
    with pytest.raises(RefusedRows):
        warehouse.load_dimensions(spark, frames | {table: frames[table].unionByName(frames[table])}, namespace)
    assert tables.scan_table(spark, f"{namespace}.dim_product").count() == before


def test_doubled_orders_fail_the_fact(spark):
    frames = stand_ins(spark, SF_DIR)
    namespace = new_namespace(spark, "datamart")
    dims = warehouse.load_dimensions(spark, frames, namespace)
    warehouse.load_fact(frames, dims, namespace)
    orders = frames["orders"].unionByName(frames["orders"].limit(1))
    with pytest.raises(RefusedRows):
        warehouse.load_fact(frames | {"orders": orders}, dims, namespace)
    assert tables.scan_table(spark, f"{namespace}.fact_orders").count() == frames["order_details"].count()


def test_a_failure_between_writing_and_publishing_changes_nothing(spark, folder, monkeypatch):
    namespace = new_namespace(spark, "staging")
    before = warehouse.load_staging(spark, folder, namespace)
    places = {name: tables._location(spark, f"{namespace}.{name}") for name in before}

    def broken(versions):
        raise OSError("lost")

    monkeypatch.setattr(warehouse, "publish", broken)
    with pytest.raises(OSError):
        warehouse.load_staging(spark, folder, namespace)
    assert {name: tables._location(spark, f"{namespace}.{name}") for name in before} == places


def test_contracts(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "id int, name string")
    contract = Contract(["id"], ["name", "not there"])
    with pytest.raises(RefusedRows, match="1 repeated"):
        require(df, contract, "t")
    require(df.filter("name = 'a'"), contract, "t")
    good, bad = divide(df, contract)
    assert rows(good) == [(1, "a")]
    assert rows(bad.select("id", "write_error")) == [(None, "no id"), (1, "duplicate key"), (2, "no name")]
    assert set(contracts.STAGING) == {"categories", "customers", "products", "orders", "order_details", "employees"}

"""The star schema over the driver's tables, built once per session and data folder."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from starmart import mapping
from starmart.plans import contracts
from starmart.plans.fact import Dimensions
from starmart.plans.warehouse import load_dimensions, load_fact, load_staging
from starmart.session import scratch_path
from starmart.sources.tables import Layout, create_namespace, publish, write_version

_BUILT: dict[tuple[str, str, str], object] = {}


@dataclass(frozen=True)
class Mart:
    namespace: str
    tables: dict[str, DataFrame]
    dims: Dimensions
    fact: DataFrame


def _once(spark: SparkSession, sf_dir: str, what: str, build):
    key = (spark.conf.get("spark.app.id", "local"), sf_dir, what)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def new_namespace(spark: SparkSession, label: str) -> str:
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    create_namespace(spark, name, scratch_path(spark, name))
    return name


def stand_ins(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The driver's tables as staging tables."""
    return {
        "categories": mapping.categories(spark, sf_dir),
        "customers": mapping.customers(spark, sf_dir),
        "products": mapping.products(spark, sf_dir),
        "orders": mapping.orders(spark, sf_dir),
        "order_details": mapping.order_details(spark, sf_dir),
        "employees": mapping.employees(spark, sf_dir),
    }


def dimensions(spark: SparkSession, sf_dir: str) -> tuple[str, Dimensions]:
    def build() -> tuple[str, Dimensions]:
        namespace = new_namespace(spark, "datamart")
        return namespace, load_dimensions(spark, stand_ins(spark, sf_dir), namespace)

    return _once(spark, sf_dir, "dimensions", build)


def mart(spark: SparkSession, sf_dir: str) -> Mart:
    """Dimensions and fact as written tables."""

    def build() -> Mart:
        tables = stand_ins(spark, sf_dir)
        namespace, dims = dimensions(spark, sf_dir)
        return Mart(namespace, tables, dims, load_fact(tables, dims, namespace))

    return _once(spark, sf_dir, "mart", build)


def source_file(spark: SparkSession, sf_dir: str, file: str) -> str:
    """The folder that holds this source file, written from the driver's tables."""
    folder = _once(spark, sf_dir, "folder", lambda: scratch_path(spark, "files"))
    _once(
        spark, sf_dir, file, lambda: mapping.write_source_file(spark, sf_dir, folder, file) or True
    )
    return folder


#: The driver's keys are written into text columns as numbers, of up to 20 characters, and not as codes of five.
KEY_DIGITS = 20
STAGING_CONTRACTS = contracts.STAGING | {
    "customers": contracts.with_lengths(contracts.STAGING["customers"], customer_id=KEY_DIGITS),
    "orders": contracts.with_lengths(contracts.STAGING["orders"], customer_id=KEY_DIGITS),
    "employees": contracts.with_lengths(contracts.STAGING["employees"], extension=KEY_DIGITS),
}


def mart_from_files(spark: SparkSession, sf_dir: str) -> Mart:
    """Source files to staging tables to star schema."""

    def build() -> Mart:
        for file in mapping.RAW:
            folder = source_file(spark, sf_dir, file)
        staging = new_namespace(spark, "staging")
        tables = load_staging(spark, folder, staging, held_to=STAGING_CONTRACTS)
        namespace = new_namespace(spark, "datamart")
        dims = load_dimensions(spark, tables, namespace)
        return Mart(namespace, tables, dims, load_fact(tables, dims, namespace, held_to=STAGING_CONTRACTS))

    return _once(spark, sf_dir, "mart from files", build)


#: Buckets of orders and lines at least, and lines that a bucket, which one task sorts, is to hold at most.
BUCKETS, BUCKET_LINES = 8, 1_000_000


def mart_by_year(spark: SparkSession, sf_dir: str) -> Mart:
    """Orders and lines bucketed alike, and the fact in folders by year."""

    def build() -> Mart:
        tables = stand_ins(spark, sf_dir)
        dims = dimensions(spark, sf_dir)[1]
        namespace = new_namespace(spark, "by_year")
        layout = Layout(("order_id",), max(BUCKETS, -(-tables["order_details"].count() // BUCKET_LINES)))
        written, _ = publish([write_version(tables[name], f"{namespace}.{name}", layout) for name in ("orders", "order_details")])
        tables |= {name.rpartition(".")[2]: df for name, df in written.items()}
        return Mart(namespace, tables, dims, load_fact(tables, dims, namespace, by_year=True, bucketed=True))

    return _once(spark, sf_dir, "mart by year", build)

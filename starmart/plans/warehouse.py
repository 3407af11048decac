"""Building the warehouse: source files to staging, staging to star schema, star schema to reports.

A load writes new versions of its tables, checks them against their contracts and only then points the names at
them, all at the end: a load that fails, or is refused, leaves every table as it was. A whole load commits all its
tables by one pointer (``TableSet``) first; names follow, and are put right by the next load if one dies on the way.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from starmart.plans import contracts, dimensions, reports, staging
from starmart.operators.keys import number_rows, sparse_key
from starmart.plans.fact import ORDER_YEAR, Dimensions, fact_lines, fact_lines_by_bucket, fact_orders, has_hot_orders, with_order_year
from starmart.session import check_warehouse_place, remove_paths, scratch_paths
from starmart.sources.manifest import TableSet
from starmart.sources.tables import Layout, Version, create_namespace, publish, table_place, write_version

# What to do with rows that break a contract.
FAIL, DIVERT = "fail", "divert"


def _together(jobs: dict[str, Callable[[], object]]) -> dict:
    """Run jobs that do not depend on each other, so that one's last tasks overlap the next."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        return dict(zip(jobs, pool.map(lambda job: job(), jobs.values())))


def write_staging(
    spark: SparkSession,
    folder: str,
    namespace: str,
    refused: str = FAIL,
    check_lines: bool = False,
    buckets: int = 0,
    held_to: dict[str, contracts.Contract] = contracts.STAGING,
) -> list[Version]:
    """Clean the six source files and write new versions of the staging tables.

    Rows that break a contract fail the load, or, if ``refused`` is ``divert``, go to a table
    ``<name>_refused`` with what is wrong with them. ``check_lines`` also checks the key of the order lines. With
    ``buckets`` orders and their lines are bucketed by order id, so that they are joined without a shuffle. ``held_to``
    holds the contract of each table.
    """
    layouts = {name: Layout(("order_id",), buckets) for name in ("orders", "order_details") if buckets}

    def write(table: str, df: DataFrame) -> list[Version]:
        contract = held_to[table]
        if refused == DIVERT:
            good, bad = contracts.divide(df, contract)
            layout = layouts.get(table, Layout())
            return [write_version(good, f"{namespace}.{table}", layout), write_version(bad, f"{namespace}.{table}_refused")]
        version = write_version(df, f"{namespace}.{table}", layouts.get(table, Layout()))
        contracts.require(version.rows, contract, version.name, check_lines or None)
        return [version]

    frames = staging.staging_tables(spark, folder)
    written = _together({name: lambda name=name, df=df: write(name, df) for name, df in frames.items()})
    return [version for versions in written.values() for version in versions]


def write_dimensions(spark: SparkSession, tables: dict[str, DataFrame], namespace: str) -> list[Version]:
    """Write new versions of the dimension tables; a repeated or missing key fails the load."""
    builders = {
        "dim_product": lambda: dimensions.dim_product(tables["products"], tables["categories"]),
        "dim_customer": lambda: dimensions.dim_customer(tables["customers"]),
        "dim_employee": lambda: dimensions.dim_employee(tables["employees"]),
        "dim_time": lambda: dimensions.dim_time(tables["orders"]),
        "dim_shipping": lambda: dimensions.dim_shipping(spark),
    }

    def write(name: str) -> Version:
        version = write_version(builders[name](), f"{namespace}.{name}")
        contracts.require(version.rows, contracts.DATAMART[name], version.name)
        return version

    return list(_together({name: lambda name=name: write(name) for name in builders}).values())


def write_fact(
    tables: dict[str, DataFrame],
    dims: Dimensions,
    namespace: str,
    dense_keys: bool = False,
    by_year: bool = False,
    bucketed: bool = False,
    checked: bool = False,
    held_to: dict[str, contracts.Contract] = contracts.STAGING,
) -> Version:
    """Write a new version of the fact table; orders that break their contract, such as by a repeated id, fail the load,
    unless they were ``checked`` before.

    ``by_year`` adds the order's year and puts each year's lines into a folder of its own. ``bucketed`` says that orders
    and lines are bucketed alike by order id; they are then joined in their buckets, unless an order is too large for one.
    """
    if not checked:
        contracts.require(tables["orders"], held_to["orders"], "orders")
    lines, orders = tables["order_details"], tables["orders"]
    if not by_year:
        fact, layout = fact_orders(lines, orders, dims, dense_keys), Layout()
    else:
        if bucketed and not has_hot_orders(lines):
            found = fact_lines_by_bucket(lines, orders, dims)
        else:
            found = with_order_year(fact_lines(lines, orders, dims), dims)
        fact, layout = (number_rows if dense_keys else sparse_key)(found, "fact_id"), Layout(partition_by=(ORDER_YEAR,))
    version = write_version(fact, f"{namespace}.fact_orders", layout)
    contracts.require(version.rows, contracts.DATAMART["fact_orders"], version.name)
    return version


def _dimensions(frames: dict[str, DataFrame]) -> Dimensions:
    return Dimensions(**{name.rpartition(".")[2].removeprefix("dim_"): df for name, df in frames.items()})


def _by_table(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name.rpartition(".")[2]: df for name, df in frames.items()}


def load_staging(
    spark: SparkSession,
    folder: str,
    namespace: str = "staging",
    location: str | None = None,
    refused: str = FAIL,
    check_lines: bool = False,
    buckets: int = 0,
    held_to: dict[str, contracts.Contract] = contracts.STAGING,
) -> dict[str, DataFrame]:
    """Refresh the staging tables from the six source files."""
    create_namespace(spark, namespace, location)
    return _by_table(publish(write_staging(spark, folder, namespace, refused, check_lines, buckets, held_to))[0])


def load_dimensions(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    namespace: str = "datamart",
    location: str | None = None,
) -> Dimensions:
    """Refresh the dimension tables. They are written before the fact looks their keys up."""
    create_namespace(spark, namespace, location)
    return _dimensions(publish(write_dimensions(spark, tables, namespace))[0])


def load_fact(
    tables: dict[str, DataFrame],
    dims: Dimensions,
    namespace: str = "datamart",
    dense_keys: bool = False,
    by_year: bool = False,
    bucketed: bool = False,
    held_to: dict[str, contracts.Contract] = contracts.STAGING,
) -> DataFrame:
    """Refresh the fact table."""
    version = write_fact(tables, dims, namespace, dense_keys, by_year, bucketed, held_to=held_to)
    return publish([version])[0][version.name]


REPORTS: dict[str, Callable[[DataFrame, Dimensions], DataFrame]] = {
    "revenue_by_category_quarter": lambda fact, dims: reports.revenue_by_category_quarter(
        fact, dims.product, dims.time
    ),
    "top_customers": lambda fact, dims: reports.top_customers(fact, dims.customer),
    "employee_performance": lambda fact, dims: reports.employee_performance(fact, dims.employee),
    "shipping_analysis": lambda fact, dims: reports.shipping_analysis(fact, dims.shipping),
    "weekend_patterns": lambda fact, dims: reports.weekend_patterns(fact, dims.customer, dims.time),
}


def table_set(spark: SparkSession, location: str | None = None) -> TableSet:
    """The pointer to the tables of a warehouse at this location, or in the session's own warehouse folder."""
    check_warehouse_place(spark, location)
    return TableSet(spark, location or spark.conf.get("spark.sql.warehouse.dir"))


def recover_names(spark: SparkSession, location: str | None = None) -> list[str]:
    """Point the names at the tables that were committed last; returns those that did not point there.

    For a load that died after its commit, and for a session with a catalog of its own that knows no names yet.
    """
    tables = table_set(spark, location)
    state = tables.state()
    lost = []
    for name, places in tables.places(state).items():
        namespace = name.partition(".")[0]
        create_namespace(spark, namespace, location and f"{location.rstrip('/')}/{namespace}")
        if [tables.qualified(p) for p in table_place(spark, name)] != places:
            layout = Layout(partition_by=(ORDER_YEAR,)) if ORDER_YEAR in state.tables[name].columns().names else Layout()
            lost.append(Version(name, places[0], tables.read(name, state), layout))
    if lost:
        publish(lost)
    return [version.name for version in lost]


def open_warehouse(spark: SparkSession, location: str | None = None) -> dict[str, DataFrame]:
    """All tables of the warehouse as one load left them, whatever is being loaded meanwhile."""
    tables = table_set(spark, location)
    state = tables.state()
    return {name: tables.read(name, state) for name in state.tables}


def reports_of(tables: dict[str, DataFrame], namespace: str = "datamart") -> dict[str, DataFrame]:
    """The reports over the tables of ``open_warehouse``."""
    dims = _dimensions({name: df for name, df in tables.items() if name.startswith(f"{namespace}.dim_")})
    return {name: report(tables[f"{namespace}.fact_orders"], dims) for name, report in REPORTS.items()}


def build_warehouse(
    spark: SparkSession,
    folder: str,
    location: str | None = None,
    *,
    refused: str = FAIL,
    check_lines: bool = False,
    dense_keys: bool = False,
    remove_old: bool = False,
    by_year: bool = False,
    buckets: int = 0,
) -> dict[str, DataFrame]:
    """Everything from the source files to the report frames.

    All tables are committed by one pointer at the very end, which ``open_warehouse`` reads; the names ``staging.*`` and
    ``datamart.*``, for ``spark.sql``, follow it one by one. ``remove_old`` then deletes the versions that were replaced
    and the scratch copies that this load made; only for warehouses that nobody reads at that moment. ``by_year`` puts the
    fact's years into folders of their own, ``buckets`` deals orders and their lines over so many buckets.
    """
    pointer = table_set(spark, location)
    recover_names(spark, location)
    base = location.rstrip("/") if location else None
    before = len(scratch_paths(spark))
    create_namespace(spark, "staging", base and f"{base}/staging")
    create_namespace(spark, "datamart", base and f"{base}/datamart")
    staged = write_staging(spark, folder, "staging", refused, check_lines, buckets)
    tables = _by_table({v.name: v.rows for v in staged})
    dims = write_dimensions(spark, tables, "datamart")
    known = _dimensions({v.name: v.rows for v in dims})
    fact = write_fact(tables, known, "datamart", dense_keys, by_year, buckets > 0, checked=True)
    versions = [*staged, *dims, fact]
    pointer.point({v.name: (v.rows, v.path) for v in versions})
    published, old = publish(versions)
    if remove_old:
        pointer.remove_old()
        remove_paths(spark, [*old, *scratch_paths(spark)[before:]])
    built = _dimensions({v.name: published[v.name] for v in dims})
    return {name: report(published[fact.name], built) for name, report in REPORTS.items()}

"""The order-line fact and the audit of lines that do not reach it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.numbers import freight_share, line_amount
from starmart.operators.filters import first_match
from starmart.operators.joins import (
    SLICE,
    SLICE_ROWS,
    cut,
    deal,
    hot_keys,
    join_cut,
    key_counts,
    lookup,
    repeat,
    with_row_id,
)
from starmart.operators.keys import number_rows, sparse_key

# The names of the fact's columns.
FACT_COLUMNS = [
    "product_key",
    "customer_key",
    "employee_key",
    "order_time_key",
    "shipping_key",
    "order_id",
    "unit_price",
    "quantity",
    "discount",
    "total_amount",
    "freight_allocation",
]
HEADER_COLUMNS = ["order_id", "customer_id", "order_date", "ship_via"]
ORDER_YEAR = "order_year"
LINE_COLUMNS = ["order_id", "product_id", "unit_price", "quantity", "discount"]


@dataclass(frozen=True)
class Dimensions:
    product: DataFrame
    customer: DataFrame
    employee: DataFrame
    time: DataFrame
    shipping: DataFrame


def line_counts(order_details: DataFrame) -> DataFrame:
    """Lines per order, counted before any join can drop a line."""
    return order_details.groupBy("order_id").agg(F.count("*").alias("line_count"))


def _with_date_and_shipper(orders: DataFrame, dims: Dimensions, how: str) -> DataFrame:
    # Only the list of shippers is known to be small; the calendar has a row for each day with an order.
    time = dims.time.select(F.col("date").alias("order_date"), F.col("time_key").alias("order_time_key"))
    shipping = dims.shipping.select(F.col("ship_via_id").alias("ship_via"), "shipping_key")
    dated = lookup(orders, time, "order_date", how)
    return dated.join(F.broadcast(shipping), "ship_via", how)


def _with_employee(df: DataFrame, dims: Dimensions, how: str) -> DataFrame:
    if "employee_id" not in df.columns:
        return df
    return lookup(df, dims.employee.select("employee_id", "employee_key"), "employee_id", how)


def _keyed_headers(orders: DataFrame, dims: Dimensions, how: str) -> DataFrame:
    """Orders with the surrogate keys of what hangs on the order, looked up once per order."""
    customers = dims.customer.select("customer_id", "customer_key")
    headers = lookup(_with_date_and_shipper(orders, dims, how), customers, "customer_id", how)
    headers = _with_employee(headers, dims, how)
    return headers.drop("order_date", "ship_via", "customer_id", "employee_id")


def _keyed_lines(lines: DataFrame, dims: Dimensions, how: str) -> DataFrame:
    """Lines with the surrogate keys of what hangs on the line."""
    products = dims.product.select("product_id", "product_key")
    return _with_employee(lookup(lines, products, "product_id", how), dims, how)


def _employee_column(df: DataFrame) -> list[str]:
    """The sales employee may be named by the order or by the line."""
    return [c for c in df.columns if c == "employee_id"]


def fact_lines(
    order_details: DataFrame,
    orders: DataFrame,
    dims: Dimensions,
    extra: tuple[str, ...] = (),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The fact without its key: one row per order line whose order, product, customer, employee,
    date and shipper are all known. The dimension lookups prove that the parents exist.

    What hangs on the order is worked out once per order, before the join with the lines: four lookups
    and the lines' share of the freight. An order may hold any number of lines, so that join is
    sliced; the counts it needs are the ones the freight split needs. Headers meet their counts slice
    by slice already, so they are shuffled once for both joins. The join with the order comes last, so
    that the lines of an order lie together in the fact and reports can reduce them where they lie.
    """
    key, rows = ["order_id"], order_details.count()
    headers = orders.select(*HEADER_COLUMNS, "freight", *_employee_column(orders))
    lines = with_row_id(order_details.select(*LINE_COLUMNS, *extra, *_employee_column(order_details)))
    counts = key_counts(lines, key)
    hot = hot_keys(counts, key, slice_rows)
    share = freight_share(F.col("freight"), F.col("_rows"))
    headers = (
        deal(repeat(_keyed_headers(headers, dims, "inner"), hot, key), [*key, SLICE], rows)
        .join(deal(repeat(counts, hot, key), [*key, SLICE], rows), [*key, SLICE])
        .withColumn("freight_allocation", share)
        .drop("freight", "_rows")
    )
    amount = line_amount(F.col("unit_price"), F.col("quantity"), F.col("discount"))
    # Cut first: a slice number, mostly 0, takes less room in the shuffles of the lookups than the row id.
    keyed = _keyed_lines(cut(lines, hot, key), dims, "inner").drop("product_id", "employee_id")
    joined = join_cut(deal(keyed, [*key, SLICE], rows), headers, key)
    return joined.withColumn("total_amount", amount).select(*FACT_COLUMNS, *extra)


def line_orders(order_details: DataFrame, orders: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Order lines with their order's columns and ``line_count``, the lines that the order has.

    For tables that are bucketed alike by order id: the count and both joins then go bucket by bucket, without a
    shuffle.
    """
    lines = order_details.select(*LINE_COLUMNS, *extra, *_employee_column(order_details))
    headers = orders.select(*HEADER_COLUMNS, "freight", *_employee_column(orders))
    counted = headers.hint("merge").join(line_counts(lines), "order_id")
    return lines.hint("merge").join(counted, "order_id")


def fact_lines_by_bucket(order_details: DataFrame, orders: DataFrame, dims: Dimensions, extra: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``fact_lines`` and each order's year, from tables that are bucketed alike by order id.

    The join of lines with orders comes first, as long as both still lie in their buckets; keys are looked up per line.
    """
    lines = line_orders(order_details, orders, extra)
    lines = lines.withColumns(
        {
            "freight_allocation": freight_share(F.col("freight"), F.col("line_count")),
            "total_amount": line_amount(F.col("unit_price"), F.col("quantity"), F.col("discount")),
            ORDER_YEAR: F.year("order_date"),
        }
    )
    # _keyed_headers looks the employee up, by whichever of the two tables names them.
    products = dims.product.select("product_id", "product_key")
    keyed = _keyed_headers(lookup(lines, products, "product_id"), dims, "inner")
    return keyed.select(*FACT_COLUMNS, ORDER_YEAR, *extra)


def has_hot_orders(order_details: DataFrame, slice_rows: int = SLICE_ROWS) -> bool:
    """Whether an order holds so many lines that they have to be spread over tasks, which buckets can't."""
    return not hot_keys(key_counts(order_details, ["order_id"]), ["order_id"], slice_rows).isEmpty()


def with_order_year(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """The fact with the year of each line's order."""
    years = dims.time.select(F.col("time_key").alias("order_time_key"), F.col("year").alias(ORDER_YEAR))
    return lookup(fact, years, "order_time_key").select(*fact.columns, ORDER_YEAR)


def fact_orders(
    order_details: DataFrame, orders: DataFrame, dims: Dimensions, dense_keys: bool = False
) -> DataFrame:
    """The fact with its key, which is unique. ``dense_keys`` has it run from 1 without a hole, which takes writing
    the fact once more."""
    lines = fact_lines(order_details, orders, dims)
    return number_rows(lines, "fact_id") if dense_keys else sparse_key(lines, "fact_id")


def line_fates(
    order_details: DataFrame, orders: DataFrame, dims: Dimensions, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Every order line with the first reason why the fact would not hold it (NULL if it would)."""
    headers = orders.select(*HEADER_COLUMNS, *_employee_column(orders))
    headers = _keyed_headers(headers, dims, "left").withColumn("_has_order", F.lit(True))
    keyed = _keyed_lines(with_row_id(order_details), dims, "left")
    key = ["order_id"]
    hot = hot_keys(key_counts(order_details, key), key, slice_rows)
    keyed = join_cut(cut(keyed, hot, key), repeat(headers, hot, key), key, "left")
    missing = {
        "no order": "_has_order",
        "no product": "product_key",
        "no customer": "customer_key",
        "no employee": "employee_key",
        "no order date": "order_time_key",
        "no shipper": "shipping_key",
    }
    rules = [(F.col(column).isNull(), F.lit(reason)) for reason, column in missing.items()]
    return keyed.select(*order_details.columns, first_match(rules, F.lit(None)).alias("reason"))


def dropped_lines(order_details: DataFrame, orders: DataFrame, dims: Dimensions) -> DataFrame:
    """Number of lines per reason, with the kept ones under ``kept``."""
    ids = order_details.select("order_id", "product_id", *_employee_column(order_details))
    fates = line_fates(ids, orders, dims)
    return fates.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(
        F.count("*").alias("lines")
    )

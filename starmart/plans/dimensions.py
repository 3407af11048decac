"""The five dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.dates import day_name, is_weekend
from starmart.functions.text import joined_name
from starmart.operators.joins import lookup
from starmart.operators.keys import dense_key
from starmart.sources.tables import inline_table

# The shippers, and the names of the dimensions' columns below.
SHIPPERS = [(1, "Speedy Express"), (2, "United Package"), (3, "Federal Shipping")]


def dim_product(products: DataFrame, categories: DataFrame) -> DataFrame:
    named = lookup(products, categories.select("category_id", "category_name"), "category_id", "left")
    columns = ["product_id", "product_name", "category_name", "unit_price", "discontinued"]
    return dense_key(named.select(*columns), ["product_id"], "product_key")


def dim_customer(customers: DataFrame) -> DataFrame:
    columns = ["customer_id", "company_name", "city", "region", "country"]
    return dense_key(customers.select(*columns), ["customer_id"], "customer_key")


def dim_employee(employees: DataFrame) -> DataFrame:
    """Employees with their own and their manager's full name (NULL without a manager)."""
    full_name = joined_name(F.col("first_name"), F.col("last_name"))
    managers = employees.select(
        F.col("employee_id").alias("reports_to"), full_name.alias("reports_to_name")
    )
    staff = employees.select("employee_id", full_name.alias("full_name"), "title", "reports_to")
    named = lookup(staff, managers, "reports_to", "left")
    columns = ["employee_id", "full_name", "title", "reports_to_name"]
    return dense_key(named.select(*columns), ["employee_id"], "employee_key")


def dim_time(orders: DataFrame) -> DataFrame:
    """One row per order date, keyed in date order.

    The dates are made distinct before anything is derived from them.
    """
    dates = orders.select(F.col("order_date").alias("date")).dropna().distinct()
    date = F.col("date")
    return dense_key(dates, ["date"], "time_key").select(
        "time_key",
        "date",
        day_name(date).alias("day_name"),
        F.month(date).alias("month"),
        F.quarter(date).alias("quarter"),
        F.year(date).alias("year"),
        is_weekend(date).alias("is_weekend"),
    )


def dim_shipping(spark: SparkSession) -> DataFrame:
    shippers = inline_table(spark, SHIPPERS, "ship_via_id int, shipper_name string")
    return dense_key(shippers, ["ship_via_id"], "shipping_key")

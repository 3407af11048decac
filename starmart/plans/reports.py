"""The five reports over the star schema.

Reports that count orders first reduce the fact to one row per order and grouping key. The distinct
count is then a plain count, and no group gathers its lines in one task. By employee and by shipper, amounts
do not go through that shuffle: they are summed by key in each task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.numbers import percent, ratio
from starmart.operators.joins import lookup
from starmart.operators.ranking import rank_descending, share_of, top

# Label of an employee without a manager, length of the customer list.
TOP_MANAGER = "(Top Manager)"
TOP_CUSTOMERS = 10


def _calendar(dim_time: DataFrame, *columns: str) -> DataFrame:
    """The calendar; Spark broadcasts the written table when its size allows."""
    return dim_time.select(F.col("time_key").alias("order_time_key"), *columns)


def _totals(fact: DataFrame, key: str, **measures: str) -> DataFrame:
    """Orders per key as ``order_count``, and sums by the name of the total.

    Two readings of a few columns each, because rows per order and key are about as many as lines where the key hangs on
    the line, and amounts are most of what they hold.
    """
    pairs = fact.select(F.col(key).alias("_key"), "order_id").distinct()
    orders = pairs.groupBy("_key").agg(F.count("*").alias("order_count"))
    sums = fact.groupBy(key).agg(*[F.sum(m).cast(_total_type(fact, m)).alias(total) for total, m in measures.items()])
    return sums.join(orders, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def _total_type(fact: DataFrame, measure: str) -> T.DataType:
    """Room for a sum of sums, which the divisions of the reports round from."""
    kind = fact.schema[measure].dataType
    if not isinstance(kind, T.DecimalType):
        return T.DoubleType() if isinstance(kind, T.FractionalType) else T.LongType()
    return T.DecimalType(min(38, kind.precision + 20), kind.scale)


def revenue_by_category_quarter(
    fact: DataFrame, dim_product: DataFrame, dim_time: DataFrame
) -> DataFrame:
    """Revenue per category and quarter, and its percentage of the quarter."""
    sales = fact.join(_calendar(dim_time, "year", "quarter"), "order_time_key")
    named = lookup(sales, dim_product.select("product_key", "category_name"), "product_key")
    revenue = named.groupBy("category_name", "year", "quarter").agg(
        F.sum("total_amount").alias("total_revenue")
    )
    shares = share_of(revenue, "total_revenue", ["year", "quarter"], "pct_of_quarter", 1)
    return shares.orderBy("year", "quarter", F.desc_nulls_first("total_revenue"), "category_name")


def top_customers(fact: DataFrame, dim_customer: DataFrame, k: int = TOP_CUSTOMERS) -> DataFrame:
    """The customers with the highest revenue; the customer key breaks ties."""
    per_customer = (
        fact.groupBy("customer_key", "order_id")
        .agg(F.sum("total_amount").alias("total_amount"))
        .groupBy("customer_key")
        .agg(F.count("*").alias("order_count"), F.sum("total_amount").alias("total_revenue"))
    )
    # The first k before their names are looked up, so that only k customers are: the fact holds no customer
    # that the dimension lacks, because the fact load looks every one up there.
    order = [F.desc_nulls_first("total_revenue"), F.col("customer_key")]
    first = top(per_customer, order, k)
    names = dim_customer.select("customer_key", "company_name", "country")
    ranked = names.join(F.broadcast(first), "customer_key").orderBy(*order)
    return ranked.select(
        "company_name",
        "country",
        "order_count",
        "total_revenue",
        ratio(F.col("total_revenue"), F.col("order_count"), 2).alias("avg_order_value"),
    )


def employee_performance(fact: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Revenue, orders and revenue rank per employee, with the manager's name."""
    per_employee = _totals(fact, "employee_key", total_revenue="total_amount")
    named = lookup(per_employee, dim_employee, "employee_key").select(
        "employee_key",
        F.col("full_name").alias("employee_name"),
        "title",
        F.coalesce("reports_to_name", F.lit(TOP_MANAGER)).alias("manager_name"),
        "order_count",
        "total_revenue",
    )
    ranked = rank_descending(named, "total_revenue", "employee_key", "revenue_rank")
    return ranked.orderBy("revenue_rank", "employee_key").drop("employee_key")


def shipping_analysis(fact: DataFrame, dim_shipping: DataFrame) -> DataFrame:
    """Orders, revenue and freight per shipper."""
    per_shipper = _totals(fact, "shipping_key", total_revenue="total_amount", total_freight="freight_allocation")
    revenue, freight = F.col("total_revenue"), F.col("total_freight")
    named = per_shipper.join(F.broadcast(dim_shipping), "shipping_key")
    return named.select(
        "shipper_name",
        "order_count",
        "total_revenue",
        "total_freight",
        percent(freight, revenue, 2).alias("freight_pct_of_revenue"),
        ratio(freight, F.col("order_count"), 2).alias("avg_freight_per_order"),
    ).orderBy(F.desc_nulls_first("total_revenue"), "shipper_name")


def weekend_patterns(fact: DataFrame, dim_customer: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Weekend and weekday revenue and orders per customer country.

    An order has one customer and one date, so rows per order, customer and date count orders.
    """
    per_order = fact.groupBy("customer_key", "order_time_key", "order_id").agg(
        F.sum("total_amount").alias("amount")
    )
    dated = per_order.join(_calendar(dim_time, "is_weekend"), "order_time_key")
    placed = lookup(dated, dim_customer.select("customer_key", "country"), "customer_key")
    weekend, weekday = F.col("is_weekend"), ~F.col("is_weekend")
    totals = placed.groupBy("country").agg(
        F.sum(F.when(weekend, F.col("amount")).otherwise(0)).alias("weekend_revenue"),
        F.sum(F.when(weekday, F.col("amount")).otherwise(0)).alias("weekday_revenue"),
        F.count_if(weekend).alias("weekend_orders"),
        F.count_if(weekday).alias("weekday_orders"),
        F.count("*").alias("_orders"),
    )
    share = percent(F.col("weekend_orders").cast("decimal(20,0)"), F.col("_orders"), 1)
    return (
        totals.withColumn("weekend_order_pct", share)
        .drop("_orders")
        .orderBy(
            F.desc_nulls_first("weekend_order_pct"), F.desc_nulls_first("weekday_revenue"), "country"
        )
    )

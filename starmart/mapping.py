"""The driver's tables in the shape of the warehouse's staging tables and source files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.dates import ORDER_DATE_PATTERN
from starmart.functions.numbers import AMOUNT, DISCOUNT, PRICE
from starmart.operators.keys import dense_key
from starmart.sources.delimited import write_delimited
from starmart.sources.raw_schemas import FILES

# Freight as a share of an order's price.
FREIGHT_SHARE = "0.05"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_date() -> Column:
    return F.col("o_orderdate").cast("date")


def _unit_price() -> Column:
    return F.round(F.col("l_extendedprice").cast(AMOUNT) / F.col("l_quantity").cast("int"), 2).cast(PRICE)


def _freight() -> Column:
    return F.round(F.col("o_totalprice").cast(AMOUNT) * F.lit(FREIGHT_SHARE).cast("decimal(3,2)"), 2).cast(PRICE)


def _ship_via() -> Column:
    return (F.col("o_orderkey") % 3 + 1).cast("int")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    types = part.select(F.col("p_type").alias("category_name")).distinct()
    return dense_key(types, ["category_name"], "category_id")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = categories(spark, sf_dir).withColumnRenamed("category_name", "p_type")
    return (
        table(spark, sf_dir, "part")
        .join(kinds, "p_type", "left")
        .select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            "category_id",
            F.col("p_retailprice").cast(PRICE).alias("unit_price"),
            (F.col("p_size") > 40).alias("discontinued"),
        )
    )


def _customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Nations and regions are lists of fixed length.
    nation = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = table(spark, sf_dir, "customer")
    return customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))


def dirty_region() -> Column:
    """Region text with two spellings of a null token."""
    return (
        F.when(F.col("c_mktsegment") == "BUILDING", "NULL")
        .when(F.col("c_mktsegment") == "MACHINERY", " null ")
        .otherwise(F.col("r_name"))
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_places(spark, sf_dir).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("city"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("country"),
    )


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_places(spark, sf_dir).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("company_name"),
        dirty_region().alias("region"),
        F.col("n_name").alias("country"),
    )


def _manager() -> Column:
    return F.when(F.col("s_suppkey") == 0, None).otherwise(F.expr("(s_suppkey - 1) DIV 9"))


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("employee_id"),
        F.split_part("s_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("s_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.when(F.col("s_suppkey") == 0, "Head of Sales").otherwise("Sales Representative").alias("title"),
        _manager().alias("reports_to"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _order_date().alias("order_date"),
        _ship_via().alias("ship_via"),
        _freight().alias("freight"),
    )


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the order date as text; open orders have a null token instead."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "O", "NULL")
        .otherwise(F.date_format(_order_date(), ORDER_DATE_PATTERN))
        .alias("order_date"),
        _ship_via().alias("ship_via"),
        _freight().alias("freight"),
    )


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; the sales employee is known per line."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("employee_id"),
        F.col("l_linenumber").alias("line_number"),
        _unit_price().alias("unit_price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_discount").cast(DISCOUNT).alias("discount"),
    )


def dirty_discount() -> Column:
    """Discounts, missing on one line number and negative on another."""
    discount = F.col("l_discount").cast(DISCOUNT)
    number = F.col("l_linenumber")
    return F.when(number == 7, -discount).when(number == 6, None).otherwise(discount)


def dirty_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").cast("int").alias("quantity"),
        dirty_discount().alias("discount"),
    )


def copied_products(spark: SparkSession, sf_dir: str, same_key: bool = False) -> DataFrame:
    """Products and, of one brand, copies under ids above all others (or under the same id)."""
    part = table(spark, sf_dir, "part").withColumn("copy", F.lit(0))
    last = part.agg(F.max("p_partkey") + 1).scalar()
    copies = part.filter(F.col("p_brand") == "Brand#2").withColumn("copy", F.lit(1))
    if not same_key:
        copies = copies.withColumn("p_partkey", F.col("p_partkey") + last)
    return part.unionByName(copies).select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category_name"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").cast(PRICE).alias("unit_price"),
        "copy",
    )


def last_product_id(spark: SparkSession, sf_dir: str) -> Column:
    """The highest id that is not a copy's, as a scalar subquery."""
    return table(spark, sf_dir, "part").agg(F.max("p_partkey")).scalar()


# Source files


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories(spark, sf_dir).select(
        F.col("category_id").alias("CategoryID"),
        F.col("category_name").alias("CategoryName"),
        F.concat(F.lit("Parts; type "), F.col("category_name")).alias("Description"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = categories(spark, sf_dir)
    copied = copied_products(spark, sf_dir).join(kinds, "category_name", "left")
    size = F.col("size")
    return copied.select(
        F.col("product_id").alias("ProductID"),
        F.col("product_name").alias("ProductName"),
        F.length("brand").alias("SupplierID"),
        F.col("category_id").alias("CategoryID"),
        F.concat(size.cast("string"), F.lit(' per "box"')).alias("QuantityPerUnit"),
        F.col("unit_price").alias("UnitPrice"),
        size.alias("UnitsInStock"),
        F.lit(None).cast("int").alias("UnitsOnOrder"),
        F.lit(10).alias("ReorderLevel"),
        F.when(size > 40, 1).otherwise(0).alias("Discontinued"),
    ).sort("ProductID")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("c_custkey").cast("string")
    return _customer_places(spark, sf_dir).select(
        text.alias("CustomerID"),
        F.col("c_name").alias("CompanyName"),
        F.concat(F.lit('"Contact" '), text).alias("ContactName"),
        F.col("c_mktsegment").alias("ContactTitle"),
        F.concat(F.lit("Street; "), text).alias("Address"),
        F.concat(F.lit("São "), F.col("n_name")).alias("City"),
        dirty_region().alias("Region"),
        F.lit(None).cast("string").alias("PostalCode"),
        F.col("n_name").alias("Country"),
        F.concat(F.lit("  "), text, F.lit("  ")).alias("Phone"),
        F.when(F.col("c_acctbal") < 0, "NULL").otherwise(text).alias("Fax"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers; the employee of an order is the lowest one of its lines."""
    sellers = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_suppkey").alias("seller"))
    )
    urgent, low = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "5-LOW"
    is_open, day = F.col("o_orderstatus") == "O", _order_date()

    def text(d: Column) -> Column:
        return F.date_format(d, ORDER_DATE_PATTERN)

    return (
        table(spark, sf_dir, "orders")
        .join(sellers, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").alias("OrderID"),
            F.col("o_custkey").cast("string").alias("CustomerID"),
            F.col("seller").alias("EmployeeID"),
            F.when(is_open & low, "NULL").otherwise(text(day)).alias("OrderDate"),
            text(F.date_add(day, 14)).alias("RequiredDate"),
            F.when(is_open, "NULL").otherwise(text(F.date_add(day, 7))).alias("ShippedDate"),
            _ship_via().alias("ShipVia"),
            _freight().alias("Freight"),
            F.concat(F.lit("Ship "), F.col("o_custkey").cast("string")).alias("ShipName"),
            F.lit("Kai; 1").alias("ShipAddress"),
            F.lit("Münster").alias("ShipCity"),
            F.when(urgent, "NULL").otherwise("Süd").alias("ShipRegion"),
            F.lit(None).cast("string").alias("ShipPostalCode"),
            F.lit("Nullarbor").alias("ShipCountry"),
        )
    )


def raw_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_partkey").alias("ProductID"),
        _unit_price().alias("UnitPrice"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        dirty_discount().alias("Discount"),
    )


def raw_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    text = key.cast("string")
    birth = F.date_add(F.lit("1950-01-01").cast("date"), (key % 10000).cast("int"))
    head = key == 0

    def day(d: Column) -> Column:
        return F.date_format(d, "dd-MM-yyyy")

    return table(spark, sf_dir, "supplier").select(
        key.alias("EmployeeID"),
        F.split_part("s_name", F.lit("#"), F.lit(2)).alias("LastName"),
        F.split_part("s_name", F.lit("#"), F.lit(1)).alias("FirstName"),
        F.when(head, "Head of Sales").otherwise("Sales Representative").alias("Title"),
        F.lit("Dr.").alias("TitleOfCourtesy"),
        day(birth).alias("BirthDate"),
        F.when(head, "NULL").otherwise(day(F.date_add(birth, 9000))).alias("HireDate"),
        F.lit("Gässli 5").alias("Address"),
        F.lit("Zürich").alias("City"),
        F.lit("NULL").alias("Region"),
        F.lit("8000").alias("PostalCode"),
        F.lit("CH").alias("Country"),
        F.lit("044").alias("HomePhone"),
        text.alias("Extension"),
        F.lit("0x00").alias("Photo"),
        F.concat(F.lit("first line\nsecond; line "), text).alias("Notes"),
        F.coalesce(_manager().cast("string"), F.lit("NULL")).alias("ReportsTo"),
        F.concat(F.lit("photos/"), text).alias("PhotoPath"),
    )


RAW = {
    "Categories": raw_categories,
    "Customers": raw_customers,
    "Products": raw_products,
    "Orders": raw_orders,
    "OrderDetails": raw_order_details,
    "Employees": raw_employees,
}


def write_source_file(spark: SparkSession, sf_dir: str, folder: str, file: str) -> None:
    write_delimited(RAW[file](spark, sf_dir).select(*FILES[file]), f"{folder}/{file}.csv")

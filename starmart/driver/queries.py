"""One query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import mapping
from starmart.driver.marts import dimensions, mart, mart_by_year, mart_from_files, new_namespace, source_file
from starmart.functions.dates import ORDER_DATE_PATTERN, day_number, parse_date
from starmart.functions.numbers import freight_share, line_amount, repaired_discount
from starmart.functions.text import blank_token, normalise, null_token
from starmart.operators import bitmaps, checks, columns
from starmart.operators.duplicates import dedupe_first, flag_duplicates
from starmart.operators.filters import first_match, keep_present, keep_where
from starmart.operators.joins import deal, existing, join_sliced
from starmart.operators.keys import dense_key
from starmart.operators.ranking import rank_descending
from starmart.plans import contracts, reports, staging
from starmart.plans.admission import admit_batch, refused_name
from starmart.plans.fact import FACT_COLUMNS, ORDER_YEAR, Dimensions, dropped_lines, fact_lines, line_counts
from starmart.plans.fact import fact_orders as fact_orders_with_key
from starmart.session import scratch_path
from starmart.sources import raw_schemas, tables
from starmart.sources.delimited import CORRUPT, infer_schema, scan_delimited, scan_merged, write_delimited
from starmart.sources.records import scan_records
from starmart.sources.manifest import TableSet

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form in which both engines print them alike."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name
            for f in df.schema.fields
        ]
    )


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(build(spark, sf_dir))

    REGISTRY[build.__name__] = run
    return build


# Scans and sinks


@query
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = source_file(spark, sf_dir, "Customers")
    raw = staging.read_raw(spark, folder, "Customers")
    return columns.rename(raw, {n: raw_schemas.snake_case(n) for n in raw_schemas.CUSTOMERS})


@query
def corrupt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose quantity is no number, read by a scan that keeps and marks them."""
    schema = raw_schemas.struct_of(raw_schemas.ORDER_DETAILS)
    raw = mapping.raw_order_details(spark, sf_dir).withColumn(
        "Quantity", F.when(F.col("Quantity") > 40, "many").otherwise(F.col("Quantity").cast("string"))
    )
    path = scratch_path(spark, "bad-lines")
    write_delimited(raw.select(*schema.names), path)
    read = scan_delimited(spark, path, schema, strict=False)
    return read.select(
        F.col("OrderID").alias("order_id"),
        F.col("ProductID").alias("product_id"),
        F.col("Quantity").alias("quantity"),
        F.col(CORRUPT).isNotNull().alias("corrupt"),
    )


@query
def row_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product file (sorted by id) without its first hundred rows."""
    folder = source_file(spark, sf_dir, "Products")
    schema = raw_schemas.struct_of(raw_schemas.PRODUCTS)
    read = scan_delimited(spark, f"{folder}/Products.csv", schema, skip_rows=100)
    return read.select(F.col("ProductID").alias("product_id"), F.col("UnitPrice").alias("unit_price"))


@query
def row_range_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty rows of the product file after its first hundred."""
    folder = source_file(spark, sf_dir, "Products")
    schema = raw_schemas.struct_of(raw_schemas.PRODUCTS)
    read = scan_delimited(spark, f"{folder}/Products.csv", schema, skip_rows=100, max_rows=50)
    return read.select(F.col("ProductID").alias("product_id"), F.col("UnitPrice").alias("unit_price"))


@query
def decimal_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines some of whose prices are written with a decimal comma, read by a scan that keeps and marks them."""
    schema = raw_schemas.struct_of(raw_schemas.ORDER_DETAILS)
    price = F.col("UnitPrice").cast("string")
    raw = mapping.raw_order_details(spark, sf_dir).withColumn(
        "UnitPrice", F.when(F.col("Quantity") > 40, F.translate(price, ".", ",")).otherwise(price)
    )
    path = scratch_path(spark, "comma-lines")
    write_delimited(raw.select(*schema.names), path)
    read = scan_delimited(spark, path, schema, strict=False)
    return read.select(
        F.col("OrderID").alias("order_id"),
        F.col("ProductID").alias("product_id"),
        F.col("UnitPrice").alias("unit_price"),
        F.col(CORRUPT).isNotNull().alias("corrupt"),
    )


@query
def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types guessed for the lines' file, whose last row has a text for its quantity."""
    raw = mapping.raw_order_details(spark, sf_dir).select(*raw_schemas.ORDER_DETAILS)
    last = raw.agg(F.max("OrderID")).scalar()
    texts = raw.withColumn("Quantity", F.when(F.col("OrderID") == last, "many").otherwise(F.col("Quantity").cast("string")))
    path = scratch_path(spark, "inferred")
    write_delimited(texts.sort("OrderID"), path)
    found = infer_schema(spark, path)
    return tables.inline_table(
        spark, [(f.name, f.dataType.simpleString()) for f in found.fields], "column_name string, type string"
    )


@query
def table_sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mapping.customers(spark, sf_dir)
    name = f"{new_namespace(spark, 'sink')}.customers"
    tables.create_table(spark, name, rows.schema)
    tables.append_table(rows, name)
    tables.append_table(columns.include(rows, ["customer_id", "company_name"]), name)
    return tables.scan_table(spark, name)


@query
def table_sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table refreshed from itself."""
    name = f"{new_namespace(spark, 'sink')}.customers"
    first = tables.replace_table(mapping.customers(spark, sf_dir), name)
    tables.replace_table(first.drop("city"), name)
    return tables.scan_table(spark, name)


@query
def insert_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mapping.order_details(spark, sf_dir).select(
        "order_id", "product_id", "line_number", "quantity", "discount"
    )
    name = f"{new_namespace(spark, 'sink')}.order_details"
    tables.create_table(spark, name, rows.schema, {"discount": "0"})
    tables.append_table(rows, name, ["order_id", "product_id", "line_number", "quantity"])
    return tables.scan_table(spark, name)


@query
def write_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mapping.copied_products(spark, sf_dir, same_key=True)
    rules = {
        "name too long": checks.at_most("product_name", 10),
        "price out of range": checks.fits("unit_price", "decimal(5,2)"),
        "no brand": F.col("brand").isNotNull(),
    }
    status = checks.write_status(rows, rules, unique=["product_id"], order="copy")
    return status.select("product_id", "copy", "write_status", "write_error")


@query
def write_status_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of products that occur twice, equal in every column, one row is written."""
    rows = mapping.copied_products(spark, sf_dir, same_key=True).drop("copy")
    status = checks.write_status(rows, {}, unique=["product_id"], order="product_id")
    return status.select("product_id", "write_status", "write_error")


@query
def refused_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load puts aside of products with repeated ids and missing names."""
    rows = mapping.copied_products(spark, sf_dir, same_key=True)
    rows = rows.withColumn("product_name", F.when(F.col("size") != 7, F.col("product_name")))
    _, refused = contracts.divide(rows, contracts.STAGING["products"], order="copy")
    return refused.select("product_id", "copy", "write_error")


#: What the admitted products must meet.
PRODUCT_RULES = contracts.Contract(
    ["product_id"], ["product_name"], lengths={"product_name": 9}, types={"unit_price": "decimal(5,2)"}
)


@query
def admitted_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of products, the second sent twice: the rows that the table holds, and the refused ones.

    The second batch has keys of the first, keys that repeat, names that are missing or too long, and prices that
    don't fit.
    """
    rows = mapping.copied_products(spark, sf_dir, same_key=True).select(
        "product_id",
        F.when(F.col("size") != 7, F.col("product_name")).alias("product_name"),
        (F.col("unit_price") * F.when(F.col("size") == 5, 2).otherwise(1)).cast("decimal(10,2)").alias("unit_price"),
        "copy",
    )
    tables_here = TableSet(spark, scratch_path(spark, "admission"))
    admit_batch(tables_here, "products", rows.filter("product_id % 3 = 0 AND copy = 0"), "first", PRODUCT_RULES, "copy")
    for again in (False, True):
        outcome = admit_batch(tables_here, "products", rows, "second", PRODUCT_RULES, "copy")
        if outcome.again != again:
            raise RuntimeError(f"the batch was admitted as {outcome}")
    state = tables_here.state()
    text = F.lit(None).cast("string")
    held = tables_here.read("products", state).withColumns({"batch": text, "write_error": text})
    refused = tables_here.read(refused_name("products"), state)
    return held.unionByName(refused).withColumn("held", F.col("batch").isNull())


@query
def published_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customers of a table set that is refreshed twice, with a load between that dies before its commit."""
    whole = {
        "orders": mapping.orders(spark, sf_dir).select(F.col("order_id").alias("id")),
        "customers": mapping.customers(spark, sf_dir).select(F.col("customer_id").alias("id")),
    }
    tables_here = TableSet(spark, scratch_path(spark, "sets"))
    first = tables_here.replace({name: df.filter("id % 2 = 0") for name, df in whole.items()})
    for name, df in whole.items():
        tables_here.stage(df.filter("id % 3 = 0"), name)
    lost = tables_here.state()
    last = tables_here.replace(whole)
    shown = {"first, read while the second is there": first, "after a lost load": lost, "second": last}
    rows = [
        tables_here.read(name, state).select(F.lit(label).alias("state"), F.lit(name).alias("table_name"), "id")
        for label, state in shown.items()
        for name in whole
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def merged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products from three files whose headers, and whose kinds of values, differ."""
    products = mapping.copied_products(spark, sf_dir).filter("copy = 0")
    key, price = F.col("product_id"), F.col("unit_price")
    files = {
        "a": (products.filter("product_id % 3 = 0"), {"ProductID": key, "UnitPrice": price, "Size": F.col("size")}),
        "b": (products.filter("product_id % 3 = 1"), {"Brand": F.col("brand"), "ProductID": key + 5_000_000_000}),
        "c": (
            products.filter("product_id % 3 = 2"),
            {"UnitPrice": price.cast("int"), "Size": F.concat("size", F.lit(" cm")), "ProductID": key, "Note": F.lit("a; b")},
        ),
    }
    folder = scratch_path(spark, "merged")
    for name, (rows, named) in files.items():
        write_delimited(rows.select(*[c.alias(n) for n, c in named.items()]), f"{folder}/{name}.csv")
    found = scan_merged(spark, [f"{folder}/{name}.csv" for name in files])
    kinds = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in sorted(found.schema.fields, key=lambda f: f.name))
    return found.withColumn("kinds", F.lit(kinds))


@query
def quoted_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with notes of several lines, written to files and cut into records by byte ranges."""
    key, name = F.col("c_custkey").cast("bigint"), F.col("c_name")
    note = F.concat(name, F.lit('; "'), "c_mktsegment", F.lit('"\n\n# '), key.cast("string"), F.lit(";\nend"))
    rows = mapping.table(spark, sf_dir, "customer").select(key.alias("Id"), name.alias("Name"), note.alias("Note"))
    path = scratch_path(spark, "notes")
    write_delimited(rows, path)
    read = scan_records(spark, path, raw_schemas.struct_of({"Id": "long", "Name": "string", "Note": "string"}))
    return read.select(F.col("Id").alias("customer_id"), F.col("Name").alias("company_name"), F.col("Note").alias("note"))


# Columns


@query
def exclude_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.exclude(mapping.customers(spark, sf_dir), ["city", "region"])


@query
def append_transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = mapping.dirty_customers(spark, sf_dir)
    return columns.derive(dirty, ["company_name", "region"], normalise, "_transformed")


@query
def cast_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = mapping.dirty_order_details(spark, sf_dir)
    typed = columns.cast(lines, {"quantity": "decimal(10,2)"})
    return columns.fill_defaults(typed, {"discount": 0})


# Filters and cleaning


@query
def row_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = mapping.copied_products(spark, sf_dir)
    return keep_where(products, "product_id", "<=", mapping.last_product_id(spark, sf_dir))


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.derive(
        mapping.dirty_orders(spark, sf_dir),
        ["order_date"],
        lambda c: parse_date(c, ORDER_DATE_PATTERN),
    )


@query
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated_orders(spark, sf_dir).select("order_id", "order_date")


@query
def not_null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_present(_dated_orders(spark, sf_dir), "order_date")


PRODUCT_CONTENT = ["product_name", "brand", "category_name", "size", "unit_price"]


@query
def dedupe_first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_first(mapping.copied_products(spark, sf_dir), PRODUCT_CONTENT, "product_id")


@query
def flag_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = mapping.copied_products(spark, sf_dir).drop("copy")
    return flag_duplicates(products, PRODUCT_CONTENT, "product_id", chosen="duplicate_chosen")


@query
def null_token_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.dirty_customers(spark, sf_dir).select(
        "customer_id",
        null_token(F.col("region")).alias("region"),
        blank_token(F.col("region")).alias("region_blank"),
    )


@query
def normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = mapping.dirty_customers(spark, sf_dir)
    return columns.derive(dirty, ["region", "country"], normalise)


@query
def discount_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    discount = F.col("discount")
    rules = [(discount.isNull(), F.lit(0)), (discount < 0, -discount), (F.lit(True), discount)]
    return mapping.dirty_order_details(spark, sf_dir).withColumns(
        {"by_rules": first_match(rules), "by_repair": repaired_discount(discount)}
    )


# Dimensions


@query
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions(spark, sf_dir)[1].product


@query
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions(spark, sf_dir)[1].customer


@query
def dim_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions(spark, sf_dir)[1].employee


@query
def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions(spark, sf_dir)[1].time.withColumn("day_number", day_number(F.col("date")))


@query
def dim_shipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shipping dimension with the number of orders sent by each shipper."""
    shipping = dimensions(spark, sf_dir)[1].shipping
    sent = mapping.orders(spark, sf_dir).groupBy("ship_via").agg(F.count("*").alias("orders"))
    return shipping.join(F.broadcast(sent), F.col("ship_via_id") == F.col("ship_via")).drop("ship_via")


@query
def dense_key_over_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys 1..n by date and id, numbered over the cluster."""
    rows = mapping.orders(spark, sf_dir).select("order_date", "order_id")
    return dense_key(rows, ["order_date", "order_id"], "order_key")


@query
def rank_over_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders ranked by their number of lines, with many ties, over the cluster."""
    counts = line_counts(mapping.order_details(spark, sf_dir))
    return rank_descending(counts, "line_count", "order_id", "line_rank")


# Fact


@query
def order_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_counts(mapping.order_details(spark, sf_dir))


@query
def line_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = mapping.order_details(spark, sf_dir)
    amount = line_amount(F.col("unit_price"), F.col("quantity"), F.col("discount"))
    return lines.select("order_id", "line_number", "product_id", amount.alias("total_amount"))


@query
def freight_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = mapping.order_details(spark, sf_dir).select("order_id", "line_number", "product_id")
    headers = mapping.orders(spark, sf_dir).join(line_counts(lines), "order_id")
    split = join_sliced(lines, headers.select("order_id", "freight", "line_count"), ["order_id"])
    share = freight_share(F.col("freight"), F.col("line_count")).alias("freight_allocation")
    return split.select(*lines.columns, share)


@query
def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(spark, sf_dir).fact.select(*FACT_COLUMNS)


@query
def fact_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact in folders by year, from orders and lines that are joined in their buckets."""
    return mart_by_year(spark, sf_dir).fact.select(*FACT_COLUMNS, ORDER_YEAR)


@query
def orders_by_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by country, year and category and by every coarser grouping, from one set of bitmaps.

    Orders are numbered along their country and year, so that the numbers of a group lie together and fill few bitmaps:
    numbers that are scattered over the groups would give each group a bitmap, mostly empty, for each range of numbers.
    """
    built = mart(spark, sf_dir)
    customers = built.dims.customer.select("customer_key", "country")
    years = built.dims.time.select(F.col("time_key").alias("order_time_key"), "year")
    categories = built.dims.product.select("product_key", "category_name")
    # One row per order, whatever its lines say: an order keeps one number in all groups.
    orders = built.fact.groupBy("order_id").agg(*[F.min(c).alias(c) for c in ("customer_key", "order_time_key")])
    orders = orders.join(customers, "customer_key").join(years, "order_time_key").select("order_id", "country", "year")
    numbers = dense_key(orders, ["country", "year", "order_id"], "number").select("order_id", "number")
    lines = built.fact.join(categories, "product_key").groupBy("order_id", "customer_key", "order_time_key", "category_name")
    rows = built.fact.count()
    placed = deal(lines.agg(F.count("*").alias("lines")), ["order_id"], rows).join(deal(numbers, ["order_id"], rows), "order_id")
    placed = placed.join(customers, "customer_key").join(years, "order_time_key")
    names = ["country", "year", "category_name"]
    sets = [[n for i, n in enumerate(names) if mask >> i & 1] for mask in range(8)]
    return bitmaps.rolled_up(bitmaps.distinct_bitmaps(placed, names, "number"), sets, "orders")


@query
def fact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense fact key runs from 1 to the number of lines without a gap."""
    built = mart(spark, sf_dir)
    fact = fact_orders_with_key(built.tables["order_details"], built.tables["orders"], built.dims, dense_keys=True)
    return fact.agg(
        F.count("*").alias("rows"),
        F.min("fact_id").alias("first_key"),
        F.max("fact_id").alias("last_key"),
        F.count_distinct("fact_id").alias("keys"),
    )


@query
def fact_sliced_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with orders of five and more lines cut into slices."""
    built = mart(spark, sf_dir)
    lines = built.tables["order_details"]
    fact = fact_lines(lines, built.tables["orders"], built.dims, ("line_number",), slice_rows=5)
    return fact.select("order_id", "line_number", "product_key", "total_amount", "freight_allocation")


@query
def existing_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose order has a date and whose product is still sold."""
    lines = mapping.order_details(spark, sf_dir).select("order_id", "line_number", "product_id")
    dated = keep_present(_dated_orders(spark, sf_dir), "order_date")
    sold = keep_where(mapping.products(spark, sf_dir), "discontinued", "=", False)
    return existing(existing(lines, dated, "order_id"), sold, "product_id").select(*lines.columns)


@query
def dropped_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = dimensions(spark, sf_dir)[1]
    return dropped_lines(mapping.order_details(spark, sf_dir), _dated_orders(spark, sf_dir), dims)


@query
def dropped_line_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by the reason to drop them, over orders and dimensions that each lack some rows."""
    dims = dimensions(spark, sf_dir)[1]
    fewer = Dimensions(
        product=dims.product.filter("product_id % 11 <> 3"),
        customer=dims.customer.filter("customer_id % 7 <> 2"),
        employee=dims.employee.filter("employee_id % 5 <> 1"),
        time=dims.time,
        shipping=dims.shipping.filter("ship_via_id <> 3"),
    )
    orders = _dated_orders(spark, sf_dir).filter("order_id % 13 <> 4")
    return dropped_lines(mapping.order_details(spark, sf_dir), orders, fewer)


# Reports


@query
def revenue_by_category_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = mart(spark, sf_dir)
    return reports.revenue_by_category_quarter(built.fact, built.dims.product, built.dims.time)


@query
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = mart(spark, sf_dir)
    return reports.top_customers(built.fact, built.dims.customer)


@query
def employee_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = mart(spark, sf_dir)
    return reports.employee_performance(built.fact, built.dims.employee)


@query
def shipping_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = mart(spark, sf_dir)
    return reports.shipping_analysis(built.fact, built.dims.shipping)


@query
def weekend_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = mart(spark, sf_dir)
    return reports.weekend_patterns(built.fact, built.dims.customer, built.dims.time)


# Staging tables from source files


def _staged(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    file, clean = staging.CLEAN[table]
    return clean(staging.read_raw(spark, source_file(spark, sf_dir, file), file))


@query
def staging_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "categories")


@query
def staging_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "customers")


@query
def staging_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "products")


@query
def staging_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "orders")


@query
def staging_orders_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = staging.read_raw(spark, source_file(spark, sf_dir, "Orders"), "Orders")
    return staging.orders(raw, upper_text=True)


@query
def staging_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "order_details")


@query
def staging_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "employees")


@query
def staging_employees_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = staging.read_raw(spark, source_file(spark, sf_dir, "Employees"), "Employees")
    return staging.employees_with_normalised_text(raw)


@query
def raw_to_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_from_files(spark, sf_dir).fact.select(*FACT_COLUMNS)


@query
def raw_to_employee_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = mart_from_files(spark, sf_dir)
    return reports.employee_performance(built.fact, built.dims.employee)


# Checks


@query
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["order_id", "customer_id", "order_date", "freight"]
    return checks.null_counts(_dated_orders(spark, sf_dir), names)


@query
def check_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.key_breaches(mapping.copied_products(spark, sf_dir, same_key=True), ["product_id"])


@query
def check_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.key_breaches(mapping.order_details(spark, sf_dir), ["order_id", "product_id"])


@query
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.key_breaches(mapping.products(spark, sf_dir), ["product_name"])


@query
def check_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = mart(spark, sf_dir)
    fact, dims = built.fact, built.dims
    dated = keep_present(_dated_orders(spark, sf_dir), "order_date")
    return checks.orphan_counts(
        {
            "product_key": (fact, "product_key", dims.product, "product_key"),
            "customer_key": (fact, "customer_key", dims.customer, "customer_key"),
            "employee_key": (fact, "employee_key", dims.employee, "employee_key"),
            "order_time_key": (fact, "order_time_key", dims.time, "time_key"),
            "shipping_key": (fact, "shipping_key", dims.shipping, "shipping_key"),
            "dated_order": (fact, "order_id", dated, "order_id"),
        }
    )


@query
def check_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = {"company_name": 18, "region": 4, "country": 8}
    return checks.length_breaches(mapping.customers(spark, sf_dir), limits)


@query
def check_number_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = {"unit_price": "decimal(6,2)", "quantity": "decimal(2,0)", "discount": "decimal(5,4)"}
    return checks.cast_breaches(mapping.order_details(spark, sf_dir), types)


@query
def profile_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.profile(_dated_orders(spark, sf_dir))


@query
def domain_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.domain_values(mapping.dirty_customers(spark, sf_dir), ["region", "country"])


@query
def column_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists or bounds of the values of every column of the products."""
    products = mapping.copied_products(spark, sf_dir)
    mixed = products.withColumns({"unit_price": F.col("unit_price").cast("double"), "nothing": F.lit(None).cast("int")})
    return checks.column_domains(mixed.withColumn("size", F.when(F.col("size") != 7, F.col("size"))), list_values=49)


@query
def issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = mapping.dirty_order_details(spark, sf_dir)
    products = flag_duplicates(
        mapping.copied_products(spark, sf_dir).drop("copy"), PRODUCT_CONTENT, "product_id"
    )
    orders = mapping.dirty_orders(spark, sf_dir)
    customers = mapping.dirty_customers(spark, sf_dir)
    dated = parse_date(F.col("order_date"), ORDER_DATE_PATTERN)
    return checks.issue_counts(
        {
            "negative discount": (lines, F.col("discount") < 0),
            "empty discount": (lines, F.col("discount").isNull()),
            "duplicate product": (products, F.col("duplicate_status") == "duplicate"),
            "date text": (orders, F.col("order_date").isNotNull() & dated.isNull()),
            "null text": (customers, F.col("region") == "NULL"),
        }
    )

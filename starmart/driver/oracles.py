"""The queries as DuckDB SQL, written apart from the Spark code.

Money is whole cents here, so every rounding is integer arithmetic; results are doubles. Rounding half
up of a / b is (2 * a + b) // (2 * b).
"""

from __future__ import annotations

# Building blocks, each a common table expression.

CATEGORIES = """categories AS (
  SELECT row_number() OVER (ORDER BY p_type) AS category_id, p_type AS category_name
  FROM (SELECT DISTINCT p_type FROM part))"""

PLACES = """places AS (
  SELECT c.*, n_name, r_name,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'NULL' WHEN 'MACHINERY' THEN ' null ' ELSE r_name END AS dirty_region
  FROM customer c JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

STAFF = """staff AS (
  SELECT s_suppkey, split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name,
    CASE WHEN s_suppkey = 0 THEN 'Head of Sales' ELSE 'Sales Representative' END AS title,
    CASE WHEN s_suppkey <> 0 THEN (s_suppkey - 1) // 9 END AS reports_to
  FROM supplier)"""

HEADERS = """headers AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
    o_orderstatus, o_orderpriority,
    CAST(o_orderkey % 3 + 1 AS INTEGER) AS ship_via,
    (CAST(round(o_totalprice * 100) AS BIGINT) * 5 + 50) // 100 AS freight_cents,
    CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END AS parsed_date
  FROM orders)"""

LINES = """cents AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS employee_id, l_linenumber AS line_number,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS line_cents, CAST(l_quantity AS INTEGER) AS quantity,
    CAST(round(l_discount * 10000) AS BIGINT) AS d,
    CASE WHEN l_linenumber = 7 THEN -l_discount WHEN l_linenumber <> 6 THEN l_discount END AS dirty_discount,
    CASE WHEN l_linenumber = 6 THEN 0 ELSE CAST(round(l_discount * 10000) AS BIGINT) END AS repaired
  FROM lineitem),
lines AS (
  SELECT *, (2 * line_cents + quantity) // (2 * quantity) AS price_cents FROM cents)"""

COUNTS = "counts AS (SELECT order_id, count(*) AS line_count FROM lines GROUP BY order_id)"

# The shippers.
SHIPPERS = """shippers(ship_via_id, shipper_name) AS (
  VALUES (1, 'Speedy Express'), (2, 'United Package'), (3, 'Federal Shipping'))"""

# The star schema joined back together: one row per fact line, with natural attributes.
SALES = """sales AS (
  SELECT l.order_id, l.product_id, l.employee_id, l.line_number, h.customer_id, h.order_date, h.ship_via,
    l.price_cents, l.quantity, l.d,
    (l.price_cents * l.quantity * (10000 - l.d) + 5000) // 10000 AS amount,
    (2 * h.freight_cents + line_count) // (2 * line_count) AS freight
  FROM lines l JOIN headers h USING (order_id) JOIN counts USING (order_id))"""

COPIES = """copies AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS category_name,
    p_size AS size, CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents, 0 AS copy FROM part
  UNION ALL
  SELECT p_partkey + (SELECT max(p_partkey) + 1 FROM part), p_name, p_brand, p_type, p_size,
    CAST(round(p_retailprice * 100) AS BIGINT), 1 FROM part WHERE p_brand = 'Brand#2')"""

SAME_KEY_COPIES = """copies AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS category_name,
    p_size AS size, CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents, 0 AS copy FROM part
  UNION ALL
  SELECT p_partkey, p_name, p_brand, p_type, p_size, CAST(round(p_retailprice * 100) AS BIGINT), 1
  FROM part WHERE p_brand = 'Brand#2')"""

FILE_PRODUCTS = """file_products AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY product_name, length(brand), category_name, size, price_cents ORDER BY product_id) AS nth
    FROM copies) WHERE nth = 1)"""

FILE_LINES = """file_sales AS (
  SELECT l.order_id, l.product_id, h.customer_id, h.ship_via, seller, h.order_date, l.price_cents, l.quantity,
    l.repaired, (l.price_cents * l.quantity * (10000 - l.repaired) + 5000) // 10000 AS amount,
    (2 * h.freight_cents + line_count) // (2 * line_count) AS freight
  FROM lines l JOIN headers h USING (order_id)
  JOIN (SELECT order_id, count(*) AS line_count, min(employee_id) AS seller FROM lines GROUP BY 1) USING (order_id)
  JOIN file_products p ON p.product_id = l.product_id
  WHERE NOT (h.o_orderstatus = 'O' AND h.o_orderpriority = '5-LOW'))"""


def _key(column: str, source: str) -> str:
    return f"(SELECT {column} AS id, row_number() OVER (ORDER BY {column}) AS key FROM {source})"


def _text_key(column: str, source: str) -> str:
    return f"(SELECT {column} AS id, row_number() OVER (ORDER BY CAST({column} AS VARCHAR)) AS key FROM {source})"


def _sql(*ctes: str, select: str) -> str:
    return f"WITH {', '.join(ctes)} {select}" if ctes else select


def _money(column: str) -> str:
    return f"CAST({column} AS DOUBLE) / 100"


def _upper_clean(column: str) -> str:
    return f"nullif(trim(replace(upper(coalesce({column}, '')), 'NULL', '')), '')"


STAR = (HEADERS, LINES, COUNTS, SALES)
EMPLOYEE_TEXT = {
    "LastName": "last_name",
    "FirstName": "first_name",
    "Title": "title",
    "TitleOfCourtesy": "'Dr.'",
    "Address": "'Gässli 5'",
    "City": "'Zürich'",
    "Region": "'NULL'",
    "PostalCode": "'8000'",
    "Country": "'CH'",
    "HomePhone": "'044'",
    "Photo": "'0x00'",
    "Notes": "'first line' || chr(10) || 'second; line ' || s_suppkey",
    "ReportsTo": "coalesce(CAST(reports_to AS VARCHAR), 'NULL')",
    "PhotoPath": "'photos/' || s_suppkey",
}
BIRTH = "CAST(DATE '1950-01-01' + CAST(s_suppkey % 10000 AS INTEGER) AS DATE)"
HIRE = f"CASE WHEN s_suppkey <> 0 THEN CAST({BIRTH} + 9000 AS DATE) END"

ORACLES: dict[str, str] = {
    "csv_scan": _sql(
        PLACES,
        select="""
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS company_name,
      '"Contact" ' || c_custkey AS contact_name, c_mktsegment AS contact_title, 'Street; ' || c_custkey AS address,
      'São ' || n_name AS city, trim(dirty_region) AS region, CAST(NULL AS VARCHAR) AS postal_code,
      n_name AS country, CAST(c_custkey AS VARCHAR) AS phone,
      CASE WHEN c_acctbal < 0 THEN 'NULL' ELSE CAST(c_custkey AS VARCHAR) END AS fax
    FROM places""",
    ),
    "corrupt_rows": """
    SELECT l_orderkey AS order_id, l_partkey AS product_id,
      CASE WHEN l_quantity <= 40 THEN CAST(l_quantity AS INTEGER) END AS quantity, l_quantity > 40 AS corrupt
    FROM lineitem""",
    "row_range": _sql(
        COPIES,
        select=f"""
    SELECT product_id, {_money('price_cents')} AS unit_price FROM copies ORDER BY product_id OFFSET 100""",
    ),
    "row_range_limited": _sql(
        COPIES,
        select=f"""
    SELECT product_id, {_money('price_cents')} AS unit_price FROM copies ORDER BY product_id LIMIT 50 OFFSET 100""",
    ),
    "decimal_text": _sql(
        LINES,
        select=f"""
    SELECT order_id, product_id, CASE WHEN quantity <= 40 THEN {_money('price_cents')} END AS unit_price,
      quantity > 40 AS corrupt FROM lines""",
    ),
    "inferred_types": """
    SELECT 'OrderID' AS column_name, CASE WHEN max(l_orderkey) < 2147483648 THEN 'int' ELSE 'bigint' END AS type FROM lineitem
    UNION ALL SELECT 'ProductID', CASE WHEN max(l_partkey) < 2147483648 THEN 'int' ELSE 'bigint' END FROM lineitem
    UNION ALL VALUES ('UnitPrice', 'double'), ('Quantity', 'string'), ('Discount', 'double')""",
    "table_sink_append": _sql(
        PLACES,
        select="""
    SELECT c_custkey AS customer_id, c_name AS company_name, c_mktsegment AS city, r_name AS region, n_name AS country
    FROM places
    UNION ALL SELECT c_custkey, c_name, NULL, NULL, NULL FROM places""",
    ),
    "table_sink_overwrite": _sql(
        PLACES,
        select="""
    SELECT c_custkey AS customer_id, c_name AS company_name, r_name AS region, n_name AS country FROM places""",
    ),
    "insert_defaults": """
    SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_number,
      CAST(l_quantity AS INTEGER) AS quantity, CAST(0 AS DOUBLE) AS discount FROM lineitem""",
    "write_status": _sql(
        SAME_KEY_COPIES,
        select="""
    SELECT product_id, copy, CASE WHEN write_error IS NULL THEN 1 ELSE 0 END AS write_status, write_error FROM (
      SELECT product_id, copy, nullif(concat_ws('; ',
        CASE WHEN length(product_name) > 10 THEN 'name too long' END,
        CASE WHEN price_cents >= 100000 THEN 'price out of range' END,
        CASE WHEN copy = 1 THEN 'duplicate key' END), '') AS write_error FROM copies)""",
    ),
    "write_status_exact_copies": _sql(
        SAME_KEY_COPIES,
        select="""
    SELECT product_id, 1 - copy AS write_status, CASE WHEN copy = 1 THEN 'duplicate key' END AS write_error FROM copies""",
    ),
    "refused_rows": _sql(
        SAME_KEY_COPIES,
        select="""
    SELECT product_id, copy, concat_ws('; ', CASE WHEN size = 7 THEN 'no product_name' END,
      CASE WHEN copy = 1 THEN 'duplicate key' END) AS write_error
    FROM copies WHERE size = 7 OR copy = 1""",
    ),
    "admitted_batch": _sql(
        SAME_KEY_COPIES,
        select="""
    , sent AS (
      SELECT product_id, CASE WHEN size <> 7 THEN product_name END AS product_name,
        price_cents * (CASE WHEN size = 5 THEN 2 ELSE 1 END) AS cents, copy FROM copies),
    judged AS (
      SELECT *, concat_ws('; ', CASE WHEN product_name IS NULL THEN 'no product_name' END,
        CASE WHEN length(product_name) > 9 THEN 'product_name too long' END,
        CASE WHEN cents > 99999 THEN 'unit_price out of range' END) AS error FROM sent),
    first AS (SELECT * FROM judged WHERE product_id % 3 = 0 AND copy = 0),
    second AS (
      SELECT * REPLACE (concat_ws('; ', nullif(error, ''), CASE WHEN copy = 1 THEN 'duplicate key' END,
        CASE WHEN product_id IN (SELECT product_id FROM first WHERE error = '') THEN 'key exists' END) AS error) FROM judged)
    SELECT product_id, product_name, CAST(cents AS DOUBLE) / 100 AS unit_price, copy,
      CASE WHEN error <> '' THEN batch END AS batch, nullif(error, '') AS write_error, error = '' AS held
    FROM (SELECT *, 'first' AS batch FROM first UNION ALL SELECT *, 'second' FROM second)""",
    ),
    "published_sets": """
    SELECT state, table_name, id FROM (
      SELECT 'orders' AS table_name, o_orderkey AS id FROM orders UNION ALL SELECT 'customers', c_custkey FROM customer),
      (VALUES ('first, read while the second is there', 2), ('after a lost load', 2), ('second', 1)) AS s(state, every)
    WHERE id % every = 0""",
    "merged_files": """
    SELECT CASE WHEN p_partkey % 3 = 1 THEN p_partkey + 5000000000 ELSE p_partkey END AS ProductID,
      CASE p_partkey % 3 WHEN 0 THEN CAST(p_retailprice AS DOUBLE) WHEN 2 THEN trunc(p_retailprice) END AS UnitPrice,
      CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 2 THEN p_size || ' cm' END AS Size,
      CASE WHEN p_partkey % 3 = 1 THEN p_brand END AS Brand, CASE WHEN p_partkey % 3 = 2 THEN 'a; b' END AS Note,
      'Brand:string,Note:string,ProductID:bigint,Size:string,UnitPrice:double' AS kinds
    FROM part""",
    "quoted_line_breaks": """
    SELECT CAST(c_custkey AS BIGINT) AS customer_id, c_name AS company_name,
      c_name || '; "' || c_mktsegment || '"' || chr(10) || chr(10) || '# ' || c_custkey || ';' || chr(10) || 'end' AS note
    FROM customer""",
    "exclude_columns": _sql(
        PLACES, select="SELECT c_custkey AS customer_id, c_name AS company_name, n_name AS country FROM places"
    ),
    "append_transformed": _sql(
        PLACES,
        select=f"""
    SELECT c_custkey AS customer_id, c_name AS company_name, dirty_region AS region, n_name AS country,
      {_upper_clean('c_name')} AS company_name_transformed, {_upper_clean('dirty_region')} AS region_transformed
    FROM places""",
    ),
    "cast_defaults": _sql(
        LINES,
        select="""
    SELECT order_id, product_id, line_number, CAST(quantity AS DOUBLE) AS quantity,
      coalesce(dirty_discount, 0) AS discount FROM lines""",
    ),
    "row_filter": _sql(
        COPIES,
        select=f"""
    SELECT product_id, product_name, brand, category_name, size, {_money('price_cents')} AS unit_price, copy
    FROM copies WHERE copy = 0""",
    ),
    "parse_dates": _sql(HEADERS, select="SELECT order_id, parsed_date AS order_date FROM headers"),
    "not_null_filter": _sql(
        HEADERS,
        select=f"""
    SELECT order_id, customer_id, parsed_date AS order_date, ship_via, {_money('freight_cents')} AS freight
    FROM headers WHERE o_orderstatus <> 'O'""",
    ),
    "dedupe_first_row": _sql(
        COPIES,
        select=f"""
    SELECT product_id, product_name, brand, category_name, size, {_money('price_cents')} AS unit_price, copy
    FROM copies QUALIFY row_number() OVER (
      PARTITION BY product_name, brand, category_name, size, price_cents ORDER BY product_id) = 1""",
    ),
    "flag_duplicate_rows": _sql(
        COPIES,
        select=f"""
    SELECT product_id, product_name, brand, category_name, size, {_money('price_cents')} AS unit_price,
      CASE WHEN count(*) OVER same = 1 THEN 'unique' WHEN min(product_id) OVER same = product_id THEN 'chosen'
        ELSE 'duplicate' END AS duplicate_status,
      CASE WHEN count(*) OVER same > 1 THEN min(product_id) OVER same END AS duplicate_chosen
    FROM copies WINDOW same AS (PARTITION BY product_name, brand, category_name, size, price_cents)""",
    ),
    "null_token_text": _sql(
        PLACES,
        select="""
    SELECT c_custkey AS customer_id, nullif(dirty_region, 'NULL') AS region,
      CASE WHEN dirty_region = 'NULL' THEN '' ELSE dirty_region END AS region_blank FROM places""",
    ),
    "normalise_text": _sql(
        PLACES,
        select=f"""
    SELECT c_custkey AS customer_id, c_name AS company_name, {_upper_clean('dirty_region')} AS region,
      {_upper_clean('n_name')} AS country FROM places""",
    ),
    "discount_rules": _sql(
        LINES,
        select="""
    SELECT order_id, product_id, line_number, quantity, dirty_discount AS discount,
      CAST(repaired AS DOUBLE) / 10000 AS by_rules, CAST(repaired AS DOUBLE) / 10000 AS by_repair FROM lines""",
    ),
    "dim_product": """
    SELECT row_number() OVER (ORDER BY p_partkey) AS product_key, p_partkey AS product_id, p_name AS product_name,
      p_type AS category_name, p_retailprice AS unit_price, p_size > 40 AS discontinued FROM part""",
    "dim_customer": _sql(
        PLACES,
        select="""
    SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id, c_name AS company_name,
      c_mktsegment AS city, r_name AS region, n_name AS country FROM places""",
    ),
    "dim_employee": _sql(
        STAFF,
        select="""
    SELECT row_number() OVER (ORDER BY e.s_suppkey) AS employee_key, e.s_suppkey AS employee_id,
      e.first_name || ' ' || e.last_name AS full_name, e.title,
      m.first_name || ' ' || m.last_name AS reports_to_name
    FROM staff e LEFT JOIN staff m ON m.s_suppkey = e.reports_to""",
    ),
    "dim_time": _sql(
        HEADERS,
        select="""
    SELECT row_number() OVER (ORDER BY order_date) AS time_key, order_date AS date,
      rpad(dayname(order_date), 9, ' ') AS day_name, CAST(month(order_date) AS INTEGER) AS month,
      CAST(quarter(order_date) AS INTEGER) AS quarter, CAST(year(order_date) AS INTEGER) AS year,
      dayofweek(order_date) IN (0, 6) AS is_weekend, CAST(dayofweek(order_date) AS INTEGER) AS day_number
    FROM (SELECT DISTINCT order_date FROM headers)""",
    ),
    "dim_shipping": _sql(
        SHIPPERS,
        HEADERS,
        select="""
    SELECT CAST(ship_via_id AS BIGINT) AS shipping_key, ship_via_id, shipper_name, count(*) AS orders
    FROM shippers JOIN headers ON ship_via = ship_via_id GROUP BY ALL""",
    ),
    "dense_key_over_tasks": _sql(
        HEADERS,
        select="""
    SELECT row_number() OVER (ORDER BY order_date, order_id) AS order_key, order_date, order_id FROM headers""",
    ),
    "rank_over_tasks": _sql(
        LINES,
        COUNTS,
        select="SELECT order_id, line_count, rank() OVER (ORDER BY line_count DESC) AS line_rank FROM counts",
    ),
    "order_line_counts": _sql(LINES, COUNTS, select="SELECT order_id, line_count FROM counts"),
    "line_amounts": _sql(
        *STAR,
        select=f"SELECT order_id, line_number, product_id, {_money('amount')} AS total_amount FROM sales",
    ),
    "freight_split": _sql(
        *STAR,
        select=f"SELECT order_id, line_number, product_id, {_money('freight')} AS freight_allocation FROM sales",
    ),
    "orders_by_rollup": _sql(
        *STAR,
        select="""
    SELECT concat_ws(',', CASE WHEN grouping(n_name) = 0 THEN 'country' END, CASE WHEN grouping(year) = 0 THEN 'year' END,
        CASE WHEN grouping(p_type) = 0 THEN 'category_name' END) AS grouped_by,
      n_name AS country, year, p_type AS category_name, count(DISTINCT order_id) AS orders
    FROM (
      SELECT s.order_id, n_name, CAST(year(order_date) AS INTEGER) AS year, p_type FROM sales s
      JOIN customer ON c_custkey = customer_id JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = product_id)
    GROUP BY CUBE (n_name, year, p_type)""",
    ),
    "fact_orders": _sql(
        *STAR,
        select=f"""
    SELECT p.key AS product_key, c.key AS customer_key, e.key AS employee_key, t.key AS order_time_key,
      CAST(ship_via AS BIGINT) AS shipping_key, order_id, {_money('price_cents')} AS unit_price, quantity,
      CAST(d AS DOUBLE) / 10000 AS discount, {_money('amount')} AS total_amount,
      {_money('freight')} AS freight_allocation
    FROM sales JOIN {_key('p_partkey', 'part')} p ON p.id = product_id
    JOIN {_key('c_custkey', 'customer')} c ON c.id = customer_id
    JOIN {_key('s_suppkey', 'supplier')} e ON e.id = employee_id
    JOIN {_key('d', '(SELECT DISTINCT order_date AS d FROM headers)')} t ON t.id = order_date""",
    ),
    "fact_keys": """
    SELECT count(*) AS rows, CAST(1 AS BIGINT) AS first_key, count(*) AS last_key, count(*) AS keys FROM lineitem""",
    "fact_sliced_join": _sql(
        *STAR,
        select=f"""
    SELECT order_id, line_number, p.key AS product_key, {_money('amount')} AS total_amount,
      {_money('freight')} AS freight_allocation
    FROM sales JOIN {_key('p_partkey', 'part')} p ON p.id = product_id""",
    ),
    "existing_parents": _sql(
        LINES,
        HEADERS,
        select="""
    SELECT order_id, line_number, product_id FROM lines
    WHERE order_id IN (SELECT order_id FROM headers WHERE o_orderstatus <> 'O')
      AND product_id IN (SELECT p_partkey FROM part WHERE p_size <= 40)""",
    ),
    "dropped_line_counts": _sql(
        LINES,
        HEADERS,
        select="""
    SELECT CASE WHEN parsed_date IS NULL THEN 'no order date' ELSE 'kept' END AS reason, count(*) AS lines
    FROM lines JOIN headers USING (order_id) GROUP BY 1""",
    ),
    "dropped_line_reasons": """
    SELECT CASE WHEN o_orderkey IS NULL OR o_orderkey % 13 = 4 THEN 'no order'
      WHEN l_partkey % 11 = 3 OR l_partkey NOT IN (SELECT p_partkey FROM part) THEN 'no product'
      WHEN o_custkey % 7 = 2 OR o_custkey NOT IN (SELECT c_custkey FROM customer) THEN 'no customer'
      WHEN l_suppkey % 5 = 1 OR l_suppkey NOT IN (SELECT s_suppkey FROM supplier) THEN 'no employee'
      WHEN o_orderstatus = 'O' THEN 'no order date'
      WHEN o_orderkey % 3 + 1 = 3 THEN 'no shipper'
      ELSE 'kept' END AS reason, count(*) AS lines
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "revenue_by_category_quarter": _sql(
        *STAR,
        """revenue AS (
      SELECT p_type AS category_name, year(order_date) AS y, quarter(order_date) AS q, sum(amount) AS cents
      FROM sales JOIN part ON p_partkey = product_id GROUP BY ALL)""",
        select=f"""
    SELECT category_name, CAST(y AS INTEGER) AS year, CAST(q AS INTEGER) AS quarter,
      {_money('cents')} AS total_revenue,
      CAST((2000 * cents + sum(cents) OVER quarter) // (2 * sum(cents) OVER quarter) AS DOUBLE) / 10 AS pct_of_quarter
    FROM revenue WINDOW quarter AS (PARTITION BY y, q)""",
    ),
    "top_customers": _sql(
        *STAR,
        """ranked AS (
      SELECT customer_id, count(DISTINCT order_id) AS n, sum(amount) AS cents FROM sales GROUP BY customer_id
      ORDER BY cents DESC, customer_id LIMIT 10)""",
        select=f"""
    SELECT c_name AS company_name, n_name AS country, n AS order_count, {_money('cents')} AS total_revenue,
      CAST((2 * cents + n) // (2 * n) AS DOUBLE) / 100 AS avg_order_value
    FROM ranked JOIN customer ON c_custkey = customer_id JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "employee_performance": _sql(
        *STAR,
        STAFF,
        """seller AS (
      SELECT employee_id, count(DISTINCT order_id) AS n, sum(amount) AS cents FROM sales GROUP BY employee_id)""",
        select=f"""
    SELECT e.first_name || ' ' || e.last_name AS employee_name, e.title,
      coalesce(m.first_name || ' ' || m.last_name, '(Top Manager)') AS manager_name, n AS order_count,
      {_money('cents')} AS total_revenue, rank() OVER (ORDER BY cents DESC) AS revenue_rank
    FROM seller JOIN staff e ON e.s_suppkey = employee_id LEFT JOIN staff m ON m.s_suppkey = e.reports_to""",
    ),
    "shipping_analysis": _sql(
        *STAR,
        SHIPPERS,
        """shipped AS (
      SELECT ship_via, count(DISTINCT order_id) AS n, sum(amount) AS cents, sum(freight) AS f
      FROM sales GROUP BY ship_via)""",
        select=f"""
    SELECT shipper_name, n AS order_count, {_money('cents')} AS total_revenue, {_money('f')} AS total_freight,
      CAST((20000 * f + cents) // (2 * cents) AS DOUBLE) / 100 AS freight_pct_of_revenue,
      CAST((2 * f + n) // (2 * n) AS DOUBLE) / 100 AS avg_freight_per_order
    FROM shipped JOIN shippers ON ship_via = ship_via_id""",
    ),
    "weekend_patterns": _sql(
        *STAR,
        """marked AS (
      SELECT n_name, order_id, amount, dayofweek(order_date) IN (0, 6) AS w
      FROM sales JOIN customer ON c_custkey = customer_id JOIN nation ON c_nationkey = n_nationkey),
    grouped AS (
      SELECT n_name, sum(CASE WHEN w THEN amount ELSE 0 END) AS we, sum(CASE WHEN w THEN 0 ELSE amount END) AS wd,
        count(DISTINCT CASE WHEN w THEN order_id END) AS n_we, count(DISTINCT CASE WHEN NOT w THEN order_id END) AS n_wd,
        count(DISTINCT order_id) AS n
      FROM marked GROUP BY n_name)""",
        select=f"""
    SELECT n_name AS country, {_money('we')} AS weekend_revenue, {_money('wd')} AS weekday_revenue,
      n_we AS weekend_orders, n_wd AS weekday_orders,
      CAST((2000 * n_we + n) // (2 * n) AS DOUBLE) / 10 AS weekend_order_pct
    FROM grouped""",
    ),
    "staging_categories": _sql(
        CATEGORIES,
        select="SELECT category_id, category_name, 'Parts; type ' || category_name AS description FROM categories",
    ),
    "staging_customers": _sql(
        PLACES,
        select="""
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS company_name,
      '"Contact" ' || c_custkey AS contact_name, c_mktsegment AS contact_title, 'Street; ' || c_custkey AS address,
      'São ' || n_name AS city, nullif(trim(dirty_region), 'NULL') AS region, CAST(NULL AS VARCHAR) AS postal_code,
      n_name AS country, CAST(c_custkey AS VARCHAR) AS phone,
      CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey AS VARCHAR) END AS fax
    FROM places""",
    ),
    "staging_products": _sql(
        CATEGORIES,
        COPIES,
        FILE_PRODUCTS,
        select=f"""
    SELECT product_id, product_name, CAST(length(brand) AS BIGINT) AS supplier_id, category_id,
      size || ' per "box"' AS quantity_per_unit, {_money('price_cents')} AS unit_price, size AS units_in_stock,
      CAST(NULL AS INTEGER) AS units_on_order, 10 AS reorder_level, size > 40 AS discontinued
    FROM file_products JOIN categories USING (category_name)""",
    ),
    "staging_orders": _sql(
        HEADERS,
        LINES,
        select=f"""
    SELECT order_id, CAST(customer_id AS VARCHAR) AS customer_id, seller AS employee_id,
      CASE WHEN NOT (o_orderstatus = 'O' AND o_orderpriority = '5-LOW') THEN order_date END AS order_date,
      CAST(order_date + 14 AS DATE) AS required_date,
      CASE WHEN o_orderstatus <> 'O' THEN CAST(order_date + 7 AS DATE) END AS shipped_date,
      ship_via, {_money('freight_cents')} AS freight, 'Ship ' || customer_id AS ship_name, 'Kai; 1' AS ship_address,
      'Münster' AS ship_city, CASE WHEN o_orderpriority <> '1-URGENT' THEN 'Süd' END AS ship_region,
      CAST(NULL AS VARCHAR) AS ship_postal_code, 'Nullarbor' AS ship_country
    FROM headers LEFT JOIN (SELECT order_id, min(employee_id) AS seller FROM lines GROUP BY 1) USING (order_id)""",
    ),
    "staging_orders_upper": _sql(
        HEADERS,
        LINES,
        select=f"""
    SELECT order_id, CAST(customer_id AS VARCHAR) AS customer_id, seller AS employee_id,
      CASE WHEN NOT (o_orderstatus = 'O' AND o_orderpriority = '5-LOW') THEN order_date END AS order_date,
      CAST(order_date + 14 AS DATE) AS required_date,
      CASE WHEN o_orderstatus <> 'O' THEN CAST(order_date + 7 AS DATE) END AS shipped_date,
      ship_via, {_money('freight_cents')} AS freight, 'SHIP ' || customer_id AS ship_name, 'KAI; 1' AS ship_address,
      'MÜNSTER' AS ship_city, CASE WHEN o_orderpriority <> '1-URGENT' THEN 'SÜD' END AS ship_region,
      CAST(NULL AS VARCHAR) AS ship_postal_code, 'ARBOR' AS ship_country
    FROM headers LEFT JOIN (SELECT order_id, min(employee_id) AS seller FROM lines GROUP BY 1) USING (order_id)""",
    ),
    "staging_order_details": _sql(
        LINES,
        select=f"""
    SELECT order_id, product_id, {_money('price_cents')} AS unit_price, quantity,
      CAST(repaired AS DOUBLE) / 10000 AS discount FROM lines""",
    ),
    "staging_employees": _sql(
        STAFF,
        select=f"""
    SELECT s_suppkey AS employee_id, last_name, first_name, title, 'Dr.' AS title_of_courtesy, {BIRTH} AS birth_date,
      {HIRE} AS hire_date, 'Gässli 5' AS address, 'Zürich' AS city, CAST(NULL AS VARCHAR) AS region,
      '8000' AS postal_code, 'CH' AS country, '044' AS home_phone, CAST(s_suppkey AS VARCHAR) AS extension,
      {EMPLOYEE_TEXT['Notes']} AS notes, reports_to, 'photos/' || s_suppkey AS photo_path
    FROM staff""",
    ),
    "staging_employees_appended": _sql(
        STAFF,
        select=f"""
    SELECT s_suppkey AS "EmployeeID", {BIRTH} AS "BirthDate", {HIRE} AS "HireDate",
      CAST(s_suppkey AS VARCHAR) AS "Extension",
      {', '.join(f'{value} AS "{name}"' for name, value in EMPLOYEE_TEXT.items())},
      {', '.join(f'{_upper_clean(value)} AS "{name}_transformed"' for name, value in EMPLOYEE_TEXT.items())}
    FROM staff""",
    ),
    "raw_to_fact": _sql(
        HEADERS,
        LINES,
        COPIES,
        FILE_PRODUCTS,
        FILE_LINES,
        select=f"""
    SELECT p.key AS product_key, c.key AS customer_key, e.key AS employee_key, t.key AS order_time_key,
      CAST(ship_via AS BIGINT) AS shipping_key, order_id, {_money('price_cents')} AS unit_price, quantity,
      CAST(repaired AS DOUBLE) / 10000 AS discount, {_money('amount')} AS total_amount,
      {_money('freight')} AS freight_allocation
    FROM file_sales s JOIN {_key('product_id', 'file_products')} p ON p.id = s.product_id
    JOIN {_text_key('c_custkey', 'customer')} c ON c.id = customer_id
    JOIN {_key('s_suppkey', 'supplier')} e ON e.id = seller
    JOIN {_key('d', '''(SELECT DISTINCT order_date AS d FROM headers
        WHERE NOT (o_orderstatus = 'O' AND o_orderpriority = '5-LOW'))''')} t ON t.id = order_date""",
    ),
    "raw_to_employee_performance": _sql(
        HEADERS,
        LINES,
        COPIES,
        FILE_PRODUCTS,
        FILE_LINES,
        STAFF,
        """seller AS (
      SELECT seller AS employee_id, count(DISTINCT order_id) AS n, sum(amount) AS cents FROM file_sales GROUP BY ALL)""",
        select=f"""
    SELECT e.first_name || ' ' || e.last_name AS employee_name, e.title,
      coalesce(m.first_name || ' ' || m.last_name, '(Top Manager)') AS manager_name, n AS order_count,
      {_money('cents')} AS total_revenue, rank() OVER (ORDER BY cents DESC) AS revenue_rank
    FROM seller JOIN staff e ON e.s_suppkey = employee_id LEFT JOIN staff m ON m.s_suppkey = e.reports_to""",
    ),
    "check_not_null": _sql(
        HEADERS,
        select="""
    SELECT 'order_id' AS column_name, count(*) AS rows, count(*) - count(order_id) AS nulls FROM headers
    UNION ALL SELECT 'customer_id', count(*), count(*) - count(customer_id) FROM headers
    UNION ALL SELECT 'order_date', count(*), count(*) - count(parsed_date) FROM headers
    UNION ALL SELECT 'freight', count(*), count(*) - count(freight_cents) FROM headers""",
    ),
    "check_primary_key": _sql(
        SAME_KEY_COPIES,
        select="SELECT product_id, count(*) AS rows FROM copies GROUP BY product_id HAVING count(*) > 1",
    ),
    "check_composite_key": """
    SELECT l_orderkey AS order_id, l_partkey AS product_id, count(*) AS rows
    FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "check_unique": "SELECT p_name AS product_name, count(*) AS rows FROM part GROUP BY p_name HAVING count(*) > 1",
    "check_foreign_keys": """
    SELECT unnest(['product_key', 'customer_key', 'employee_key', 'order_time_key', 'shipping_key']) AS foreign_key,
      CAST(0 AS BIGINT) AS orphan_keys, CAST(0 AS BIGINT) AS orphan_rows
    UNION ALL
    SELECT 'dated_order', count(DISTINCT l_orderkey), count(*)
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'O'""",
    "check_lengths": _sql(
        PLACES,
        select="""
    SELECT 'company_name' AS column_name, 18 AS max_length, CAST(max(length(c_name)) AS INTEGER) AS longest,
      count(*) FILTER (length(c_name) > 18) AS too_long FROM places
    UNION ALL SELECT 'region', 4, CAST(max(length(r_name)) AS INTEGER), count(*) FILTER (length(r_name) > 4) FROM places
    UNION ALL SELECT 'country', 8, CAST(max(length(n_name)) AS INTEGER), count(*) FILTER (length(n_name) > 8) FROM places""",
    ),
    "check_number_ranges": _sql(
        LINES,
        select="""
    SELECT 'unit_price' AS column_name, 'decimal(6,2)' AS type, count(*) FILTER (price_cents >= 1000000) AS misfits
    FROM lines
    UNION ALL SELECT 'quantity', 'decimal(2,0)', count(*) FILTER (quantity >= 100) FROM lines
    UNION ALL SELECT 'discount', 'decimal(5,4)', count(*) FILTER (abs(d) >= 100000) FROM lines""",
    ),
    "profile_domains": _sql(
        HEADERS,
        select="""
    SELECT 'order_id' AS column_name, count(*) AS rows, count(*) - count(order_id) AS nulls,
      CAST(min(order_id) AS DOUBLE) AS min_number, CAST(max(order_id) AS DOUBLE) AS max_number,
      CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM headers
    UNION ALL SELECT 'customer_id', count(*), count(*) - count(customer_id), min(customer_id), max(customer_id),
      NULL, NULL FROM headers
    UNION ALL SELECT 'order_date', count(*), count(*) - count(parsed_date), NULL, NULL,
      CAST(min(parsed_date) AS VARCHAR), CAST(max(parsed_date) AS VARCHAR) FROM headers
    UNION ALL SELECT 'ship_via', count(*), count(*) - count(ship_via), min(ship_via), max(ship_via), NULL, NULL
      FROM headers
    UNION ALL SELECT 'freight', count(*), count(*) - count(freight_cents), CAST(min(freight_cents) AS DOUBLE) / 100,
      CAST(max(freight_cents) AS DOUBLE) / 100, NULL, NULL FROM headers""",
    ),
    "domain_values": _sql(
        PLACES,
        select="""
    SELECT 'region' AS column_name, dirty_region AS value, count(*) AS rows FROM places GROUP BY ALL
    UNION ALL SELECT 'country', n_name, count(*) FROM places GROUP BY ALL""",
    ),
    "column_domains": _sql(
        COPIES,
        select="""
    , sized AS (SELECT * REPLACE (CASE WHEN size <> 7 THEN size END AS size) FROM copies),
    long AS (
      SELECT column_name, value, sort FROM (
        SELECT unnest([
          {'c': 'product_id', 'v': CAST(product_id AS VARCHAR), 's': CAST(product_id AS DOUBLE)},
          {'c': 'product_name', 'v': product_name, 's': NULL}, {'c': 'brand', 'v': brand, 's': NULL},
          {'c': 'category_name', 'v': category_name, 's': NULL}, {'c': 'size', 'v': CAST(size AS VARCHAR), 's': size},
          {'c': 'unit_price', 'v': CAST(CAST(price_cents AS DOUBLE) / 100 AS VARCHAR), 's': price_cents},
          {'c': 'copy', 'v': CAST(copy AS VARCHAR), 's': copy}]) AS x FROM sized),
        LATERAL (SELECT x.c AS column_name, x.v AS value, x.s AS sort) WHERE value IS NOT NULL),
    counted AS (SELECT column_name, value, count(*) AS rows FROM long GROUP BY ALL),
    kinds AS (SELECT column_name, count(*) <= 49 AS short FROM counted GROUP BY column_name)
    SELECT column_name, 'list' AS kind, value, rows, CAST(NULL AS VARCHAR) AS low, CAST(NULL AS VARCHAR) AS high
    FROM counted JOIN kinds USING (column_name) WHERE short
    UNION ALL
    SELECT column_name, 'bounds', NULL, NULL, coalesce(arg_min(value, sort), min(value)), coalesce(arg_max(value, sort), max(value))
    FROM long JOIN kinds USING (column_name) WHERE NOT short GROUP BY column_name
    UNION ALL SELECT 'nothing', 'empty', NULL, NULL, NULL, NULL""",
    ),
    "issue_counts": _sql(
        LINES,
        HEADERS,
        PLACES,
        COPIES,
        select="""
    SELECT 'negative discount' AS issue, count(*) FILTER (dirty_discount < 0) AS rows FROM lines
    UNION ALL SELECT 'empty discount', count(*) FILTER (dirty_discount IS NULL) FROM lines
    UNION ALL SELECT 'duplicate product', count(*) - (SELECT count(*) FROM (
      SELECT DISTINCT product_name, brand, category_name, size, price_cents FROM copies)) FROM copies
    UNION ALL SELECT 'date text', count(*) FILTER (o_orderstatus = 'O') FROM headers
    UNION ALL SELECT 'null text', count(*) FILTER (dirty_region = 'NULL') FROM places""",
    ),
}

_YEAR = "AS freight_allocation, CAST(year(order_date) AS INTEGER) AS order_year"
ORACLES["fact_by_year"] = ORACLES["fact_orders"].replace("AS freight_allocation", _YEAR)

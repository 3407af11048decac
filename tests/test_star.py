"""Star schema and reports on a small warehouse with an edge row for every rule."""

from __future__ import annotations

import datetime
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from starmart.plans import dimensions, reports
from starmart.plans.fact import Dimensions, dropped_lines, fact_lines, fact_orders, line_counts, line_fates

CENT = Decimal("0.01")
FRIDAY, SATURDAY, SUNDAY = (datetime.date(2024, 3, d) for d in (29, 30, 31))
MONDAY = datetime.date(2024, 4, 1)

CATEGORIES = [(1, "Tools"), (2, "Toys")]
PRODUCTS = [
    (10, "Hammer", 1, Decimal("5.00"), False),
    (11, "Kite", 2, Decimal("7.50"), True),
    (12, "Odd", None, None, False),
]
CUSTOMERS = [
    ("AAAAA", "Same Name", "X", None, "CH"),
    ("BBBBB", "Same Name", "Y", "R", "CH"),
    ("CCCCC", "Weekender", "Z", None, "DE"),
    ("DDDDD", "Nowhere", None, None, None),
]
EMPLOYEES = [
    (1, "Ann", "One", "Boss", None),
    (2, "Bob", "Two", "Rep", 1),
    (3, None, "Three", "Rep", 99),
    (4, "Dan", "Four", "Rep", 3),
]
ORDERS = [
    (100, "AAAAA", 1, FRIDAY, 1, Decimal("12.50")),
    (101, "BBBBB", 2, SATURDAY, 2, Decimal("0.01")),
    (102, "CCCCC", 2, SUNDAY, 3, None),
    (103, "CCCCC", 4, MONDAY, 1, Decimal("3.00")),
    (104, "DDDDD", 4, MONDAY, 1, Decimal("3.00")),
    (105, None, 1, FRIDAY, 1, Decimal("1.00")),
    (106, "AAAAA", 9, FRIDAY, 1, Decimal("1.00")),
    (107, "AAAAA", 1, None, 1, Decimal("1.00")),
    (108, "AAAAA", 1, FRIDAY, 7, Decimal("1.00")),
    (109, "AAAAA", 1, FRIDAY, 1, Decimal("1.00")),
]
DETAILS = [
    (100, 10, Decimal("5.00"), 3, Decimal("0")),
    (100, 11, Decimal("7.50"), 2, Decimal("0.15")),
    (100, 99, Decimal("1.00"), 1, Decimal("0")),
    (101, 10, Decimal("5.00"), 1, Decimal("0")),
    (101, 12, Decimal("2.50"), 3, Decimal("0")),
    (102, 11, Decimal("10.00"), 1, Decimal("2.0")),
    (102, 10, Decimal("45.25"), 1, Decimal("0")),
    (103, 10, Decimal("5.00"), 2, Decimal("0")),
    (104, 12, Decimal("1.00"), 7, Decimal("0.05")),
    (105, 10, Decimal("5.00"), 1, Decimal("0")),
    (106, 10, Decimal("5.00"), 1, Decimal("0")),
    (107, 10, Decimal("5.00"), 1, Decimal("0")),
    (108, 10, Decimal("5.00"), 1, Decimal("0")),
    (555, 10, Decimal("5.00"), 1, Decimal("0")),
]


@pytest.fixture(scope="module")
def star(spark):
    tables = {
        "categories": spark.createDataFrame(CATEGORIES, "category_id long, category_name string"),
        "products": spark.createDataFrame(
            PRODUCTS,
            "product_id long, product_name string, category_id long, unit_price decimal(10,2), discontinued boolean",
        ),
        "customers": spark.createDataFrame(
            CUSTOMERS, "customer_id string, company_name string, city string, region string, country string"
        ),
        "employees": spark.createDataFrame(
            EMPLOYEES, "employee_id long, first_name string, last_name string, title string, reports_to long"
        ),
        "orders": spark.createDataFrame(
            ORDERS,
            "order_id long, customer_id string, employee_id long, order_date date, ship_via int, freight decimal(10,2)",
        ),
        "order_details": spark.createDataFrame(
            DETAILS,
            "order_id long, product_id long, unit_price decimal(10,2), quantity int, discount decimal(5,4)",
        ),
    }
    dims = Dimensions(
        product=dimensions.dim_product(tables["products"], tables["categories"]),
        customer=dimensions.dim_customer(tables["customers"]),
        employee=dimensions.dim_employee(tables["employees"]),
        time=dimensions.dim_time(tables["orders"]),
        shipping=dimensions.dim_shipping(spark),
    )
    return tables, dims


def expected_lines():
    """Brute force: the kept lines with their measures."""
    orders = {o[0]: o for o in ORDERS}
    per_order = defaultdict(int)
    for line in DETAILS:
        per_order[line[0]] += 1
    kept = []
    for order_id, product_id, price, quantity, discount in DETAILS:
        order = orders.get(order_id)
        if (
            order is None
            or product_id not in {p[0] for p in PRODUCTS}
            or order[1] not in {c[0] for c in CUSTOMERS}
            or order[2] not in {e[0] for e in EMPLOYEES}
            or order[3] is None
            or order[4] not in (1, 2, 3)
        ):
            continue
        amount = (price * quantity * (1 - discount)).quantize(CENT, ROUND_HALF_UP)
        share = order[5] and (order[5] / per_order[order_id]).quantize(CENT, ROUND_HALF_UP)
        kept.append((order, product_id, amount, share))
    return kept


def test_dimensions(star, rows):
    _, dims = star
    assert [tuple(r) for r in dims.product.orderBy("product_key").collect()] == [
        (1, 10, "Hammer", "Tools", Decimal("5.00"), False),
        (2, 11, "Kite", "Toys", Decimal("7.50"), True),
        (3, 12, "Odd", None, None, False),
    ]
    assert [(r.customer_key, r.customer_id) for r in dims.customer.orderBy("customer_key").collect()] == list(
        enumerate(["AAAAA", "BBBBB", "CCCCC", "DDDDD"], 1)
    )
    assert [(r.full_name, r.reports_to_name) for r in dims.employee.orderBy("employee_key").collect()] == [
        ("Ann One", None), ("Bob Two", "Ann One"), (None, None), ("Dan Four", None),
    ]
    assert [tuple(r) for r in dims.time.orderBy("time_key").collect()] == [
        (1, FRIDAY, "Friday   ", 3, 1, 2024, False),
        (2, SATURDAY, "Saturday ", 3, 1, 2024, True),
        (3, SUNDAY, "Sunday   ", 3, 1, 2024, True),
        (4, MONDAY, "Monday   ", 4, 2, 2024, False),
    ]
    assert [tuple(r) for r in dims.shipping.orderBy("shipping_key").collect()] == [
        (1, 1, "Speedy Express"), (2, 2, "United Package"), (3, 3, "Federal Shipping"),
    ]


@pytest.mark.parametrize("slice_rows", [1, 1_000_000])
def test_fact_lines(star, slice_rows):
    tables, dims = star
    fact = fact_lines(tables["order_details"], tables["orders"], dims, slice_rows=slice_rows)
    product_keys = {r.product_key: r.product_id for r in dims.product.collect()}
    got = sorted((r.order_id, product_keys[r.product_key], r.total_amount, r.freight_allocation) for r in fact.collect())
    assert got == sorted((o[0], p, a, s) for o, p, a, s in expected_lines())


def test_lines_are_counted_before_joins_drop_them(star):
    tables, _ = star
    assert {r.order_id: r.line_count for r in line_counts(tables["order_details"]).collect()}[100] == 3


def test_freight_split_adds_up_but_for_rounding(star):
    tables, dims = star
    fact = fact_lines(tables["order_details"], tables["orders"], dims)
    shares = [r.freight_allocation for r in fact.filter("order_id = 101").collect()]
    assert abs(sum(shares) - Decimal("0.01")) <= Decimal("0.005") * len(shares)


def test_fact_keys(star):
    tables, dims = star
    size = len(expected_lines())
    fact = fact_orders(tables["order_details"], tables["orders"], dims, dense_keys=True)
    assert sorted(r.fact_id for r in fact.collect()) == list(range(1, size + 1))
    loose = fact_orders(tables["order_details"], tables["orders"], dims)
    assert len({r.fact_id for r in loose.collect()}) == size


def test_employee_may_be_named_per_line(star):
    tables, dims = star
    lines = tables["order_details"].join(tables["orders"].select("order_id", "employee_id"), "order_id", "left")
    per_line = fact_lines(lines, tables["orders"].drop("employee_id"), dims)
    assert per_line.count() == len(expected_lines())


@pytest.mark.parametrize("slice_rows", [1, 1_000_000])
def test_every_line_has_a_fate(star, slice_rows):
    tables, dims = star
    fates = line_fates(tables["order_details"], tables["orders"], dims, slice_rows)
    reasons = {(r.order_id, r.product_id): r.reason for r in fates.collect()}
    assert len(reasons) == len(DETAILS)
    assert {k: v for k, v in reasons.items() if v} == {
        (100, 99): "no product",
        (105, 10): "no customer",
        (106, 10): "no employee",
        (107, 10): "no order date",
        (108, 10): "no shipper",
        (555, 10): "no order",
    }
    counts = {r.reason: r.lines for r in dropped_lines(tables["order_details"], tables["orders"], dims).collect()}
    assert sum(counts.values()) == len(DETAILS) and counts["kept"] == len(expected_lines())


@pytest.fixture(scope="module")
def fact(star):
    tables, dims = star
    return fact_orders(tables["order_details"], tables["orders"], dims)


def test_revenue_by_category_quarter(star, fact):
    _, dims = star
    names = {p[0]: dict(CATEGORIES).get(p[2]) for p in PRODUCTS}
    revenue, quarters = defaultdict(Decimal), defaultdict(Decimal)
    for order, product, amount, _ in expected_lines():
        quarter = (order[3].month + 2) // 3
        revenue[names[product], quarter] += amount
        quarters[quarter] += amount
    got = reports.revenue_by_category_quarter(fact, dims.product, dims.time).collect()
    assert {(r.category_name, r.quarter): r.total_revenue for r in got} == revenue
    for r in got:
        share = (revenue[r.category_name, r.quarter] / quarters[r.quarter] * 100).quantize(Decimal("0.1"), ROUND_HALF_UP)
        assert r.pct_of_quarter == share
    assert [r.quarter for r in got] == sorted(r.quarter for r in got)
    for quarter in quarters:
        assert abs(sum(r.pct_of_quarter for r in got if r.quarter == quarter) - 100) <= Decimal("0.3")


def test_top_customers_keeps_equal_names_apart(star, fact):
    _, dims = star
    got = reports.top_customers(fact, dims.customer).collect()
    assert [r.company_name for r in got].count("Same Name") == 2
    assert [r.total_revenue for r in got] == sorted((r.total_revenue for r in got), reverse=True)
    weekender = next(r for r in got if r.company_name == "Weekender")
    assert (weekender.order_count, weekender.total_revenue, weekender.avg_order_value) == (2, Decimal("45.25"), Decimal("22.63"))
    assert len(reports.top_customers(fact, dims.customer, k=2).collect()) == 2


def test_employee_performance(star, fact):
    _, dims = star
    got = {r.employee_name: r for r in reports.employee_performance(fact, dims.employee).collect()}
    assert got["Ann One"].manager_name == "(Top Manager)"
    assert got["Bob Two"].manager_name == "Ann One"
    assert (got["Bob Two"].order_count, got["Bob Two"].total_revenue) == (2, Decimal("47.75"))
    by_revenue = sorted(got.values(), key=lambda r: -r.total_revenue)
    assert [r.revenue_rank for r in by_revenue] == [1, 2, 3]


def test_shipping_analysis(star, fact):
    _, dims = star
    got = {r.shipper_name: r for r in reports.shipping_analysis(fact, dims.shipping).collect()}
    assert (got["United Package"].total_freight, got["United Package"].avg_freight_per_order) == (Decimal("0.02"), Decimal("0.02"))
    assert got["Federal Shipping"].total_freight is None
    assert got["Speedy Express"].order_count == 3


def test_weekend_patterns(star, fact):
    _, dims = star
    got = reports.weekend_patterns(fact, dims.customer, dims.time).collect()
    by_country = {r.country: r for r in got}
    assert (by_country["CH"].weekend_orders, by_country["CH"].weekday_orders, by_country["CH"].weekend_order_pct) == (1, 1, 50)
    assert (by_country["DE"].weekend_orders, by_country["DE"].weekday_orders) == (1, 1)
    assert (by_country[None].weekend_orders, by_country[None].weekend_order_pct) == (0, 0)
    assert sum(r.weekend_revenue + r.weekday_revenue for r in got) == sum(a for *_, a, _ in expected_lines())

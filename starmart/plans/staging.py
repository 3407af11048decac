"""Clean staging tables from the raw source files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.dates import EMPLOYEE_DATE_PATTERN, ORDER_DATE_PATTERN, parse_date
from starmart.functions.numbers import repaired_discount
from starmart.functions.text import normalise, null_token
from starmart.operators.columns import cast, derive, exclude, fill_defaults, rename
from starmart.operators.duplicates import dedupe_first
from starmart.operators.filters import keep_where
from starmart.sources import raw_schemas
from starmart.sources.delimited import SOURCE, scan_delimited

# Text columns in which the source files write a null token.
CUSTOMER_NULL_TEXT = ["Region", "Fax"]
ORDER_NULL_TEXT = ["ShippedDate", "ShipRegion"]
ORDER_DATES = ["OrderDate", "RequiredDate", "ShippedDate"]
ORDER_TEXT = [
    "ShippedDate",
    "ShipName",
    "ShipAddress",
    "ShipCity",
    "ShipRegion",
    "ShipPostalCode",
    "ShipCountry",
]
EMPLOYEE_DATES = ["BirthDate", "HireDate"]
EMPLOYEE_TEXT = [
    "LastName",
    "FirstName",
    "Title",
    "TitleOfCourtesy",
    "Address",
    "City",
    "Region",
    "PostalCode",
    "Country",
    "HomePhone",
    "Photo",
    "Notes",
    "ReportsTo",
    "PhotoPath",
]
# Columns whose text may span lines in the file.
LONG_TEXT_FILES = {"Employees"}


def read_raw(spark: SparkSession, folder: str, file: str, strict: bool = True) -> DataFrame:
    """One of the six source files, ``<folder>/<file>.csv``; products carry their source order."""
    return scan_delimited(
        spark,
        f"{folder}/{file}.csv",
        raw_schemas.struct_of(raw_schemas.FILES[file]),
        strict=strict,
        line_breaks_in_quotes=file in LONG_TEXT_FILES,
        source_order=file == "Products",
    )


def _staged(df: DataFrame, file: str, without: tuple[str, ...] = ()) -> DataFrame:
    names = raw_schemas.FILES[file]
    return rename(df, {n: raw_schemas.snake_case(n) for n in names if n not in without})


def categories(raw: DataFrame) -> DataFrame:
    return _staged(raw, "Categories")


def customers(raw: DataFrame) -> DataFrame:
    return _staged(derive(raw, CUSTOMER_NULL_TEXT, null_token), "Customers")


def products(raw: DataFrame, order: str = SOURCE, last_id: int | None = None) -> DataFrame:
    """Copies of a product under a new id go: of equal rows the first by ``order`` stays.

    With ``last_id`` the rule is the other one in use: ids up to the last good one stay.
    """
    if last_id is not None:
        kept = keep_where(raw, "ProductID", "<=", last_id)
    else:
        compared = [c for c in raw_schemas.PRODUCTS if c != "ProductID"]
        kept = dedupe_first(raw, compared, order)
    return fill_defaults(
        cast(_staged(kept, "Products"), {"discontinued": "boolean"}), {"discontinued": False}
    )


def orders(raw: DataFrame, upper_text: bool = False) -> DataFrame:
    """Null tokens to NULL and three text dates to dates.

    ``upper_text`` normalises all text columns instead of only blanking whole-value tokens.
    """
    clean = derive(raw, ORDER_TEXT, normalise) if upper_text else derive(raw, ORDER_NULL_TEXT, null_token)
    return _staged(derive(clean, ORDER_DATES, lambda c: parse_date(c, ORDER_DATE_PATTERN)), "Orders")


def order_details(raw: DataFrame) -> DataFrame:
    return _staged(derive(raw, ["Discount"], repaired_discount), "OrderDetails")


def employees(raw: DataFrame) -> DataFrame:
    """Text columns lose their null tokens, two text dates become dates, the photo goes."""
    dated = derive(raw, EMPLOYEE_DATES, lambda c: parse_date(c, EMPLOYEE_DATE_PATTERN))
    clean = derive(dated, EMPLOYEE_TEXT, null_token)
    return cast(_staged(exclude(clean, ["Photo"]), "Employees", without=("Photo",)), {"reports_to": "long"})


def employees_with_normalised_text(raw: DataFrame, suffix: str = "_transformed") -> DataFrame:
    """Employees as read, dates parsed, with a normalised copy of every text column appended."""
    dated = derive(raw, EMPLOYEE_DATES, lambda c: parse_date(c, EMPLOYEE_DATE_PATTERN))
    return derive(dated, EMPLOYEE_TEXT, normalise, suffix)


CLEAN = {
    "categories": ("Categories", categories),
    "customers": ("Customers", customers),
    "products": ("Products", products),
    "orders": ("Orders", orders),
    "order_details": ("OrderDetails", order_details),
    "employees": ("Employees", employees),
}


def staging_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All six staging tables from a folder of source files."""
    return {table: clean(read_raw(spark, folder, file)) for table, (file, clean) in CLEAN.items()}

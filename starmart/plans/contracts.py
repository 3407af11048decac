"""What a table must hold before it is published: a key that occurs once, columns without NULL, texts that are not too
long and numbers that fit their type."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.checks import REFUSED, WRITTEN, at_most, fits, key_breaches, write_status


class RefusedRows(ValueError):
    """A table breaks its contract; nothing was published."""


@dataclass(frozen=True)
class Contract:
    key: list[str]
    required: list[str] = field(default_factory=list)
    #: Whether the key is checked; counting the lines by key shuffles the largest table.
    check_key: bool = True
    #: The longest text of a column, in characters; only columns that are text are held to it.
    lengths: dict[str, int] = field(default_factory=dict)
    #: The type that a column's numbers must fit; columns that have this type already fit it.
    types: dict[str, str] = field(default_factory=dict)

    def columns(self, df: DataFrame) -> list[str]:
        """The columns without NULL that the frame has; the key always counts."""
        return list(dict.fromkeys([*self.key, *[c for c in self.required if c in df.columns]]))

    def rules(self, df: DataFrame) -> dict[str, Column]:
        """What a row must meet by itself, by the name of the breach; of columns that the frame has."""
        kinds = {f.name: f.dataType for f in df.schema.fields}
        rules = {f"no {c}": F.col(c).isNotNull() for c in self.columns(df)}
        for c, most in self.lengths.items():
            if isinstance(kinds.get(c), T.StringType):
                rules[f"{c} too long"] = at_most(c, most)
        for c, kind in self.types.items():
            if c in kinds and kinds[c].simpleString() != kind:
                rules[f"{c} out of range"] = fits(c, kind)
        return rules


def with_lengths(contract: Contract, **lengths: int) -> Contract:
    """The contract with other widths of these text columns."""
    return replace(contract, lengths=contract.lengths | lengths)


# Keys, columns that may not be NULL, and the widths of text columns.
_PLACE = {"address": 200, "city": 100, "region": 100, "postal_code": 20, "country": 100}
STAGING = {
    "categories": Contract(["category_id"], ["category_name"], lengths={"category_name": 50}),
    "customers": Contract(
        ["customer_id"],
        ["company_name"],
        lengths={"customer_id": 5, "company_name": 100, "contact_name": 100, "contact_title": 100, **_PLACE, "phone": 30, "fax": 30},
    ),
    "products": Contract(
        ["product_id"],
        ["product_name", "discontinued"],
        lengths={"product_name": 100, "quantity_per_unit": 50},
        types={"unit_price": "decimal(10,2)"},
    ),
    "orders": Contract(
        ["order_id"],
        lengths={"customer_id": 5, "ship_name": 100, **{f"ship_{c}": n for c, n in _PLACE.items()}},
        types={"freight": "decimal(10,2)"},
    ),
    "order_details": Contract(
        ["order_id", "product_id"],
        ["unit_price", "quantity", "discount"],
        check_key=False,
        types={"unit_price": "decimal(10,2)", "discount": "decimal(5,4)"},
    ),
    "employees": Contract(
        ["employee_id"],
        ["last_name", "first_name"],
        lengths={"last_name": 50, "first_name": 50, "title": 100, "title_of_courtesy": 10, **_PLACE}
        | {"home_phone": 30, "extension": 10, "photo_path": 255},
    ),
}
DATAMART = {
    "dim_product": Contract(["product_id"], ["product_key", "product_name"], lengths={"product_name": 100, "category_name": 50}),
    "dim_customer": Contract(
        ["customer_id"], ["customer_key", "company_name"], lengths={"company_name": 100, "city": 100, "region": 100, "country": 100}
    ),
    # First name, blank and last name may be one longer than the declared 100, and are kept.
    "dim_employee": Contract(["employee_id"], ["employee_key"], lengths={"full_name": 101, "title": 100, "reports_to_name": 101}),
    "dim_time": Contract(["date"], ["time_key"], lengths={"day_name": 10}),
    "dim_shipping": Contract(["ship_via_id"], ["shipping_key", "shipper_name"], lengths={"shipper_name": 100}),
    "fact_orders": Contract(
        ["fact_id"],
        ["product_key", "customer_key", "employee_key", "order_time_key", "shipping_key", "order_id"]
        + ["unit_price", "quantity", "discount", "total_amount"],
        check_key=False,  # the numbers are unique by the way they are made
    ),
}


def breaches(df: DataFrame, contract: Contract) -> dict[str, int]:
    """Rows that break each of the contract's rules on single rows, all rules in one pass; rules that hold are left out."""
    rules = contract.rules(df)
    counts = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"_{i}") for i, rule in enumerate(rules.values())]).first()
    return {name: counts[i] for i, name in enumerate(rules) if counts[i]}


def require(df: DataFrame, contract: Contract, name: str, check_key: bool | None = None) -> None:
    """Raise ``RefusedRows`` if the rows break the contract."""
    broken = breaches(df, contract)
    repeated = 0
    if contract.check_key if check_key is None else check_key:
        repeated = key_breaches(df.dropna(subset=contract.key).select(*contract.key), contract.key).count()
    if broken or repeated:
        raise RefusedRows(f"{name}: {broken or 'no broken rows'}, {repeated} repeated keys {contract.key}")


def divide(df: DataFrame, contract: Contract, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the contract, and the refused ones with their ``write_error``.

    Of rows with one key the first by ``order`` (else by content) is written.
    """
    marked = write_status(df, contract.rules(df), unique=contract.key, order=order or contract.key[0])
    good = marked.filter(F.col("write_status") == WRITTEN).select(*df.columns)
    return good, marked.filter(F.col("write_status") == REFUSED).select(*df.columns, "write_error")

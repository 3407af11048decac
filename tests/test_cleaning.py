"""Text, date, number and column operators on edge rows."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starmart.functions import dates, numbers, text
from starmart.operators import columns, filters


def values(spark, kind, items, expression):
    """The expression for each item, in order."""
    df = spark.createDataFrame(list(enumerate(items)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_null_token_takes_whole_values_only(spark):
    items = ["NULL", "null", " NULL ", "", None, "NULLABLE", "xNULLx"]
    assert values(spark, "string", items, text.null_token) == [
        None, "null", " NULL ", None, None, "NULLABLE", "xNULLx",
    ]
    assert values(spark, "string", items, text.blank_token) == [
        "", "null", " NULL ", "", None, "NULLABLE", "xNULLx",
    ]


def test_normalise_removes_the_token_anywhere(spark):
    items = ["NULL", "null", " NULL ", "", None, "Nullarbor", "xNULLx", "\t a\n", "Táchira", "Straße", "nunullll"]
    assert values(spark, "string", items, text.normalise) == [
        None, None, None, None, None, "ARBOR", "XX", "A", "TÁCHIRA", "STRASSE", "NULL",
    ]
    assert values(spark, "int", [5, None], text.normalise) == ["5", None]


def test_normalise_is_idempotent_on_its_results(spark):
    items = ["a b", " NULL x", "Süd"]
    assert values(spark, "string", items, lambda c: text.normalise(text.normalise(c))) == values(
        spark, "string", items, text.normalise
    )


def test_joined_name_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B"), ("A", None)], "f string, l string")
    got = [r[0] for r in df.select(text.joined_name(F.col("f"), F.col("l"))).collect()]
    assert got == ["A B", None, None]


def test_repaired_discount(spark):
    items = [None, Decimal("-0.25"), Decimal("0"), Decimal("0.15"), Decimal("1"), Decimal("2.0")]
    expected = [0, Decimal("0.25"), 0, Decimal("0.15"), 1, 2]
    assert values(spark, "decimal(5,4)", items, numbers.repaired_discount) == expected
    twice = lambda c: numbers.repaired_discount(numbers.repaired_discount(c))
    assert values(spark, "decimal(5,4)", items, twice) == expected


def test_first_match_fails_on_an_unmatched_row(spark):
    rules = lambda c: filters.first_match([(c < 0, F.lit("low")), (c == 0, F.lit("zero"))])
    assert values(spark, "int", [-1, 0], rules) == ["low", "zero"]
    with pytest.raises(PySparkException):
        values(spark, "int", [1], rules)
    lenient = lambda c: filters.first_match([(c < 0, F.lit("low"))], F.lit("other"))
    assert values(spark, "int", [1, None], lenient) == ["other", "other"]


def test_parse_date(spark):
    items = ["07-04-1996", "13-01-1996", "7-4-1996", "NULL", "", None, "02-29-1996", "02-29-1997"]
    month_first = values(spark, "string", items, lambda c: dates.parse_date(c, "MM-dd-yyyy"))
    assert month_first == [
        datetime.date(1996, 7, 4), None, None, None, None, None, datetime.date(1996, 2, 29), None,
    ]
    day_first = values(spark, "string", items[:2], lambda c: dates.parse_date(c, "dd-MM-yyyy"))
    assert day_first == [datetime.date(1996, 4, 7), datetime.date(1996, 1, 13)]
    with pytest.raises(PySparkException):
        values(spark, "string", ["NULL"], lambda c: dates.parse_date(c, "MM-dd-yyyy", strict=True))


def test_weekdays(spark):
    week = [datetime.date(2024, 1, d) for d in range(5, 9)]  # Friday to Monday
    assert values(spark, "date", week, dates.is_weekend) == [False, True, True, False]
    assert values(spark, "date", week, dates.day_number) == [5, 6, 0, 1]
    assert values(spark, "date", week, dates.day_name) == ["Friday   ", "Saturday ", "Sunday   ", "Monday   "]
    unpadded = values(spark, "date", week, lambda c: dates.day_name(c, padded=False))
    assert unpadded == ["Friday", "Saturday", "Sunday", "Monday"]


def test_line_amount_and_freight_share(spark):
    df = spark.createDataFrame(
        [(Decimal("10.00"), 3, Decimal("0")), (Decimal("9.99"), 1, Decimal("0.15")), (Decimal("5.00"), 2, Decimal("2.0"))],
        "p decimal(10,2), q int, d decimal(5,4)",
    )
    amounts = [r[0] for r in df.select(numbers.line_amount(F.col("p"), F.col("q"), F.col("d"))).collect()]
    assert amounts == [Decimal("30.00"), Decimal("8.49"), Decimal("-10.00")]
    df = spark.createDataFrame(
        [(Decimal("12.50"), 3), (Decimal("0.01"), 2), (None, 2)], "f decimal(10,2), n long"
    )
    shares = [r[0] for r in df.select(numbers.freight_share(F.col("f"), F.col("n"))).collect()]
    assert shares == [Decimal("4.17"), Decimal("0.01"), None]


def test_ratio_guards_zero_and_rounds_away_from_zero(spark):
    df = spark.createDataFrame(
        [(Decimal("5.00"), Decimal("2.00")), (Decimal("-5.00"), Decimal("2.00")), (Decimal("1.00"), Decimal("0.00"))],
        "a decimal(12,2), b decimal(12,2)",
    )
    got = [r[0] for r in df.select(numbers.ratio(F.col("a"), F.col("b"), 0)).collect()]
    assert got == [3, -3, None]


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert columns.exclude(df, ["a", "missing"]).columns == ["b", "c"]
    assert columns.include(df, ["c", "a"]).columns == ["c", "a"]
    assert columns.rename(df, {"b": "x", "a": "y"}).columns == ["x", "y"]
    assert columns.derive(df, ["a"], lambda c: c + 1).first().a == 2
    assert columns.derive(df, ["a"], lambda c: c + 1, "_next").columns == ["a", "b", "c", "a_next"]


def test_cast_strict_and_lenient(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    assert [r.a for r in columns.cast(df, {"a": "int"}, strict=False).collect()] == [1, None]
    with pytest.raises(PySparkException):
        columns.cast(df, {"a": "int"}).collect()
    flags = spark.createDataFrame([(0,), (1,), (None,)], "a int")
    typed = columns.fill_defaults(columns.cast(flags, {"a": "boolean"}), {"a": False})
    assert [r.a for r in typed.collect()] == [False, True, False]


def test_row_filters(spark):
    df = spark.createDataFrame([(76,), (77,), (78,), (None,)], "id int")
    assert [r.id for r in filters.keep_where(df, "id", "<=", 77).collect()] == [76, 77]
    assert filters.keep_present(df, "id").count() == 3

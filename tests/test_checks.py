"""Each check finds one breach of each rule and nothing in a clean table."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators import checks

SCHEMA = "id int, part int, name string, price decimal(10,2), day date"
CLEAN = [(1, 1, "ab", Decimal("1.00"), datetime.date(2024, 1, 1)), (1, 2, "cd", Decimal("2.00"), None)]
BAD = [*CLEAN, (1, 2, "too long", Decimal("12345.00"), None), (None, 3, None, None, None)]


@pytest.fixture
def clean(spark):
    return spark.createDataFrame(CLEAN, SCHEMA)


@pytest.fixture
def bad(spark):
    return spark.createDataFrame(BAD, SCHEMA)


def test_null_counts(clean, bad, rows):
    assert rows(checks.null_counts(clean, ["id", "name"])) == [("id", 2, 0), ("name", 2, 0)]
    assert rows(checks.null_counts(bad, ["id", "day"])) == [("day", 4, 3), ("id", 4, 1)]
    assert rows(checks.null_counts(bad.limit(0), ["id"])) == [("id", 0, 0)]


def test_key_breaches(clean, bad, rows):
    assert rows(checks.key_breaches(clean, ["id", "part"])) == []
    assert rows(checks.key_breaches(bad, ["id", "part"])) == [(None, 3, 1), (1, 2, 2)]
    assert rows(checks.key_breaches(bad, ["name"])) == [(None, 1)]


def test_orphans(spark, clean, bad, rows):
    parent = spark.createDataFrame([(1,), (2,)], "key int")
    assert rows(checks.orphans(clean, "part", parent, "key")) == []
    assert rows(checks.orphans(bad, "part", parent, "key")) == [(3, 1)]
    counted = checks.orphan_counts({"a": (bad, "part", parent, "key"), "b": (bad, "id", parent, "key")})
    assert rows(counted) == [("a", 1, 1), ("b", 0, 0)]


def test_lengths_and_ranges(clean, bad, rows):
    assert rows(checks.length_breaches(clean, {"name": 2})) == [("name", 2, 2, 0)]
    assert rows(checks.length_breaches(bad, {"name": 2})) == [("name", 2, 8, 1)]
    assert rows(checks.cast_breaches(clean, {"price": "decimal(6,2)"})) == [("price", "decimal(6,2)", 0)]
    assert rows(checks.cast_breaches(bad, {"price": "decimal(6,2)"})) == [("price", "decimal(6,2)", 1)]


def test_profile(bad, rows):
    assert rows(checks.profile(bad)) == [
        ("day", 4, 3, None, None, "2024-01-01", "2024-01-01"),
        ("id", 4, 1, 1.0, 1.0, None, None),
        ("name", 4, 1, None, None, "ab", "too long"),
        ("part", 4, 0, 1.0, 3.0, None, None),
        ("price", 4, 1, 1.0, 12345.0, None, None),
    ]
    assert rows(checks.domain_values(bad, ["name"])) == [("name", "ab", 1), ("name", "cd", 1), ("name", "too long", 1)]


def test_issue_counts(clean, bad, rows):
    issues = {
        "no name": (bad, F.col("name").isNull()),
        "dear": (bad, F.col("price") > 100),
        "clean": (clean, F.col("name").isNull()),
    }
    assert rows(checks.issue_counts(issues)) == [("clean", 0), ("dear", 1), ("no name", 1)]


def test_write_status(clean, bad):
    rules = {"no id": F.col("id").isNotNull(), "name": checks.at_most("name", 2), "price": checks.fits("price", "decimal(6,2)")}
    assert {(r.write_status, r.write_error) for r in checks.write_status(clean, rules).collect()} == {(1, None)}
    ordered = bad.withColumn("n", F.coalesce(F.length("name"), F.lit(0)))
    status = checks.write_status(ordered, rules, unique=["id", "part"], order="n").collect()
    assert {(r.id, r.part, r.name): (r.write_status, r.write_error) for r in status} == {
        (1, 1, "ab"): (1, None),
        (1, 2, "cd"): (1, None),
        (1, 2, "too long"): (0, "name; price; duplicate key"),
        (None, 3, None): (0, "no id"),
    }

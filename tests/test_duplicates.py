"""Keep-first and flagging of equal rows."""

from __future__ import annotations

import random

from starmart.operators.duplicates import dedupe_first, flag_duplicates

SCHEMA = "id long, name string, price int, note string"
ROWS = [
    (1, "a", 1, "x"),
    (2, "b", None, "x"),
    (3, "c", 3, "x"),
    (7, "a", 1, "y"),
    (8, "b", None, "y"),
    (9, "a", 1, "z"),
    (10, "c", 4, "z"),
    (11, None, None, "z"),
    (12, None, None, "z"),
]


def test_first_row_of_each_group_stays(spark, rows):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    kept = dedupe_first(df, ["name", "price"], "id")
    assert kept.columns == df.columns
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3, 10, 11]
    assert {r.id: r.note for r in kept.collect()}[1] == "x"
    again = dedupe_first(kept, ["name", "price"], "id")
    assert rows(again) == rows(kept)


def test_key_only_groups(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).drop("note")
    assert sorted(r.id for r in dedupe_first(df, ["name", "price"], "id").collect()) == [1, 2, 3, 10, 11]


def test_flags(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    flagged = flag_duplicates(df, ["name", "price"], "id", chosen="first_id").collect()
    assert {r.id: (r.duplicate_status, r.first_id) for r in flagged} == {
        1: ("chosen", 1),
        7: ("duplicate", 1),
        9: ("duplicate", 1),
        2: ("chosen", 2),
        8: ("duplicate", 2),
        3: ("unique", None),
        10: ("unique", None),
        11: ("chosen", 11),
        12: ("duplicate", 11),
    }


def test_one_group_holds_most_rows(spark):
    data = [(i, "hot" if random.Random(i).random() < 0.7 else str(i % 50), 0, "n") for i in range(5000)]
    df = spark.createDataFrame(data, SCHEMA).repartition(16)
    first: dict[str, int] = {}
    for i, name, *_ in data:
        first.setdefault(name, i)
    assert {r.name: r.id for r in dedupe_first(df, ["name", "price"], "id").collect()} == first
    flagged = flag_duplicates(df, ["name", "price"], "id").collect()
    assert sum(r.duplicate_status == "duplicate" for r in flagged) == 5000 - len(first)


def test_null_order_comes_last_and_loses_nothing(spark):
    data = [(None, "a", 1, "x"), (None, "a", 1, "b"), (5, "b", 1, "y"), (None, "b", 1, "a")]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    kept = {r.name: (r.id, r.note) for r in dedupe_first(df, ["name", "price"], "id").collect()}
    assert kept == {"a": (None, "b"), "b": (5, "y")}
    flagged = sorted((r.name, r.note, r.duplicate_status) for r in flag_duplicates(df, ["name", "price"], "id").collect())
    assert flagged == [("a", "b", "chosen"), ("a", "x", "duplicate"), ("b", "a", "duplicate"), ("b", "y", "chosen")]


def test_one_of_exact_copies_is_chosen(spark):
    df = spark.createDataFrame([(1, "a", 1, "x")] * 5 + [(1, "a", 1, "w"), (2, "z", 1, "x")], SCHEMA).repartition(4)
    flagged = sorted((r.name, r.note, r.duplicate_status) for r in flag_duplicates(df, ["name", "price"], "id").collect())
    assert flagged == [("a", "w", "chosen")] + [("a", "x", "duplicate")] * 5 + [("z", "x", "unique")]
    copies = spark.createDataFrame([(1, "a", 1, "x")] * 5, SCHEMA).repartition(4)
    marks = [r.duplicate_status for r in flag_duplicates(copies, ["name", "price"], "id").collect()]
    assert sorted(marks) == ["chosen"] + ["duplicate"] * 4


def test_a_large_group_meets_its_first_row_in_slices(spark):
    df = spark.createDataFrame([(i, "hot", 0, f"n{i}") for i in range(3000)], SCHEMA).repartition(8)
    flagged = flag_duplicates(df, ["name", "price"], "id", slice_rows=100).collect()
    assert {r.id for r in flagged if r.duplicate_status == "chosen"} == {0} and len(flagged) == 3000


def test_order_among_the_compared_columns(spark, rows):
    df = spark.createDataFrame([(1, "a", 1, "x"), (1, "a", 1, "x"), (2, "a", 1, "x")], SCHEMA)
    assert rows(dedupe_first(df, ["id", "name"], "id")) == [(1, "a", 1, "x"), (2, "a", 1, "x")]

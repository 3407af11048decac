"""Table sets behind one pointer, and batches that are admitted to them."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.plans.admission import Outcome, admit_batch, refused_name
from starmart.plans.contracts import Contract
from starmart.session import scratch_path
from starmart.sources import manifest
from starmart.sources.manifest import Conflict, TableSet

RULES = Contract(["id"], ["name"], lengths={"name": 4}, types={"price": "decimal(4,2)"})
SCHEMA = "id long, name string, price decimal(10,2), nth int"


@pytest.fixture
def tables(spark):
    return TableSet(spark, scratch_path(spark, "set"))


def frame(spark, rows):
    return spark.createDataFrame([(i, n, None if p is None else Decimal(p), k) for i, n, p, k in rows], SCHEMA)


def ids(df):
    return sorted((r.id for r in df.collect()), key=str)


def errors(tables):
    return sorted((r.batch, str(r.id), r.nth, r.write_error) for r in tables.read(refused_name("t")).collect())


FIRST = [(1, "a", "1", 1), (2, "b", None, 1), (2, "c", "1", 2), (3, None, "1", 1)]


def test_a_batch_meets_the_rows_of_earlier_ones(spark, tables):
    assert admit_batch(tables, "t", frame(spark, FIRST), "one", RULES, "nth") == Outcome(2, 2)
    second = [(2, "again", "1", 1), (4, "fine", "99.99", 1), (5, "dear", "100", 1), (None, "none", "1", 1), (6, "six", None, 2), (6, "sex", None, 1)]
    assert admit_batch(tables, "t", frame(spark, second), "two", RULES, "nth") == Outcome(2, 4)
    assert ids(tables.read("t")) == [1, 2, 4, 6]
    assert {r.id: r.name for r in tables.read("t").collect()}[6] == "sex"
    assert errors(tables) == [
        ("one", "2", 2, "duplicate key"),
        ("one", "3", 1, "no name"),
        ("two", "2", 1, "name too long; key exists"),
        ("two", "5", 1, "price out of range"),
        ("two", "6", 2, "duplicate key"),
        ("two", "None", 1, "no id"),
    ]


def test_the_same_batch_twice_adds_nothing(spark, tables):
    for again in (False, True, True):
        assert admit_batch(tables, "t", frame(spark, FIRST), "one", RULES, "nth") == Outcome(2, 2, again)
    assert ids(tables.read("t")) == [1, 2] and len(errors(tables)) == 2
    assert tables.state().number == 1
    # Rows that come again in a batch of another name are refused one by one.
    assert admit_batch(tables, "t", frame(spark, FIRST[:2]), "other", RULES, "nth") == Outcome(0, 2)


def test_empty_batches_and_batches_without_good_rows(spark, tables):
    assert admit_batch(tables, "t", frame(spark, FIRST).limit(0), "none", RULES) == Outcome(0, 0)
    assert ids(tables.read("t")) == [] and tables.read("t").columns == ["id", "name", "price", "nth"]
    assert admit_batch(tables, "t", frame(spark, FIRST[3:]), "bad", RULES) == Outcome(0, 1)
    assert ids(tables.read("t")) == [] and set(tables.state().tables["t"].batches) == {"none", "bad"}
    with pytest.raises(ValueError, match="columns"):
        admit_batch(tables, "t", frame(spark, FIRST).drop("nth"), "less", RULES)


def test_a_key_with_most_of_the_rows(spark, tables):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("id"), F.lit("n").alias("name"))
    rows = rows.withColumns({"price": F.lit(None).cast("decimal(10,2)"), "nth": F.pmod(F.monotonically_increasing_id(), F.lit(1 << 30)).cast("int")})
    assert admit_batch(tables, "t", rows, "one", RULES, "nth") == Outcome(1001, 1999)
    assert admit_batch(tables, "t", rows, "two", RULES, "nth") == Outcome(0, 3000)


def test_another_writer_commits_in_between(spark, tables, monkeypatch):
    admit_batch(tables, "t", frame(spark, FIRST), "one", RULES, "nth")
    other, staged = TableSet(spark, tables.location), tables.stage
    rivals = [[(4, "riva", None, 1)]]

    def slow(df, table, by=None):
        if rivals:
            admit_batch(other, "t", frame(spark, rivals.pop()), "rival", RULES, "nth")
        return staged(df, table, by)

    monkeypatch.setattr(tables, "stage", slow)
    assert admit_batch(tables, "t", frame(spark, [(4, "mine", None, 1), (5, "mine", None, 1)]), "mine", RULES, "nth") == Outcome(1, 1)
    assert {r.id: r.name for r in tables.read("t").collect()} == {1: "a", 2: "b", 4: "riva", 5: "mine"}
    assert set(tables.state().tables["t"].batches) == {"one", "rival", "mine"}


class Killed(BaseException):
    pass


STEPS = ["stage", "_put", "_rename"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("done", [False, True])
def test_a_kill_at_any_step_leaves_the_old_set_or_the_new(spark, tables, monkeypatch, step, done):
    old = {name: spark.range(5).withColumn("of", F.lit(name)) for name in ("a", "b")}
    new = {name: spark.range(8).withColumn("of", F.lit(name)) for name in ("a", "b")}
    before = tables.replace(old)
    real, calls = getattr(TableSet, step), []

    def dying(self, *args, **kw):
        calls.append(1)
        if done:
            real(self, *args, **kw)
        raise Killed

    monkeypatch.setattr(TableSet, step, dying)
    with pytest.raises(Killed):
        tables.replace(new)
    monkeypatch.undo()
    after = TableSet(spark, tables.location)
    sizes = {name: after.read(name, after.state()).count() for name in ("a", "b")}
    assert sizes == ({"a": 8, "b": 8} if step == "_rename" and done else {"a": 5, "b": 5}) and calls
    assert {name: after.read(name, before).count() for name in ("a", "b")} == {"a": 5, "b": 5}
    left = after.leftovers(0)
    assert bool(left) == (not (step == "_rename" and done) and (step != "stage" or done))
    assert after.remove_leftovers(0) == left and not after.leftovers(0)
    after.replace(new)
    assert {name: after.read(name).count() for name in ("a", "b")} == {"a": 8, "b": 8}


@pytest.mark.parametrize("step", STEPS)
def test_a_batch_that_died_is_admitted_once_when_it_comes_again(spark, tables, monkeypatch, step):
    real = getattr(TableSet, step)

    def dying(self, *args, **kw):
        real(self, *args, **kw)
        raise Killed

    monkeypatch.setattr(TableSet, step, dying)
    with pytest.raises(Killed):
        admit_batch(tables, "t", frame(spark, FIRST), "one", RULES, "nth")
    monkeypatch.undo()
    assert admit_batch(tables, "t", frame(spark, FIRST), "one", RULES, "nth") == Outcome(2, 2, step == "_rename")
    assert ids(tables.read("t")) == [1, 2]


def test_a_taken_number_is_a_conflict(spark, tables):
    base = tables.state()
    tables.replace({"a": spark.range(3)})
    with pytest.raises(Conflict):
        tables.commit(base, {})
    assert tables.state().number == 1 and not [p for p in tables.leftovers(0) if "_manifests" in p]


def test_compact_and_remove_old(spark, tables):
    for n in range(3):
        admit_batch(tables, "t", frame(spark, [(n, "n", None, 1)]), str(n), RULES)
    first = tables.state(1)
    tables.compact("t")
    state = tables.state()
    assert len(state.tables["t"].parts) == 1 and ids(tables.read("t")) == [0, 1, 2] and set(state.tables["t"].batches) == {"0", "1", "2"}
    assert ids(tables.read("t", first)) == [0]
    assert len(tables.remove_old()) == 3
    assert ids(tables.read("t")) == [0, 1, 2] and tables.state().number == state.number
    assert admit_batch(tables, "t", frame(spark, [(9, "n", None, 1)]), "1", RULES).again
    assert manifest.State(0) == TableSet(spark, scratch_path(spark, "nothing")).state()

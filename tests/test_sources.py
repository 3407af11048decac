"""Delimited files and warehouse tables on edge rows."""

from __future__ import annotations

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.driver.marts import new_namespace
from starmart.session import scratch_path
from starmart.sources import tables
from starmart.sources.delimited import CORRUPT, SOURCE, infer_schema, scan_delimited, write_delimited
from starmart.sources.raw_schemas import FILES, snake_case, struct_of

FAILURE = (PySparkException, Py4JError)
SCHEMA = struct_of({"Id": "int", "Name": "string", "Price": "decimal(10,2)"})


def write(tmp_path, *lines, name="f.csv"):
    path = tmp_path / name
    path.write_bytes("\n".join(lines).encode("latin-1") + b"\n")
    return str(path)


def test_dialect(spark, tmp_path, rows):
    path = write(
        tmp_path,
        "Id;Name;Price",
        "1;Táchira;1.5",
        '2;"a;b";2',
        '3;"say ""hi""";3',
        "#4;comment;4",
        '5;"  blanks  "; 5.25 ',
        '6;"";',
        "7;;7",
    )
    got = rows(scan_delimited(spark, path, SCHEMA))
    assert [(i, n, None if p is None else float(p)) for i, n, p in got] == [
        (1, "Táchira", 1.5),
        (2, "a;b", 2.0),
        (3, 'say "hi"', 3.0),
        (5, "blanks", 5.25),
        (6, None, None),
        (7, None, 7.0),
    ]


@pytest.mark.parametrize("line", ["2;short", "x;text;1", "2;text;1;more", "2;text;many"])
def test_bad_rows_fail_a_strict_scan_and_are_kept_by_a_lenient_one(spark, tmp_path, line):
    path = write(tmp_path, "Id;Name;Price", "1;good;1", line)
    with pytest.raises(FAILURE):
        scan_delimited(spark, path, SCHEMA).collect()
    read = scan_delimited(spark, path, SCHEMA, strict=False).collect()
    assert sorted(r[CORRUPT] or "" for r in read) == ["", line]


def test_a_short_row_fails_whichever_column_is_read(spark, tmp_path):
    path = write(tmp_path, "Id;Name;Price", "1;good;1", "2;short")
    with pytest.raises(FAILURE):
        scan_delimited(spark, path, SCHEMA).select("Id").collect()


def test_other_header_fails(spark, tmp_path):
    path = write(tmp_path, "Id;Title;Price", "1;good;1")
    with pytest.raises(FAILURE):
        scan_delimited(spark, path, SCHEMA).collect()


def test_line_breaks_in_quotes(spark, tmp_path):
    path = write(tmp_path, "Id;Name;Price", '1;"two', 'lines";1')
    with pytest.raises(FAILURE):
        scan_delimited(spark, path, SCHEMA).collect()
    assert scan_delimited(spark, path, SCHEMA, line_breaks_in_quotes=True).first().Name == "two\nlines"


def test_source_order_and_row_range(spark, tmp_path):
    lines = [f"{i};n{i};{i}" for i in range(5000, 0, -1)]
    path = write(tmp_path, "Id;Name;Price", *lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        read = scan_delimited(spark, path, SCHEMA, source_order=True)
        assert read.rdd.getNumPartitions() > 4
        assert [r.Id for r in read.orderBy(SOURCE).collect()] == list(range(5000, 0, -1))
        part = scan_delimited(spark, path, SCHEMA, skip_rows=3, max_rows=4)
        assert sorted(r.Id for r in part.collect()) == [4994, 4995, 4996, 4997]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_inferred_types(spark, tmp_path):
    path = write(tmp_path, "a;b;c;d;e;f;g", "1;1;1.5;x;;1d;1", "2;5000000000;2e3;1;;2;NaN", ";;;;;;")
    assert [f.dataType for f in infer_schema(spark, path).fields] == [
        T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.StringType(), T.StringType(), T.StringType(),
    ]
    late = write(tmp_path, "a", *["1"] * 20_000, "x", name="g.csv")
    assert infer_schema(spark, late).fields[0].dataType == T.StringType()
    assert infer_schema(spark, late, rows=50).fields[0].dataType == T.IntegerType()


@pytest.mark.parametrize("text", ["14,00", "1,5", "1,234.5", "1.5x", "--1", "many"])
def test_a_number_with_a_comma_is_no_number(spark, tmp_path, text):
    path = write(tmp_path, "Id;Name;Price", "1;good;1.5", f"2;bad;{text}")
    with pytest.raises(FAILURE):
        scan_delimited(spark, path, SCHEMA).collect()
    assert [r.Id for r in scan_delimited(spark, path, SCHEMA).select("Id").orderBy("Id").collect()] == [1, 2]
    read = {r.Id: r for r in scan_delimited(spark, path, SCHEMA, strict=False).collect()}
    assert read[1][CORRUPT] is None and read[2][CORRUPT] == f"2;bad;{text}" and read[2].Price is None


@pytest.mark.parametrize("text, value", [("+1.5", 1.5), ("-2", -2.0), (" 3.25 ", 3.25), ("1e2", 100.0), (".5", 0.5)])
def test_numbers(spark, tmp_path, text, value):
    path = write(tmp_path, "Id;Name;Price", f"1;x;{text}")
    assert float(scan_delimited(spark, path, SCHEMA).first().Price) == value


def test_a_blank_line_fails_a_strict_scan(spark, tmp_path):
    path = write(tmp_path, "Id;Name;Price", "1;a;1", "", "2;b;2")
    with pytest.raises(FAILURE):
        scan_delimited(spark, path, SCHEMA).count()
    assert scan_delimited(spark, path, SCHEMA, strict=False).count() == 2


def test_written_file_reads_back(spark, rows):
    df = spark.createDataFrame([(1, 'a;"b"', 1.5), (2, None, None), (3, "Süd", 0.0)], "Id int, Name string, Price double")
    df = df.withColumn("Price", F.col("Price").cast("decimal(10,2)"))
    path = scratch_path(spark, "test")
    write_delimited(df, path)
    assert rows(scan_delimited(spark, path, SCHEMA)) == rows(df)


def test_names():
    assert [snake_case(n) for n in ("CategoryID", "ShipVia", "ReportsTo", "Fax")] == [
        "category_id", "ship_via", "reports_to", "fax",
    ]
    assert all(struct_of(columns).names == list(columns) for columns in FILES.values())


def test_replace_table_from_itself(spark, rows):
    name = f"{new_namespace(spark, 'test')}.t"
    tables.replace_table(spark.range(10), name)
    tables.replace_table(tables.scan_table(spark, name).filter("id < 3"), name)
    assert rows(tables.scan_table(spark, name)) == [(0,), (1,), (2,)]


def test_failed_refresh_leaves_the_table(spark, rows):
    name = f"{new_namespace(spark, 'test')}.t"
    tables.replace_table(spark.range(3), name)
    bad = tables.scan_table(spark, name).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(FAILURE):
        tables.replace_table(bad, name)
    assert rows(tables.scan_table(spark, name)) == [(0,), (1,), (2,)]


def test_a_table_of_the_same_columns_is_moved_at_once(spark, rows):
    name = f"{new_namespace(spark, 'test')}.t"
    tables.replace_table(spark.range(3), name)
    before = tables.scan_table(spark, name)
    version = tables.write_version(spark.range(5), name)
    assert rows(tables.scan_table(spark, name)) == [(0,), (1,), (2,)]
    seen = []
    original = spark.sql
    spark.sql = lambda text, *a, **k: (seen.append(spark.catalog.tableExists(name)), original(text, *a, **k))[1]
    try:
        published, old = tables.publish([version])
    finally:
        del spark.sql
    assert all(seen) and len(old) == 1
    assert published[name].count() == 5 and tables.scan_table(spark, name).count() == 5
    assert rows(before) == [(0,), (1,), (2,)]


def test_a_table_may_change_its_columns(spark, rows):
    name = f"{new_namespace(spark, 'test')}.t"
    tables.replace_table(spark.range(3), name)
    tables.replace_table(spark.range(2).selectExpr("id", "'x' AS s"), name)
    assert rows(tables.scan_table(spark, name)) == [(0, "x"), (1, "x")]


def test_append_fills_defaults(spark, rows):
    name = f"{new_namespace(spark, 'test')}.t"
    schema = struct_of({"id": "int", "discount": "decimal(5,4)", "note": "string"}).add("gone", "boolean")
    tables.create_table(spark, name, schema, {"discount": "0", "gone": "false"})
    one = spark.createDataFrame([(1, "x")], "id int, note string")
    tables.append_table(one, name)
    tables.append_table(one.select("id"), name)
    got = rows(tables.scan_table(spark, name))
    assert [(r[0], float(r[1]), r[2], r[3]) for r in got] == [(1, 0.0, None, False), (1, 0.0, "x", False)]


def test_namespace_is_created_once(spark):
    name = new_namespace(spark, "test")
    tables.create_namespace(spark, name)
    assert spark.catalog.databaseExists(name)

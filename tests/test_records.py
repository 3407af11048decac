"""Files with quoted line breaks: records cut by many tasks against a reader of the whole file."""

from __future__ import annotations

import csv
import io
import random

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException

from starmart.sources.delimited import CORRUPT, SOURCE, scan_delimited
from starmart.sources.raw_schemas import struct_of
from starmart.sources.records import after_line, scan_records

FAILURE = (PySparkException, Py4JError)
SCHEMA = struct_of({"Id": "int", "Name": "string", "Price": "decimal(10,2)"})
HEADER = "Id;Name;Price\n"


def write(tmp_path, text, name="f.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode("latin-1"))
    return str(path)


@pytest.fixture
def small_ranges(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def some_values(seed, count):
    random.seed(seed)
    pieces = ["a", "Süd", ";", '"', "\n", "\n\n", "#", " x ", "long text " * 9, '""', "'", "\n#no comment\n", "7;8;9\n"]
    return ["v" + "".join(random.choices(pieces, k=random.randrange(7))) + "w" for _ in range(count)]


def as_file(values):
    out = io.StringIO()
    writer = csv.writer(out, delimiter=";", lineterminator="\n", quoting=csv.QUOTE_MINIMAL)
    for i, value in enumerate(values):
        writer.writerow([i, value, f"{i}.5"])
    return HEADER + out.getvalue()


@pytest.mark.parametrize("seed, size", [(1, 50), (2, 300), (3, 1 << 20)])
def test_ranges_of_any_size_give_the_rows_of_one_task(spark, tmp_path, rows, small_ranges, seed, size):
    values = some_values(seed, 60)
    paths = [write(tmp_path, as_file(values)), write(tmp_path, as_file(values[::-1][:20]), "g.csv")]
    whole = rows(scan_delimited(spark, paths, SCHEMA, line_breaks_in_quotes=True))
    small_ranges(size)
    read = scan_records(spark, paths, SCHEMA, source_order=True).orderBy(SOURCE).collect()
    assert sorted((tuple(r[:3]) for r in read), key=str) == sorted(whole, key=str)
    assert [r.Name for r in read] == [*values, *values[::-1][:20]]
    assert [r.Id for r in read] == [*range(60), *range(20)]


def test_a_record_over_many_ranges(spark, tmp_path, small_ranges):
    value = "\n".join(f"line {i}" for i in range(100))
    path = write(tmp_path, HEADER + f'1;"{value}";1\n2;b;2\n')
    small_ranges(50)
    assert {r.Id: r.Name for r in scan_records(spark, path, SCHEMA).collect()} == {1: value, 2: "b"}


LINES = [
    ("1;a;2", False, True),
    ('1;"a', True, False),
    ('a";2', False, False),
    ('1;"a";"b', True, False),
    ('x";"y', True, True),
    ('""', False, True),
    ('"""', True, False),
    ('5 " wide', False, False),
    ('# said "so', False, False),
    ('1; "a;b', True, False),
    ("", False, True),
]


def test_what_a_line_does(spark):
    """Lines, and whether what begins outside or inside a quoted value ends inside one."""
    df = spark.createDataFrame([(line,) for line, *_ in LINES], "line string")
    found = df.select("line", after_line(df.line, False), after_line(df.line, True)).collect()
    assert [tuple(r) for r in found] == LINES


def test_quotes_inside_plain_values_and_comments(spark, tmp_path, small_ranges):
    path = write(tmp_path, '# a "comment\n' + HEADER + '1;5 " wide;1\n# "\n2;"x\n# no comment\n\ny";2\n3;c;3\r\n')
    for size in (16, 1 << 20):
        small_ranges(size)
        read = {r.Id: r.Name for r in scan_records(spark, path, SCHEMA).collect()}
        assert read == {1: '5 " wide', 2: "x\n# no comment\n\ny", 3: "c"}


def test_line_ends_of_two_characters(spark, tmp_path, rows):
    path = write(tmp_path, '1;"a\nb";1\n2;c;2\n'.join([HEADER, ""]).replace("\n", "\r\n"))
    assert [(r.Id, r.Name) for r in scan_records(spark, path, SCHEMA).orderBy("Id").collect()] == [(1, "a\r\nb"), (2, "c")]


def test_bad_records(spark, tmp_path):
    bad = ["2;short", "x;text;1", "2;text;1;more", "2;text;many", '2;"two\nlines"']
    for one in (bad[-1], bad[3]):
        with pytest.raises(FAILURE):
            scan_records(spark, write(tmp_path, HEADER + f'1;"a\nb";1\n{one}\n'), SCHEMA).collect()
    path = write(tmp_path, HEADER + "\n".join(['1;"a\nb";1', *bad, ""]))
    read = scan_records(spark, path, SCHEMA, strict=False).collect()
    assert sorted(r[CORRUPT] or "" for r in read) == sorted(["", *bad])


def test_blank_lines_and_unclosed_quotes(spark, tmp_path, small_ranges):
    blank = write(tmp_path, HEADER + '1;"a\n\nb";1\n\n2;b;2\n')
    unclosed = write(tmp_path, HEADER + '1;a;1\n2;"b;2\n3;c;3\n', "g.csv")
    small_ranges(8)
    for path in (blank, unclosed):
        with pytest.raises(FAILURE):
            scan_records(spark, path, SCHEMA).collect()
    assert sorted(r.Id for r in scan_records(spark, blank, SCHEMA, strict=False).collect()) == [1, 2]
    read = scan_records(spark, unclosed, SCHEMA, strict=False).collect()
    assert sorted((r.Id or 0, r[CORRUPT] or "") for r in read) == [(0, '2;"b;2'), (0, "3;c;3"), (1, "")]


def test_headers(spark, tmp_path, rows):
    with pytest.raises(FAILURE):
        scan_records(spark, write(tmp_path, "Id;Title;Price\n1;a;1\n"), SCHEMA).collect()
    assert rows(scan_records(spark, write(tmp_path, "id; Name ;PRICE\n", "g.csv"), SCHEMA)) == []
    assert rows(scan_records(spark, write(tmp_path, "", "h.csv"), SCHEMA)) == []

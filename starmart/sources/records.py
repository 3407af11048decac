"""Delimited files whose quoted values may span lines, read by as many tasks as their size asks for.

Whether a line begins inside a quoted value depends on all lines before it. A line only maps "inside or not" before it
to "inside or not" after it, so a byte range is read under both beginnings; the ranges' own maps, one row for each, are
then chained along a file. Records are cut where a line begins outside. A record of one line stays where it is; only the
lines of longer ones are shuffled. Spark's own parser reads the records.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.text import WHITE_SPACE, strip
from starmart.session import scratch_path
from starmart.sources.delimited import CORRUPT, DIALECT, SOURCE, read_as, trimmed, typed

#: Names of the two beginnings of a byte range, and whether each is inside a quoted value.
BEGINNINGS = {"outside": False, "inside": True}
_LINE_END = "\n"
_PARSED = ("sep", "quote", "escape", "ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace", "nullValue", "emptyValue")


def scan_records(
    spark: SparkSession, path: str | list[str], schema: T.StructType, strict: bool = True, source_order: bool = False
) -> DataFrame:
    """Rows of one or more files with a declared schema; a quoted value may span lines.

    Values, numbers, headers and ``_corrupt`` are as ``scan_delimited`` has them, and a line break inside a value stays as
    it is. Lines end with a line feed, a carriage return before it belongs to the white space around values. A strict
    scan also fails on a line that is blank outside of quotes and on a quote that no line closes; a lenient one skips
    the blank line, and each line after the opened quote is a corrupt row. Comments begin outside of quotes. An empty
    file has no row. ``source_order`` adds ``_source``, which sorts rows as they lie in the files. The files are read
    once; their lines, with what is known of them, are written to the scratch folder.
    """
    lines = _lines(spark, path)
    ranges = _ranges(spark, lines)
    records = _records(lines, ranges, strict)
    as_text = T.StructType([T.StructField(f.name, read_as(f.dataType)) for f in schema.fields])
    df = _parsed(records, as_text, strict)
    df = typed(trimmed(df, as_text), schema, strict)
    return df if source_order else df.drop(SOURCE)


def after_line(line: Column, inside: bool) -> Column:
    """Whether a line that begins inside a quoted value, or outside, ends inside one.

    A value is quoted if a quote comes first in it; the quotes up to the next separator then tell whether it is closed.
    """
    quote, comment = DIALECT["quote"], DIALECT["comment"]
    odd = lambda piece: (F.length(piece) - F.length(F.translate(piece, quote, ""))) % 2 == 1
    opens = lambda piece: F.startswith(F.ltrim(piece, F.lit(WHITE_SPACE)), F.lit(quote)) & odd(piece)
    ends = F.aggregate(
        F.split(line, DIALECT["sep"]), F.lit(inside), lambda state, piece: F.when(state, ~odd(piece)).otherwise(opens(piece))
    )
    plain = ~F.contains(line, F.lit(quote))
    if not inside:
        plain = plain | F.startswith(line, F.lit(comment))
    return F.when(plain, F.lit(inside)).otherwise(ends)


def _with_states(df: DataFrame, order: str, by: list[str], beginnings: dict[str, bool]) -> DataFrame:
    """Add ``before_*`` and ``after_*``: inside or not around each row, for each beginning of its group, by the rows' maps.

    A map (``map_outside``, ``map_inside``) is constant, or it keeps what was, or it turns it around. So the last
    constant before a row and the number of turns since tell what is.
    """
    rows = Window.partitionBy(*by).orderBy(order)
    turn = (F.col("map_outside") & ~F.col("map_inside")).cast("long")
    constant = F.when(F.col("map_outside") == F.col("map_inside"), F.struct(F.col("map_outside").alias("state"), "_turns"))
    df = df.withColumn("_turns", F.sum(turn).over(rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    df = df.withColumn("_last", F.last(constant, ignorenulls=True).over(rows.rowsBetween(Window.unboundedPreceding, -1)))
    turns = F.col("_turns") - turn - F.coalesce("_last._turns", F.lit(0))
    before = {name: F.coalesce("_last.state", F.lit(inside)) != (turns % 2 == 1) for name, inside in beginnings.items()}
    df = df.withColumns({f"before_{name}": column for name, column in before.items()})
    after = {name: F.when(F.col(f"before_{name}"), F.col("map_inside")).otherwise(F.col("map_outside")) for name in beginnings}
    return df.withColumns({f"after_{name}": column for name, column in after.items()}).drop("_turns", "_last")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with, for each beginning of their byte range: inside before and after, the line their record starts with."""
    text = F.decode(F.col("value").cast("binary"), DIALECT["encoding"])
    read = spark.read.option("lineSep", _LINE_END).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
        text.alias("line"),
    )
    maps = {name: after_line(F.col("line"), inside) for name, inside in BEGINNINGS.items()}
    read = read.withColumns({f"map_{name}": column for name, column in maps.items()})
    by = ["file", "start"]
    found = _with_states(read, "row", by, BEGINNINGS)
    running = Window.partitionBy(*by).orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = {name: F.last(F.when(~F.col(f"before_{name}"), F.col("row")), ignorenulls=True).over(running) for name in BEGINNINGS}
    found = found.withColumns({f"first_{name}": column for name, column in first.items()})
    place = scratch_path(spark, "lines")
    found.drop("map_outside", "map_inside").write.parquet(place)
    return spark.read.parquet(place)


def _is_no_record(line: Column) -> Column:
    return (strip(line) == "") | F.startswith(line, F.lit(DIALECT["comment"]))


def _ranges(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """One row for each byte range with a line: whether it begins inside, the record that is then open, the file's header
    and the record that the file leaves open."""
    ends = [F.max_by(f"after_{name}", "row").alias(f"map_{name}") for name in BEGINNINGS]
    opened = [F.max_by(f"first_{name}", "row").alias(f"first_{name}") for name in BEGINNINGS]
    headers = [
        F.min(F.when(~F.col(f"before_{name}") & ~_is_no_record(F.col("line")), F.col("row"))).alias(f"header_{name}")
        for name in BEGINNINGS
    ]
    ranges = lines.groupBy("file", "start").agg(*ends, *opened, *headers)
    ranges = _with_states(ranges, "start", ["file"], {"range": BEGINNINGS["outside"]}).withColumnRenamed("before_range", "inside")
    order = Window.partitionBy("file").orderBy("start")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chosen = lambda what: F.when(F.col("inside"), F.col(f"{what}_inside")).otherwise(F.col(f"{what}_outside"))
    key = lambda what: F.when(chosen(what).isNotNull(), F.struct("start", chosen(what).alias("row")))
    ranges = ranges.withColumns({"last_key": key("first"), "header_key": key("header")})
    ranges = ranges.select(
        "file",
        "start",
        "inside",
        F.last("last_key", ignorenulls=True).over(earlier).alias("carried"),
        F.first("header_key", ignorenulls=True).over(whole).alias("header"),
        F.when(F.last("after_range").over(whole), F.last("last_key", ignorenulls=True).over(whole)).alias("open"),
    )
    place = scratch_path(spark, "ranges")
    ranges.write.parquet(place)
    return spark.read.parquet(place)


def _records(lines: DataFrame, ranges: DataFrame, strict: bool) -> DataFrame:
    """(file, key, record, header, unclosed) of every record, the header among them."""
    chosen = lambda what: F.when(F.col("inside"), F.col(f"{what}_inside")).otherwise(F.col(f"{what}_outside"))
    own = F.when(chosen("first").isNotNull(), F.struct("start", chosen("first").alias("row")))
    known = lines.join(ranges, ["file", "start"]).select(
        "file",
        F.struct("start", "row").alias("at"),
        "line",
        chosen("before").alias("before"),
        chosen("after").alias("after"),
        F.coalesce(own, "carried").alias("key"),
        "header",
        F.coalesce(F.coalesce(own, "carried") == F.col("open"), F.lit(False)).alias("unclosed"),
    )
    blank = ~F.col("before") & (strip(F.col("line")) == "")
    comment = ~F.col("before") & F.startswith("line", F.lit(DIALECT["comment"]))
    if strict:
        failed = F.when(blank, F.raise_error(F.lit("blank line")).cast("boolean")).when(
            F.col("unclosed"), F.raise_error(F.lit("a quote is not closed")).cast("boolean")
        )
        known = known.filter(F.coalesce(failed, ~comment))
    else:
        known = known.filter(~blank & ~comment)
    is_header = F.coalesce(F.col("key") == F.col("header"), F.lit(False)).alias("is_header")
    whole = F.col("unclosed") | (~F.col("before") & ~F.col("after"))
    alone = known.filter(whole).select("file", F.when(F.col("unclosed"), F.col("at")).otherwise(F.col("key")).alias("key"), "line", is_header, "unclosed")
    long = known.filter(~whole).groupBy("file", "key", is_header).agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda part: part["line"]), _LINE_END)
    return alone.unionByName(long.select("file", "key", joined.alias("line"), "is_header", F.lit(False).alias("unclosed")))


def _parsed(records: DataFrame, schema: T.StructType, strict: bool) -> DataFrame:
    """Columns of the records as text, and ``_source``; a header that differs from the schema fails."""
    options = {k: DIALECT[k] for k in _PARSED} | {"multiLine": "true"}
    fields = list(schema.fields)
    if strict:
        options |= {"mode": "FAILFAST"}
    else:
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        fields.append(T.StructField(CORRUPT, T.StringType()))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    # A record is parsed once: what is unclosed is no record, and the parser would take it for one.
    values = F.from_csv(F.when(~F.col("unclosed"), F.col("line")), ddl, options)
    source = F.struct("file", F.col("key.start").alias("offset"), F.col("key.row").alias("row"))
    df = records.select(values.alias("values"), source.alias(SOURCE), "line", "is_header", "unclosed")
    same = reduce(
        lambda a, b: a & b,
        [F.coalesce(F.lower(strip(F.col("values")[n])) == n.lower(), F.lit(False)) for n in schema.names],
    )
    wrong = F.raise_error(F.concat(F.lit("header differs from the schema: "), "line")).cast("boolean")
    df = df.filter(F.when(F.col("is_header"), F.when(same, F.lit(False)).otherwise(wrong)).otherwise(F.lit(True)))
    out = [F.col("values")[f.name].alias(f.name) for f in schema.fields]
    if not strict:
        out.append(F.when(F.col("unclosed"), F.col("line")).otherwise(F.col("values")[CORRUPT]).alias(CORRUPT))
    return df.select(*out, SOURCE)

"""Scans of delimited text files."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.text import WHITE_SPACE, strip, to_null
from starmart.sources.raw_schemas import struct_of

# The dialect of the source files.
DIALECT = {
    "sep": ";",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "comment": "#",
    "encoding": "ISO-8859-1",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "nullValue": "",
    "emptyValue": "",
}

# A number that is read as a floating point number; other texts that a cast would take, such as 1d, are text.
FLOATING = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
# Texts that a cast to a whole number may take, which drops control characters around them; all others it refuses.
WHOLE = r"^[\x00-\x20\x7f]*[+-]?0*[0-9]{1,19}[\x00-\x20\x7f]*$"
# The texts that ``as_number`` takes for a floating point number: $ also stands before line ends that a cast refuses.
FLOATING_TO_END = FLOATING.removesuffix("$") + r"(\r\n|[\n\r])?\z"
_NUMBERS = (T.IntegralType, T.DecimalType, T.FractionalType)

CORRUPT = "_corrupt"
SOURCE = "_source"


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    strict: bool = True,
    line_breaks_in_quotes: bool = False,
    source_order: bool = False,
    skip_rows: int = 0,
    max_rows: int | None = None,
) -> DataFrame:
    """Rows of one or more files with a declared schema.

    Text is unquoted and trimmed, and empty text is NULL. A row of the wrong length, a blank line, a value that
    does not fit its type (in a column that is read) or a header that differs from the schema fails a ``strict``
    scan. Otherwise such a row stays, with its raw line in ``_corrupt`` (or, if only a number does not fit, its
    values joined by the separator); a lenient scan has no row for a blank line. Numbers have a decimal point and
    no thousands sign: ``14,00`` and ``1,234.5`` do not fit. ``line_breaks_in_quotes`` lets a quoted value span
    lines; a file is then one task, and its blank lines are not looked for, so it is off unless asked for (a
    broken line fails a strict scan). ``source_order`` adds ``_source``, which sorts rows as they lie in the files.
    ``skip_rows`` and ``max_rows`` take a range of the rows as they lie in the files.
    """
    reader = spark.read.options(**DIALECT).option("enforceSchema", "false")
    # Without pruning a row of the wrong length is noticed whichever columns a query needs.
    reader = reader.option("columnPruning", "false").option("multiLine", line_breaks_in_quotes)
    # Numbers are read as text, because the reader drops thousands signs wherever they stand.
    as_text = T.StructType([T.StructField(f.name, read_as(f.dataType)) for f in schema.fields])
    if strict:
        df = reader.option("mode", "FAILFAST").schema(as_text).csv(path)
    else:
        wide = T.StructType([*as_text.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        df = reader.schema(wide).csv(path)
    ranged = skip_rows or max_rows is not None
    if source_order or ranged:
        df = with_source_order(df)
    df = typed(trimmed(df, as_text), schema, strict)
    if ranged:
        df = in_source_range(df, skip_rows, max_rows)
        if not source_order:
            df = df.drop(SOURCE)
    if strict and not line_breaks_in_quotes:
        df = df.unionByName(_no_blank_lines(spark, path, df.schema))
    return df


def read_as(kind: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(kind, _NUMBERS) else kind


def as_number(text: Column, kind: T.DataType) -> Column:
    """The number that a text writes, or NULL."""
    number = text.try_cast(kind.simpleString())
    return F.when(text.rlike(FLOATING), number) if isinstance(kind, (T.DoubleType, T.FloatType)) else number


def typed(df: DataFrame, schema: T.StructType, strict: bool) -> DataFrame:
    """Number columns from their text. A text that is no number fails or marks the row."""
    numbers = {f.name: as_number(F.col(f.name), f.dataType) for f in schema.fields if isinstance(f.dataType, _NUMBERS)}
    misfits = {name: F.col(name).isNotNull() & number.isNull() for name, number in numbers.items()}
    if strict:
        # An error and not a filter: only a column that is read can fail.
        return df.withColumns(
            {
                name: F.when(
                    misfits[name], F.raise_error(F.concat(F.lit(f"no number in {name}: "), F.col(name))).cast(schema[name].dataType)
                ).otherwise(number)
                for name, number in numbers.items()
            }
        )
    line = F.concat_ws(DIALECT["sep"], *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in schema.names])
    bad = reduce(lambda a, b: a | b, misfits.values(), F.lit(False))
    return df.withColumns(numbers | {CORRUPT: F.coalesce(F.col(CORRUPT), F.when(bad, line))})


def _no_blank_lines(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """No rows; reading it fails if a line of the files is blank (the reader skips such lines silently)."""
    blank = F.btrim(F.col("value"), F.lit(WHITE_SPACE)) == ""
    checked = spark.read.text(path).filter(F.when(blank, F.raise_error(F.lit("blank line")).cast("boolean")).otherwise(False))
    return checked.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def with_source_order(df: DataFrame) -> DataFrame:
    """Add ``_source`` = (file, offset of the split, row counter) to a fresh file scan.

    One task reads a split from start to end, so the counter rises along it.
    """
    return df.withColumn(
        SOURCE,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("offset"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def in_source_range(df: DataFrame, skip: int = 0, rows: int | None = None) -> DataFrame:
    """Rows of a scan with ``_source`` after the first ``skip``, at most ``rows`` of them, as they lie in the files.

    Nothing is sorted: rows are counted per split, and a row's number is its place in its split plus the rows of
    the splits before, a table with one row per split. For a fresh scan, which numbers its rows alike each time.
    """
    split = [F.col(f"{SOURCE}.file").alias("_file"), F.col(f"{SOURCE}.offset").alias("_offset")]
    row = F.col(f"{SOURCE}.row")
    earlier = Window.orderBy("_file", "_offset").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        df.groupBy(*split)
        .agg(F.count("*").alias("_rows"), F.min(row).alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    )
    number = F.col("_before") + row - F.col("_first")
    wanted = number >= skip
    if rows is not None:
        wanted = wanted & (number < skip + rows)
    return df.select("*", *split).join(F.broadcast(splits), ["_file", "_offset"]).filter(wanted).select(*df.columns)


def trimmed(df: DataFrame, schema: T.StructType) -> DataFrame:
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: to_null(strip(F.col(name))) for name in texts})


#: Kinds of values from the narrowest to the widest; a text fits every column.
KINDS = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType()}


def kinds_of(df: DataFrame) -> dict[str, str]:
    """The narrowest kind that all values of each text column fit, as ``as_number`` has it; text for a column without
    any value. All columns are judged in one pass.

    A cast that fails costs far more than one that fits, so only texts that look like whole numbers are cast, each once.
    """
    names = df.columns
    if not names:
        return {}
    texts = df.toDF(*[f"{i}_text" for i in range(len(names))])

    def whole(i: int) -> Column:
        text = F.col(f"{i}_text")
        plain = F.col(f"{i}_floating") & (F.length(text) < 20)  # and no fraction or exponent, looked for without a pattern
        marked = reduce(Column.__or__, [F.contains(text, F.lit(mark)) for mark in ".eE"])
        return F.when(F.when(plain, ~marked).otherwise(text.rlike(WHOLE)), text.try_cast("bigint"))

    floating = texts.withColumns({f"{i}_floating": F.col(f"{i}_text").rlike(FLOATING_TO_END) for i in range(len(names))})
    numbers = floating.withColumns({f"{i}_number": whole(i) for i in range(len(names))})
    bounds = F.lit(-(1 << 31)), F.lit((1 << 31) - 1)
    seen = numbers.agg(
        *[F.count(f"{i}_text").alias(f"{i}_values") for i in range(len(names))],
        *[F.count(f"{i}_number").alias(f"{i}_long") for i in range(len(names))],
        *[F.count_if(F.col(f"{i}_number").between(*bounds)).alias(f"{i}_int") for i in range(len(names))],
        *[F.count_if(f"{i}_floating").alias(f"{i}_double") for i in range(len(names))],
    ).first()
    return {
        name: next((k for k in KINDS if seen[f"{i}_values"] and seen[f"{i}_{k}"] == seen[f"{i}_values"]), "string")
        for i, name in enumerate(names)
    }


def infer_schema(spark: SparkSession, path: str, rows: int | None = None) -> T.StructType:
    """Column types guessed from all rows: int, long, double, else text; a column without any value is text.

    For looking at unknown files; the jobs declare their schemas. ``rows`` looks at the first rows only: a later
    row may then not fit the schema. All columns are judged in one pass.
    """
    whole = spark.read.options(**DIALECT).csv(path)
    looked_at = trimmed(whole, whole.schema)
    return struct_of(kinds_of(looked_at if rows is None else looked_at.limit(rows)))


UNION, SAME = "union", "same"


def headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files below these paths by their header, the first line that is neither blank nor a comment; all in one scan."""
    text = F.decode(F.col("value").cast("binary"), DIALECT["encoding"])
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), text.alias("line"),
        F.monotonically_increasing_id().alias("row"),
    )
    wanted = (F.btrim("line", F.lit(WHITE_SPACE)) != "") & ~F.startswith("line", F.lit(DIALECT["comment"]))
    first = lines.filter(wanted).groupBy("file").agg(F.min_by("line", F.struct("start", "row")).alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for line, files in first.groupBy("line").agg(F.sort_array(F.collect_list("file"))).collect():
        (names,) = csv.reader([line], delimiter=DIALECT["sep"], quotechar=DIALECT["quote"])
        found.setdefault(tuple(n.strip(WHITE_SPACE) for n in names), []).extend(files)
    return dict(sorted(found.items()))


def scan_merged(spark: SparkSession, paths: str | list[str], mode: str = UNION, strict: bool = True) -> DataFrame:
    """Rows of files whose headers may differ: every column that any file has, NULL in the rows of files without it.

    A column that several files have takes the widest kind that its values need, from int over long and double to text,
    judged over all rows of all files; a column without any value is text. ``mode`` "same" fails instead where headers
    differ in their columns; their order never matters. Files of one header are one scan. A header that repeats or
    lacks a name fails. ``strict`` is that of ``scan_delimited``.
    """
    groups = headers(spark, [paths] if isinstance(paths, str) else paths)
    if not groups:
        raise ValueError(f"no file with a header below {paths}")
    for header in groups:
        if len(set(header)) < len(header) or "" in header:
            raise ValueError(f"a header repeats a name or lacks one: {';'.join(header)}")
    if mode == SAME and len({frozenset(header) for header in groups}) > 1:
        raise ValueError(f"headers differ: {[';'.join(header) for header in groups]}")
    scans = [scan_delimited(spark, files, struct_of(dict.fromkeys(header, "string")), strict) for header, files in groups.items()]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    names = [c for c in whole.columns if c != CORRUPT]
    chosen = kinds_of(whole.select(*[F.col(f"`{n}`") for n in names]))
    return whole.withColumns({n: as_number(F.col(n), KINDS[k]) for n, k in chosen.items() if k in KINDS})


def write_delimited(df: DataFrame, path: str) -> None:
    """Write a frame in the dialect of the source files."""
    options = {k: v for k, v in DIALECT.items() if k not in ("comment", "nullValue", "emptyValue")}
    df.write.options(**options).option("nullValue", "").option("emptyValue", "").csv(path)

"""Checks that a database would make by constraints, and profiles of columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.duplicates import flag_duplicates

# The outcome of a written row.
WRITTEN, REFUSED = 1, 0


def _rows_of(df: DataFrame, entries: list[list[Column]]) -> DataFrame:
    """A one-row frame to one row per entry."""
    return df.select(F.inline(F.array(*[F.struct(*entry) for entry in entries])))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, rows, nulls), all columns in one pass."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)]
    counted = df.agg(F.count("*").alias("_rows"), *nulls)
    return _rows_of(
        counted,
        [
            [F.lit(c).alias("column_name"), F.col("_rows").alias("rows"), F.col(f"_{i}").alias("nulls")]
            for i, c in enumerate(columns)
        ],
    )


def key_breaches(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their number of rows."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    counted = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    return counted.filter((F.col("rows") > 1) | missing)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(key, rows) of child keys without a parent. Children are counted per key before the join."""
    counted = (
        child.select(F.col(child_key).alias("key"))
        .dropna()
        .groupBy("key")
        .agg(F.count("*").alias("rows"))
    )
    parents = parent.select(F.col(parent_key).alias("key"))
    return counted.join(parents, "key", "left_anti")


def orphan_counts(links: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(foreign_key, orphan_keys, orphan_rows) for each named link (child, key, parent, key).

    Links of one child are checked in one scan of it: its keys are stacked as (name, value), counted in their tasks and
    met by the stacked keys of all parents in one anti-join. Keys of a child that differ in type meet as text.
    """
    children: list[DataFrame] = []
    for child, *_ in links.values():
        if not any(child is known for known in children):
            children.append(child)
    parts = []
    for child in children:
        own = {name: link for name, link in links.items() if link[0] is child}
        kinds = {df.schema[key].dataType.simpleString() for _, a, parent, b in own.values() for df, key in ((child, a), (parent, b))}
        kind = kinds.pop() if len(kinds) == 1 else "string"

        def pair(name: str, key: str, kind: str = kind) -> Column:
            return F.struct(F.lit(name).alias("name"), F.col(key).cast(kind).alias("key"))

        stacked = child.select(F.inline(F.array(*[pair(name, key) for name, (_, key, _, _) in own.items()])))
        counted = stacked.filter(F.col("key").isNotNull()).groupBy("name", "key").agg(F.count("*").alias("rows"))
        parents = reduce(DataFrame.unionByName, [parent.select(F.inline(F.array(pair(name, key)))) for name, (_, _, parent, key) in own.items()])
        lost = counted.join(parents, ["name", "key"], "left_anti")
        measures = []
        for i, name in enumerate(own):
            here = F.col("name") == name
            measures += [F.count_if(here).alias(f"_k{i}"), F.coalesce(F.sum(F.when(here, F.col("rows"))), F.lit(0)).alias(f"_r{i}")]
        entries = [
            [F.lit(name).alias("foreign_key"), F.col(f"_k{i}").alias("orphan_keys"), F.col(f"_r{i}").alias("orphan_rows")]
            for i, name in enumerate(own)
        ]
        parts.append(_rows_of(lost.agg(*measures), entries))
    return reduce(DataFrame.unionByName, parts)


def length_breaches(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """(column_name, max_length, longest, too_long) of text columns with a length limit."""
    measures = []
    for i, (name, limit) in enumerate(limits.items()):
        size = F.length(name)
        measures += [F.max(size).alias(f"_l{i}"), F.count_if(size > limit).alias(f"_n{i}")]
    return _rows_of(
        df.agg(*measures),
        [
            [
                F.lit(name).alias("column_name"),
                F.lit(limit).alias("max_length"),
                F.col(f"_l{i}").alias("longest"),
                F.col(f"_n{i}").alias("too_long"),
            ]
            for i, (name, limit) in enumerate(limits.items())
        ],
    )


def cast_breaches(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """(column_name, type, misfits): values that the type cannot hold."""
    misfits = [
        F.count_if(F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()).alias(f"_{i}")
        for i, (name, kind) in enumerate(types.items())
    ]
    return _rows_of(
        df.agg(*misfits),
        [
            [F.lit(name).alias("column_name"), F.lit(kind).alias("type"), F.col(f"_{i}").alias("misfits")]
            for i, (name, kind) in enumerate(types.items())
        ],
    )


def profile(df: DataFrame) -> DataFrame:
    """(column_name, rows, nulls, min_number, max_number, min_text, max_text), in one pass.

    Numbers fill the number columns; dates and text fill the text columns.
    """
    measures, entries = [F.count("*").alias("_rows")], []
    for i, field in enumerate(df.schema.fields):
        column = F.col(field.name)
        number = isinstance(field.dataType, T.NumericType)
        kind = "double" if number else "string"
        measures += [
            F.count(column).alias(f"_c{i}"),
            F.min(column).cast(kind).alias(f"_min{i}"),
            F.max(column).cast(kind).alias(f"_max{i}"),
        ]
        low, high = F.col(f"_min{i}"), F.col(f"_max{i}")
        no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
        entries.append(
            [
                F.lit(field.name).alias("column_name"),
                F.col("_rows").alias("rows"),
                (F.col("_rows") - F.col(f"_c{i}")).alias("nulls"),
                (low if number else no_number).alias("min_number"),
                (high if number else no_number).alias("max_number"),
                (no_text if number else low).alias("min_text"),
                (no_text if number else high).alias("max_text"),
            ]
        )
    return _rows_of(df.agg(*measures), entries)


def domain_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, rows): the values of text columns, NULL left out.

    One scan for all columns; the values are counted in each task before they are shuffled.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("rows"))
    )


#: Values that a column may have to be described by their list.
LIST_VALUES = 60


def column_domains(df: DataFrame, list_values: int = LIST_VALUES) -> DataFrame:
    """(column_name, kind, value, rows, low, high): what values each column has, NULL left out.

    A column of at most ``list_values`` distinct values is described by their list, with the rows of each (``list``); any
    other by its least and greatest value (``bounds``); a column without values by none (``empty``). Values are given as
    text. One pass makes sketches of the distinct values of all columns, of fixed size in every task; only columns whose
    estimate is at most twice the limit are then counted, in a second pass, and the exact number decides.
    """
    named = {f.name: i for i, f in enumerate(df.schema.fields)}
    measures = []
    for name, i in named.items():
        measures += [F.approx_count_distinct(name).alias(f"_n{i}"), F.min(name).cast("string").alias(f"_l{i}"), F.max(name).cast("string").alias(f"_h{i}")]
    seen = df.agg(*measures).first()
    likely = [name for name, i in named.items() if 0 < seen[f"_n{i}"] <= 2 * list_values]
    values = domain_values(df.select(*[F.col(c).cast("string").alias(c) for c in likely]), likely) if likely else None
    short = set()
    if values is not None:
        held = values.groupBy("column_name").agg(F.count("*").alias("_values"))
        short = {r["column_name"] for r in held.filter(F.col("_values") <= list_values).collect()}
    schema = "column_name string, kind string, value string, rows long, low string, high string"
    rest = [
        (name, "bounds" if seen[f"_l{i}"] is not None else "empty", None, None, seen[f"_l{i}"], seen[f"_h{i}"])
        for name, i in named.items()
        if name not in short
    ]
    found = df.sparkSession.createDataFrame(rest, schema)
    if not short:
        return found
    text = F.lit(None).cast("string")
    lists = values.filter(F.col("column_name").isin(*short)).select(
        "column_name", F.lit("list").alias("kind"), "value", "rows", text.alias("low"), text.alias("high")
    )
    return lists.unionByName(found)


def issue_counts(issues: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(issue, rows) for each named issue (frame, condition). Issues of one frame share its scan."""
    frames: list[DataFrame] = []
    for df, _ in issues.values():
        if not any(df is known for known in frames):
            frames.append(df)
    parts = []
    for df in frames:
        own = [(name, condition) for name, (frame, condition) in issues.items() if frame is df]
        counted = df.agg(*[F.count_if(c).alias(f"_{i}") for i, (_, c) in enumerate(own)])
        parts.append(
            _rows_of(
                counted,
                [
                    [F.lit(name).alias("issue"), F.col(f"_{i}").alias("rows")]
                    for i, (name, _) in enumerate(own)
                ],
            )
        )
    return reduce(DataFrame.unionByName, parts)


def write_status(
    df: DataFrame,
    rules: dict[str, Column],
    unique: list[str] | None = None,
    order: str | None = None,
) -> DataFrame:
    """Add ``write_status`` (1 or 0) and ``write_error`` (broken rules, NULL if none) to each row.

    A rule is a condition that a good row meets. ``unique`` names key columns: of rows with one key
    the first by ``order`` is good and the others break the rule ``duplicate key``.
    """
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    columns = df.columns
    if unique:
        df = flag_duplicates(df, unique, order, status="_copy")
        broken.append(F.when(F.col("_copy") == "duplicate", F.lit("duplicate key")))
    error = F.nullif(F.concat_ws("; ", *broken), F.lit(""))
    return df.select(
        *columns,
        F.when(error.isNull(), WRITTEN).otherwise(REFUSED).alias("write_status"),
        error.alias("write_error"),
    )


def fits(column: str, kind: str) -> Column:
    """Rule: the value is NULL or the type can hold it."""
    return F.col(column).isNull() | F.col(column).try_cast(kind).isNotNull()


def at_most(column: str, length: int) -> Column:
    """Rule: the text is NULL or no longer than this."""
    return F.col(column).isNull() | (F.length(column) <= length)

"""Choosing, renaming, casting and deriving columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exclude(df: DataFrame, excluded: Iterable[str]) -> DataFrame:
    """Every column but the excluded ones; columns nobody named stay."""
    return df.drop(*excluded)


def include(df: DataFrame, included: Iterable[str]) -> DataFrame:
    """Only the named columns, in the given order; columns nobody named go."""
    return df.select(*included)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Only the columns of the mapping, under their new names and in its order."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def derive(
    df: DataFrame,
    columns: Iterable[str],
    expression: Callable[[Column], Column],
    suffix: str = "",
) -> DataFrame:
    """Apply one expression to many columns: in place, or appended as ``<name><suffix>``."""
    return df.withColumns({f"{name}{suffix}": expression(F.col(name)) for name in columns})


def cast(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast columns. A value that does not fit fails the job, or becomes NULL when not ``strict``."""
    return df.withColumns(
        {n: F.col(n).cast(t) if strict else F.col(n).try_cast(t) for n, t in types.items()}
    )


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType))
            for name, value in defaults.items()
        }
    )

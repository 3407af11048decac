"""Row filters."""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COMPARE = {
    "<": operator.lt,
    "<=": operator.le,
    "=": operator.eq,
    "!=": operator.ne,
    ">=": operator.ge,
    ">": operator.gt,
}


def keep_where(df: DataFrame, column: str, compare: str, value: Column | object) -> DataFrame:
    """Rows whose column compares true with the value; rows with NULL are dropped."""
    return df.filter(_COMPARE[compare](F.col(column), value))


def keep_present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that have a value in every named column."""
    return df.dropna(how="any", subset=list(columns))


def first_match(rules: list[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """The value of the first rule that holds. Without ``otherwise`` an unmatched row fails the job."""
    (condition, value), *rest = rules
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    if otherwise is None:
        otherwise = F.raise_error(F.lit("no rule matches this row"))
    return chain.otherwise(otherwise)

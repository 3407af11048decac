"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date patterns of the source files and the width of a padded day name.
ORDER_DATE_PATTERN = "MM-dd-yyyy"
EMPLOYEE_DATE_PATTERN = "dd-MM-yyyy"
DAY_NAME_WIDTH = 9


def parse_date(c: Column, pattern: str, strict: bool = False) -> Column:
    """Text to date. Text that does not fit is NULL, or fails the job when ``strict``."""
    return F.to_date(c, pattern) if strict else F.try_to_date(c, pattern)


def day_name(d: Column, padded: bool = True) -> Column:
    """English day name, blank-padded to the longest one unless ``padded`` is off."""
    name = F.date_format(d, "EEEE")
    return F.rpad(name, DAY_NAME_WIDTH, " ") if padded else name


def day_number(d: Column) -> Column:
    """0 = Sunday to 6 = Saturday (Spark's own numbering starts at 1)."""
    return F.dayofweek(d) - 1


def is_weekend(d: Column) -> Column:
    return day_number(d).isin(0, 6)

"""Window specifications shared by the operators.

Every series is keyed by (entity, date) with one row per date, so a window
partition holds at most one row per calendar day of history: partitions are
bounded by calendar length, never by input volume, even for a hot entity.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def day_number(date_col: str = "date") -> Column:
    """Days since epoch: lets ROWS and RANGE frames share one ordering."""
    return F.unix_date(F.col(date_col))


def ordered(entity, date_col: str = "date") -> WindowSpec:
    keys = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*keys).orderBy(day_number(date_col))


def trailing_rows(entity, rows: int, date_col: str = "date") -> WindowSpec:
    """Physical-row frame: the current row and ``rows - 1`` before it."""
    return ordered(entity, date_col).rowsBetween(-(rows - 1), Window.currentRow)


def trailing_days(entity, days: int, date_col: str = "date") -> WindowSpec:
    """Calendar frame: rows dated within [d - (days-1), d]."""
    return ordered(entity, date_col).rangeBetween(-(days - 1), Window.currentRow)


def running(entity, date_col: str = "date") -> WindowSpec:
    return ordered(entity, date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)

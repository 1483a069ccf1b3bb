"""Date and time expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: str | datetime | Column | None) -> Column:
    """A timestamp column: a given moment, or now."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.expr(f"CAST('{value}' AS TIMESTAMP)")


def month_start(day: str) -> Column:
    return F.expr(f"CAST(date_trunc('month', {day}) AS DATE)")

"""Joins of big tables to dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.keys import salted

# Slots NULL keys are spread over; they match nothing wherever they go.
NULL_SLOTS = 1024


def lookup(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    how: str = "inner",
    spread_by: str | None = None,
) -> DataFrame:
    """Join ``rows`` to a dimension that holds each key at most once.

    Spark chooses the join from the sizes in bytes it measures, and where it
    shuffles, AQE splits the partition of a hot key.  Rows without a key all hash alike, so for joins
    that keep them, ``spread_by`` deals them out over many partitions.
    """
    if spread_by is None or how == "inner":
        return rows.join(dimension, key, how)
    salt = salted(f"{key} IS NULL", spread_by, NULL_SLOTS)
    return (
        rows.withColumn("_slot", salt)
        .join(dimension.withColumn("_slot", F.lit(0)), [key, "_slot"], how)
        .drop("_slot")
    )


def without_match(
    rows: DataFrame,
    other: DataFrame,
    key: str,
    spread_by: str,
) -> DataFrame:
    """Rows whose key is not in ``other``; a NULL key has no match and stays.

    No distinct step on ``other``: an anti join asks only whether a key exists.
    """
    return lookup(rows, other.select(key), key, "left_anti", spread_by)

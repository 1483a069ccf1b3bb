"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakestrata.functions.keys import fingerprint


def recency_order() -> list[Column]:
    """Total order over versions of one business key, newest first.

    All rows of one load share their ingest time, so path and content
    fingerprint settle the rest: the winner never depends on row order.
    """
    return [
        F.col("_ingest_ts").desc(),
        F.col("_source_path").asc_nulls_first(),
        F.col("_bronze_row_key").asc_nulls_first(),
    ]


def latest_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """The first row of every key in the given order.

    Spark cuts each key to one row per task before the shuffle, so a key with
    a third of all rows sends no more than one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*(order or recency_order()))
    return (
        df.withColumn("_version", F.row_number().over(window))
        .filter("_version = 1")
        .drop("_version")
    )


def latest_content(df: DataFrame, keys: Sequence[str], content: Sequence[str]) -> DataFrame:
    """``latest_by`` for rows whose fingerprint is that of the columns ``content``.

    The newest rows of a key are found without it; where several share time and path,
    it settles them after the shuffle, which thus moves no fingerprints.
    """
    newest = Window.partitionBy(*keys).orderBy(*recency_order()[:2])
    tied = (
        df.drop("_bronze_row_key")
        .withColumn("_version", F.rank().over(newest))
        .filter("_version = 1")
        .drop("_version")
    )
    keyed = tied.withColumn("_bronze_row_key", fingerprint(*content))
    return latest_by(keyed, keys, recency_order()[2:]).select(*df.columns)


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> DataFrame:
    """Pass rows through; fail the job when a key comes twice.

    The check rides on the key partitioning a following join needs anyway.
    """
    window = Window.partitionBy(*keys).orderBy(*keys)
    failure = f"CAST(raise_error('duplicate key in {what}: {', '.join(keys)}') AS BOOLEAN)"
    return (
        df.withColumn("_copy", F.row_number().over(window))
        .filter(f"IF(_copy > 1, {failure}, TRUE)")
        .drop("_copy")
    )

"""Exact distinct counts that add up: a stored bitmap of ids per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_state(df: DataFrame, groups: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """(groups, id_name, bucket, n_rows, bitmap): which ids each group holds.

    A bitmap is a LONG, one bit for each of 64 neighbouring ids, so dense ids take a
    fraction of a byte each, sparse ones a row of a few bytes, and a hot id one bit in
    every task's partial bitmap.  Ids are integers of any sign; null ids are no ids and count as no rows.
    """
    parts = [
        df.filter(F.col(name).isNotNull())
        .select(*groups, F.lit(name).alias("id_name"), F.col(name).cast("bigint").alias("_id"))
        .groupBy(*groups, "id_name", F.expr("shiftright(_id, 6)").alias("bucket"))
        .agg(
            F.count("*").alias("n_rows"),
            F.bit_or(F.expr("shiftleft(1L, CAST(_id & 63 AS INT))")).alias("bitmap"),
        )
        for name in ids
    ]
    return reduce(DataFrame.unionByName, parts)


def merge_states(state: DataFrame, groups: Sequence[str]) -> DataFrame:
    """A state by coarser groups, or of several loads, from finer ones; no ids are read."""
    return state.groupBy(*groups, "id_name", "bucket").agg(
        F.sum("n_rows").alias("n_rows"), F.bit_or("bitmap").alias("bitmap")
    )


def distinct_counts(state: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows, distinct ids and surplus rows of each group, from states of finer ones."""
    return (
        merge_states(state, groups)
        .groupBy(*groups, "id_name")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum(F.bit_count("bitmap")).alias("n_distinct"),
        )
        .withColumn("surplus", F.col("n_rows") - F.col("n_distinct"))
    )

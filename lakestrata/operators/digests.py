"""Comparing the contents of two tables by order-free digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multiset_digest(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """(group, n_rows, hash_sum, hash_xor) over rows as a multiset.

    Neither order nor partitions matter; the sum tells copies of a row, which cancel
    in the xor.  Nulls and their places count: every cell goes in with a null flag.
    """
    cells = [c for name in columns for c in (F.col(name), F.col(name).isNull())]
    return (
        df.select(group, F.xxhash64(*cells).alias("_hash"))
        .groupBy(group)
        .agg(
            F.count("*").alias("n_rows"),
            F.sum(F.col("_hash").cast("decimal(38,0)")).alias("hash_sum"),
            F.bit_xor("_hash").alias("hash_xor"),
        )
    )


def unequal_groups(
    left: DataFrame, right: DataFrame, group: str, columns: Sequence[str]
) -> DataFrame:
    """The groups whose rows differ between two tables, a missing group included."""
    parts = ("n_rows", "hash_sum", "hash_xor")
    ours, theirs = (
        multiset_digest(side, group, columns).withColumnsRenamed(
            {name: f"_{label}_{name}" for name in (group, *parts)}
        )
        for side, label in ((left, "l"), (right, "r"))
    )
    same = F.col(f"_l_{group}").eqNullSafe(F.col(f"_r_{group}"))
    differ = " OR ".join(f"NOT _l_{name} <=> _r_{name}" for name in parts)
    return ours.join(theirs, same, "full_outer").filter(differ).select(
        # Which of both is null says nothing of a null group: counts do.
        F.expr(f"IF(_l_n_rows IS NULL, _r_{group}, _l_{group})").alias(group)
    )


def content_differences(
    left: DataFrame, right: DataFrame, group: str, columns: Sequence[str]
) -> DataFrame:
    """Rows that one table holds more often than the other, with both numbers.

    ``group`` is one of ``columns``.  Digests come first; only the groups they tell
    apart are compared by row, as counts of equal rows.
    """
    groups = unequal_groups(left, right, group, columns).withColumnRenamed(group, "_group")

    def side(df: DataFrame, in_left: int) -> DataFrame:
        of_group = df[group].eqNullSafe(groups["_group"])
        rows = df.join(groups, of_group, "left_semi").select(*columns)
        return rows.withColumn("_left", F.lit(in_left)).withColumn("_right", F.lit(1 - in_left))

    return (
        side(left, 1)
        .unionByName(side(right, 0))
        .groupBy(*columns)
        .agg(F.sum("_left").alias("n_left"), F.sum("_right").alias("n_right"))
        .filter("n_left <> n_right")
    )

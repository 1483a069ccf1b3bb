"""Dense numbering 1..N over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakestrata.operators.staging import stage

# monotonically_increasing_id keeps the row number inside a partition in its
# lower bits and the partition number above them.
_ROW_BITS = 33


def with_surrogate_key(
    df: DataFrame,
    order: str,
    name: str,
    start: Column | int = 0,
) -> DataFrame:
    """Number the rows by ``order``, a column without duplicates.

    Rows are placed in ranges of ``order``, sorted and numbered inside each
    range, and shifted by the sizes of the ranges before: one shuffle, no
    single task.  The placed rows are written once, so both passes
    see the same ranges whatever is recomputed later.
    """
    base = F.lit(start) if isinstance(start, int) else start
    placed = stage(
        df.repartitionByRange(F.col(order).asc_nulls_first())
        .sortWithinPartitions(F.col(order).asc_nulls_first())
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    )
    range_id = F.shiftright("_place", _ROW_BITS)
    sizes = placed.groupBy(range_id.alias("_range")).agg(F.count("*").alias("_size"))
    # One row per range, that is per shuffle partition: small by construction.
    before = Window.orderBy("_range").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    offsets = sizes.select(
        "_range", (F.sum("_size").over(before) - F.col("_size")).alias("_offset")
    )
    row_in_range = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_range", range_id)
        .join(F.broadcast(offsets), "_range")
        .withColumn(
            name, (base + F.col("_offset") + row_in_range + F.lit(1)).cast("bigint")
        )
        .select(*df.columns, name)
    )

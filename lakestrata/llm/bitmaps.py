"""Bitmaps that tell, where rows are read, which of them need not be sent on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a bitmap: 8 MB, whatever the data.
MARKS = 2**26
_BUCKET = 2**15  # bits of one of its rows


def marks_of(numbers: DataFrame) -> DataFrame:
    """bucket and bitmap: the values of the column ``number``, each below ``MARKS``."""
    return numbers.groupBy(F.expr(f"number div {_BUCKET}").alias("bucket")).agg(
        F.bitmap_construct_agg(F.expr(f"number % {_BUCKET}")).alias("bitmap")
    )


def with_mark(rows: DataFrame, number: Column, numbers: DataFrame, name: str) -> DataFrame:
    """The rows with a flag: false where ``numbers`` does not hold the row's number.

    Rows of other keys may share a number, so true says no more than perhaps.
    """
    marks = F.broadcast(marks_of(numbers))  # at most 2,048 rows of 4 KB
    numbered = rows.withColumn("number", number)
    byte = f"cast(number % {_BUCKET} div 8 as int) + 1"
    bit = f"""getbit(
        cast(conv(hex(substring(bitmap, {byte}, 1)), 16, 10) as int),
        cast(number % 8 as int))"""
    return (
        numbered.join(marks, F.expr(f"number div {_BUCKET}") == F.col("bucket"), "left")
        .withColumn(name, F.expr(f"coalesce({bit} = 1, false)"))
        .drop("number", "bucket", "bitmap")
    )

"""CSV export and a quick look."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.sources.feeds import CSV_OPTIONS


def write_csv(df: DataFrame, path: str) -> str:
    """Overwrite a folder with header CSV files, written by all tasks."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def write_ordered_csv(df: DataFrame, path: str, by: Sequence[str]) -> str:
    """Overwrite a folder with parts of one CSV file, in order, written by all tasks.

    Rows are put into ranges of ``by`` and, where that is equal, of all other columns,
    so a value that a third of all rows have takes many parts.  The header stands in
    the first part only: the parts, in the order of their names, are one CSV file.
    Nulls come first, an empty table gives the header alone, and equal rows, whose
    lines are equal too, come in any order.
    """
    options = {key: value for key, value in CSV_OPTIONS.items() if key != "header"}
    names = F.struct(*(F.lit(name).alias(f"c{k}") for k, name in enumerate(df.columns)))
    # Columns by place: names may repeat those made here.
    rows = df.toDF(*(f"c{k}" for k in range(len(df.columns))))
    first = [f"c{df.columns.index(name)}" for name in by]
    order = [*first, *(name for name in rows.columns if name not in first)]
    lines = rows.select(
        F.lit(1).alias("part"), *order, F.to_csv(F.struct(*rows.columns), options).alias("value")
    )
    header = df.sparkSession.range(1).select(
        F.lit(0).alias("part"), F.to_csv(names, options).alias("value")
    )
    placed = lines.unionByName(header, allowMissingColumns=True)
    placed = placed.repartitionByRange("part", *order).sortWithinPartitions("part", *order)
    placed.select("value").write.mode("overwrite").text(path)
    return path


def show_overview(label: str, df: DataFrame, sample: int = 5) -> None:
    """Print schema, row count and some rows."""
    print(f"== {label}")
    df.printSchema()
    print(f"{df.count()} rows")
    df.show(sample, truncate=False)

"""Catalog tables and session facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.contracts import TableContract


def require_table(spark: SparkSession, table: str) -> None:
    if not spark.catalog.tableExists(table):
        raise RuntimeError(f"table {table} does not exist: run ensure_tables first")


def read_table(spark: SparkSession, contract: TableContract) -> DataFrame:
    """The table with exactly its contract columns, in contract order."""
    require_table(spark, contract.table)
    return spark.table(contract.table).select(*contract.names)


def read_months(
    spark: SparkSession,
    contract: TableContract,
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """The rows of whole months, ``first`` and ``last`` naming any day of theirs.

    The table is partitioned by a month it derives from its rows, so other
    months are not even listed.
    """
    require_table(spark, contract.table)
    rows = spark.table(contract.table)
    for bound, sign in ((first, ">="), (last, "<=")):
        if bound:
            rows = rows.filter(
                f"{contract.partition} {sign} CAST(trunc(DATE'{bound}', 'MM') AS DATE)"
            )
    return rows.select(*contract.names)


def rows_of_keys(spark: SparkSession, contract: TableContract, keys: DataFrame) -> DataFrame:
    """The rows whose columns named like those of ``keys`` hold one of its rows.

    Of a partitioned table the partitions that hold them are found first, by a scan
    of the key columns alone; no other is read whole.
    """
    require_table(spark, contract.table)
    rows, names = spark.table(contract.table), keys.columns
    if contract.partition:
        place = F.col(contract.partition)
        held = rows.join(keys, names, "left_semi").select(place.cast("string")).distinct()
        kind = contract.stored_columns()[-1][1].simpleString()
        values = [F.lit(row[0]).cast(kind) for row in held.toLocalIterator()]
        rows = rows.filter(place.isin(values) if values else F.lit(False))
    return rows.join(keys, names, "left_semi").select(*contract.names)


def register_views(spark: SparkSession, contracts: dict[str, TableContract]) -> list[str]:
    """A temporary view per table, named like it, with the contract columns only."""
    for contract in contracts.values():
        read_table(spark, contract).createOrReplaceTempView(contract.name)
    return [contract.name for contract in contracts.values()]


def session_info(spark: SparkSession) -> DataFrame:
    """Who is asking, and when."""
    return spark.range(1).select(
        F.current_user().alias("user"), F.current_timestamp().alias("ts")
    )

"""Run queries beside their SQL and compare the rows, order aside.

    python -m verification.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from lakestrata.session import local_session
from verification.oracle import ORACLE_SQL
from verification.queries import QUERIES, Query

Rows = tuple[list[tuple[str, str]], Counter]

# Names of the same type on both sides.
TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def _counted(columns: list[tuple[str, str]], rows: list[tuple]) -> Rows:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = Counter(tuple(repr(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], cells


def spark_rows(df: DataFrame) -> Rows:
    columns = [(name, TYPES.get(kind, kind)) for name, kind in df.dtypes]
    return _counted(columns, [tuple(row) for row in df.collect()])


def oracle_rows(sf_dir: str, sql: str) -> Rows:
    with duckdb.connect() as connection:
        connection.execute("SET TimeZone = 'UTC'")
        for file in Path(sf_dir).glob("*.parquet"):
            connection.execute(
                f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')"
            )
        result = connection.execute(sql)
        columns = [(c[0], str(c[1])) for c in result.description]
        return _counted(columns, result.fetchall())


def difference(spark: SparkSession, sf_dir: str, query: Query, sql: str) -> str | None:
    """What differs between the results of a query and of its SQL, or None."""
    ours, theirs = spark_rows(query(spark, sf_dir)), oracle_rows(sf_dir, sql)
    if ours[0] != theirs[0]:
        return f"columns {set(ours[0]) ^ set(theirs[0])}"
    only_ours, only_theirs = ours[1] - theirs[1], theirs[1] - ours[1]
    if only_ours or only_theirs:
        return (
            f"{sum(ours[1].values())} / {sum(theirs[1].values())} rows, "
            f"{sum(only_ours.values())} / {sum(only_theirs.values())} unmatched, e.g.\n"
            f"  {next(iter(only_ours), None)}\n  {next(iter(only_theirs), None)}"
        )
    return None


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = local_session(**{"spark.ui.enabled": "false"})
    failures = 0
    for name in arguments[1:] or QUERIES:
        start = time.perf_counter()
        found = difference(spark, sf_dir, QUERIES[name], ORACLE_SQL[name])
        failures += found is not None
        print(f"{name:28} {time.perf_counter() - start:6.2f}s {found or 'equal'}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

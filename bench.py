"""Headline timings, printed as one JSON line.

Each query: one warm-up, then the median of three runs, its result consumed by
the noop sink.  The layered run loads CSV feeds made from the same tables into
empty tables, then loads them again.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakestrata.contracts import ensure_tables
from lakestrata.operators.sequence import with_surrogate_key
from lakestrata.plans import silver
from lakestrata.plans.run import RunConfig, run_layers
from lakestrata.session import local_session
from lakestrata.sinks.csv import write_csv
from lakestrata.sinks.tables import merge_table
from lakestrata.sources.tables import read_table
from verification import sample_feeds as feed
from verification.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "feed_transactions",
    "bronze_upsert",
    "latest_transactions",
    "dim_customer",
    "surrogate_key",
    "quarantine_rows",
    "fact_transaction",
    "scd2_apply",
    "daily_revenue",
    "customer_spend_by_month",
    "category_sales_daily",
    "rank_within",
    "gold_daily_upsert",
    "change_set",
)


def _consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(action: Callable[[], None]) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def _median(action: Callable[[], None], runs: int = 3) -> float:
    action()
    return statistics.median(_timed(action) for _ in range(runs))


def time_queries(spark: SparkSession) -> dict[str, float]:
    times = {
        name: _median(lambda query=QUERIES[name]: _consume(query(spark, SF_DIR)))
        for name in HEADLINE
    }

    def distributed_dimension() -> None:
        state = silver.customer_state(feed.customers_feed(spark, SF_DIR))
        _consume(with_surrogate_key(state, "customer_id", "customer_sk"))

    times["dim_customer_distributed_key"] = _median(distributed_dimension)
    return times


def time_layers(spark: SparkSession, folder: str) -> dict[str, float]:
    """Two runs over the same feeds, then merges into the loaded tables."""
    paths = {}
    for name, rows in (
        ("customers", feed.customers_feed(spark, SF_DIR)),
        ("products", feed.products_feed(spark, SF_DIR)),
        ("transactions", feed.transactions_feed(spark, SF_DIR)),
    ):
        columns = feed.FEEDS[name].contract.feed_columns
        paths[name] = write_csv(rows.select(*columns), f"{folder}/{name}")
    ensure_tables(spark, feed.CONTRACTS)
    cfg = RunConfig(paths, on_match="keep", as_of=feed.AS_OF, contracts=feed.CONTRACTS)
    times = {
        "layers_first_run": _timed(lambda: run_layers(spark, cfg).collect()),
        "layers_second_run": _timed(lambda: run_layers(spark, cfg).collect()),
    }
    contract = feed.CONTRACTS["gold.customer_spend_by_month"]
    spend = read_table(spark, contract)
    last_month = spend.filter("month = (SELECT max(month) FROM gold.customer_spend_by_month)")
    times["merge_all_months"] = _timed(lambda: merge_table(spark, contract, spend))
    times["merge_one_month"] = _timed(lambda: merge_table(spark, contract, last_month))
    return times


def main() -> None:
    folder = tempfile.mkdtemp(prefix="lakestrata-bench-")
    spark = local_session(
        CPUS,
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
        },
    )
    times = {**time_queries(spark), **time_layers(spark, folder)}
    spark.stop()
    result = {
        "metric": "layered_retail_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in times.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    sys.exit(main())

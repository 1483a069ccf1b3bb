"""The ordered run: bronze, silver, gold, with a run log."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.contracts import TableContract, audit_contract, build_contracts
from lakestrata.operators.audit import audit_after
from lakestrata.operators.history import scd2_apply
from lakestrata.plans import gold, silver, validation
from lakestrata.plans.bronze import load_feeds
from lakestrata.session import side_by_side
from lakestrata.sinks.tables import append_run, append_table, merge_table, replace_table
from lakestrata.sources.feeds import feeds
from lakestrata.sources.tables import read_months, read_table

HISTORY, CURRENT = "history", "current"


@dataclass(frozen=True)
class RunConfig:
    """What one run does.

    ``dimensions="current"`` rebuilds the dimensions with one row per key;
    ``"history"`` closes and opens versions instead.  ``quarantine`` is
    "replace", "append", or "audit", which keeps one row for each finding in the
    table of ``audit_contract`` and is repeatable by ``run_id``.  ``as_of`` stamps validity and audit rows, so that a
    repeated run gives the same tables.  ``gold_from`` limits the gold layer to
    the month of a day and all later ones; older mart rows stay as they are.
    """

    feed_paths: dict[str, str] = field(default_factory=dict)
    on_match: str = "touch"
    as_of: str | datetime | None = None
    dimensions: str = CURRENT
    quarantine: str = "replace"
    delete_missing: bool = False
    gold_from: str | None = None
    run_id: str | None = None
    contracts: dict[str, TableContract] = field(default_factory=build_contracts)

    def stamped(self, spark: SparkSession) -> RunConfig:
        """The same run with its moment fixed, in the session's time zone."""
        if self.as_of:
            return self
        now = spark.range(1).select(F.current_timestamp().cast("string")).first()[0]
        return replace(self, as_of=now)


def read_layer(spark: SparkSession, cfg: RunConfig, table: str) -> DataFrame:
    return read_table(spark, cfg.contracts[table])


def log_layer(spark: SparkSession, cfg: RunConfig, layer: str, reached) -> None:
    """Log a finished layer.  An empty layer has reached no data time."""
    if reached is not None:
        append_run(
            spark, cfg.contracts["meta.layer_run_state"], layer, reached, cfg.run_id
        )


def newest_ingest(spark: SparkSession, cfg: RunConfig) -> str | None:
    newest = [
        read_layer(spark, cfg, f"bronze.{name}").agg(F.max("_ingest_ts").alias("ts"))
        for name in feeds(cfg.contracts)
    ]
    both = newest[0].unionByName(newest[1]).unionByName(newest[2])
    return both.agg(F.max("ts").cast("string")).first()[0]


def run_bronze(spark: SparkSession, cfg: RunConfig) -> None:
    rejects = cfg.contracts["bronze.feed_rejects"]
    sources = [
        (feed, cfg.feed_paths[name])
        for name, feed in feeds(cfg.contracts).items()
        if name in cfg.feed_paths
    ]
    load_feeds(spark, sources, rejects, cfg.on_match, cfg.as_of)
    log_layer(spark, cfg, "bronze", newest_ingest(spark, cfg))


def _refresh_dimension(spark: SparkSession, cfg: RunConfig, entity: str) -> None:
    contract = cfg.contracts[f"silver.dim_{entity}"]
    bronze = read_layer(spark, cfg, f"bronze.{entity}s")
    if cfg.dimensions == HISTORY:
        state = getattr(silver, f"{entity}_state")(bronze)
        dimension = scd2_apply(
            read_table(spark, contract),
            state,
            f"{entity}_id",
            f"{entity}_sk",
            cfg.as_of,
        )
    else:
        build = getattr(silver, f"dim_{entity}")
        dimension = build(bronze, cfg.as_of)
    replace_table(spark, contract, dimension)


def run_silver(spark: SparkSession, cfg: RunConfig) -> None:
    """Dimensions first: the fact reads the keys just written."""
    cfg = cfg.stamped(spark)
    side_by_side(
        spark,
        [partial(_refresh_dimension, spark, cfg, e) for e in ("customer", "product")],
    )
    transactions = read_layer(spark, cfg, "bronze.transactions")
    products = read_layer(spark, cfg, "bronze.products")
    audit = silver.quarantine_rows(
        transactions,
        products,
        read_layer(spark, cfg, "bronze.customers"),
        cfg.as_of,
        read_layer(spark, cfg, "bronze.feed_rejects"),
    )
    if cfg.quarantine == "audit":
        contract = audit_contract(cfg.contracts["silver.quarantine_rows"].prefix)
        run_id = cfg.run_id or str(cfg.as_of)
        after = audit_after(read_table(spark, contract), audit, run_id, cfg.as_of)
        replace_table(spark, contract, after)
    else:
        write = append_table if cfg.quarantine == "append" else replace_table
        write(spark, cfg.contracts["silver.quarantine_rows"], audit)
    customers = read_layer(spark, cfg, "silver.dim_customer")
    dim_product = read_layer(spark, cfg, "silver.dim_product")
    fact = silver.fact_transaction(transactions, dim_product, customers)
    replace_table(spark, cfg.contracts["silver.fact_transaction"], fact)
    log_layer(spark, cfg, "silver", newest_ingest(spark, cfg))


def run_gold(spark: SparkSession, cfg: RunConfig) -> None:
    if cfg.gold_from and cfg.delete_missing:
        raise ValueError("delete_missing needs the whole fact: leave out gold_from")
    fact = read_months(
        spark, cfg.contracts["silver.fact_transaction"], first=cfg.gold_from
    )
    customers = read_layer(spark, cfg, "silver.dim_customer")
    products = read_layer(spark, cfg, "silver.dim_product")
    marts = {
        "gold.daily_revenue": lambda: gold.daily_revenue(fact),
        "gold.customer_spend_by_month": lambda: gold.customer_spend_by_month(fact, customers),
        "gold.category_sales_daily": lambda: gold.category_sales_daily(fact, products),
    }

    def refresh(table: str) -> None:
        contract, mart = cfg.contracts[table], marts[table]()
        merge_table(spark, contract, mart, delete_missing=cfg.delete_missing)

    side_by_side(spark, [partial(refresh, table) for table in marts])
    reached = fact.agg(F.max("transaction_timestamp").cast("string")).first()[0]
    log_layer(spark, cfg, "gold", reached)


def run_layers(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """All layers in order; returns the row counts of their tables."""
    cfg = cfg.stamped(spark)
    run_bronze(spark, cfg)
    run_silver(spark, cfg)
    run_gold(spark, cfg)
    return summary(spark, cfg)


def summary(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    tables = {
        contract.name: read_table(spark, contract)
        for contract in cfg.contracts.values()
        if contract.layer != "meta"
    }
    return validation.layer_summary(spark, tables)


def validate(spark: SparkSession, cfg: RunConfig) -> dict[str, DataFrame]:
    """All checks over the stored tables, by name."""
    bronze = {
        name: (read_layer(spark, cfg, f"bronze.{name}"), feed.business_key)
        for name, feed in feeds(cfg.contracts).items()
    }
    customers = read_layer(spark, cfg, "silver.dim_customer")
    products = read_layer(spark, cfg, "silver.dim_product")
    fact = read_layer(spark, cfg, "silver.fact_transaction")
    daily = read_layer(spark, cfg, "gold.daily_revenue")
    return {
        "key_counts": validation.key_counts(bronze),
        "duplicate_counts": validation.duplicate_counts(bronze),
        "dimension_health": validation.dimension_health(
            {
                "dim_customer": (customers, "customer_id"),
                "dim_product": (products, "product_id"),
            }
        ),
        "quarantine_by_reason": validation.quarantine_by_reason(
            read_layer(spark, cfg, "silver.quarantine_rows")
        ),
        "fact_enriched": validation.fact_enriched(fact, customers, products),
        "reconcile_revenue": validation.reconcile_revenue(spark, fact, daily),
        "content": validation.fact_content(
            read_layer(spark, cfg, "bronze.transactions"), products, fact
        ),
        "summary": summary(spark, cfg),
    }

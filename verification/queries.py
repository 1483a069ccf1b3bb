"""Queries over the given tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.contracts import (
    TableContract,
    audit_contract,
    build_contracts,
    change_contract,
    ensure_tables,
    incremental_contracts,
    ledger_contract,
)
from lakestrata.functions.keys import fingerprint
from lakestrata.operators.audit import audit_after
from lakestrata.operators.changes import change_set, incremental_since
from lakestrata.operators.dedupe import latest_by
from lakestrata.operators.distinct import distinct_counts, distinct_state, merge_states
from lakestrata.operators.history import scd2_apply, splice_versions
from lakestrata.operators.merge import upsert
from lakestrata.operators.ordered import valid_at
from lakestrata.operators.ranking import rank_within
from lakestrata.operators.sequence import with_surrogate_key
from lakestrata.operators.staging import stage
from lakestrata.plans import gold, silver, validation
from lakestrata.plans.bronze import distinct_content, load_feed
from lakestrata.plans.incremental import run_incremental
from lakestrata.plans.ledger import load_new_files
from lakestrata.plans.run import HISTORY, RunConfig
from lakestrata.session import shared_folder
from lakestrata.sinks import (
    merge_table,
    merge_with_changes,
    net_changes_between,
    replace_table,
    state_at,
    write_csv,
    write_ordered_csv,
)
from lakestrata.sources import feeds, read_table
from lakestrata.sources.feeds import CSV_OPTIONS
from lakestrata.streaming import ingest_new_files
from verification import sample_feeds as feed
from verification.sample_feeds import AS_OF, FEEDS, table

Query = Callable[[SparkSession, str], DataFrame]

# The split of the upsert queries: the source has all rows from the second
# moment on; the target those before, and the online channel up to the first.
TARGET_BEFORE = "2000-01-01"
SOURCE_FROM = "1999-07-01"


# ----------------------------------------------------------------- bronze


def feed_customers(spark, sf_dir):
    return feed.bronze_customers(spark, sf_dir)


def feed_products(spark, sf_dir):
    return feed.bronze_products(spark, sf_dir)


def feed_transactions(spark, sf_dir):
    return feed.bronze_transactions(spark, sf_dir)


def row_key(spark, sf_dir):
    return feed.customers_feed(spark, sf_dir).select(
        "customer_id",
        "_source_path",
        fingerprint(*FEEDS["customers"].contract.feed_columns).alias("row_key"),
    )


def _bronze_states(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Stored transactions (the online channel) and a later load.

    The load brings the store rows as new ones and re-reads online rows of big
    quantities, so every row is in one of the two.
    """
    stored = feed.transactions_feed(spark, sf_dir).filter("channel = 'online'")
    later = feed.transactions_feed(spark, sf_dir, "3").filter(
        "channel = 'store' OR quantity >= 25"
    )
    return distinct_content(stored), distinct_content(later)


def bronze_upsert(spark, sf_dir):
    target, source = _bronze_states(spark, sf_dir)
    return upsert(target, source, ["_bronze_row_key"], source_unique=True)


def bronze_upsert_keep(spark, sf_dir):
    target, source = _bronze_states(spark, sf_dir)
    return upsert(target, source, ["_bronze_row_key"], "keep", source_unique=True)


def _bronze_tables(spark, sf_dir) -> dict[str, tuple[DataFrame, str]]:
    return {
        "customers": (feed.bronze_customers(spark, sf_dir), "customer_id"),
        "products": (feed.bronze_products(spark, sf_dir), "product_id"),
        "transactions": (feed.bronze_transactions(spark, sf_dir), "transaction_id"),
    }


def bronze_counts(spark, sf_dir):
    return validation.key_counts(_bronze_tables(spark, sf_dir))


def duplicate_counts(spark, sf_dir):
    return validation.duplicate_counts(_bronze_tables(spark, sf_dir))


def sample_rows(spark, sf_dir):
    return validation.sample_rows(
        feed.bronze_customers(spark, sf_dir), ["customer_id", "_bronze_row_key"], 3
    )


def incremental_rows(spark, sf_dir):
    stored = feed.bronze_customers(spark, sf_dir)
    return incremental_since(stored, "_ingest_ts", "2024-01-01 00:00:00")


# ----------------------------------------------------------------- silver
#
# Exact copies share path, time and fingerprint, so the latest row per business
# key is the same over the feed as over bronze; these queries skip that step.


def latest_customers(spark, sf_dir):
    return latest_by(feed.customers_feed(spark, sf_dir), ["customer_id"])


def latest_products(spark, sf_dir):
    return latest_by(feed.products_feed(spark, sf_dir), ["product_id"])


def latest_transactions(spark, sf_dir):
    return latest_by(feed.transactions_feed(spark, sf_dir), ["transaction_id"])


def clean_customers(spark, sf_dir):
    return silver.customer_state(feed.customers_feed(spark, sf_dir)).drop("row_hash")


def customer_row_hash(spark, sf_dir):
    state = silver.customer_state(feed.customers_feed(spark, sf_dir))
    return state.select("customer_id", "row_hash")


def surrogate_key(spark, sf_dir):
    """Orders numbered by key, the distributed way whatever their number."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return with_surrogate_key(orders, "o_orderkey", "order_sk")


def _dim_customer(spark, sf_dir) -> DataFrame:
    return silver.dim_customer(
        feed.customers_feed(spark, sf_dir), AS_OF
    )


def _dim_product(spark, sf_dir) -> DataFrame:
    return silver.dim_product(
        feed.products_feed(spark, sf_dir), AS_OF
    )


def _open_end_as_text(dimension: DataFrame) -> DataFrame:
    """The open end lies beyond what nanosecond timestamps can hold."""
    return dimension.withColumn("valid_to", F.col("valid_to").cast("string"))


def dim_customer(spark, sf_dir):
    return _open_end_as_text(_dim_customer(spark, sf_dir))


def dim_product(spark, sf_dir):
    return _open_end_as_text(_dim_product(spark, sf_dir))


def dim_health(spark, sf_dir):
    return validation.dimension_health(
        {
            "dim_customer": (_dim_customer(spark, sf_dir), "customer_id"),
            "dim_product": (_dim_product(spark, sf_dir), "product_id"),
        }
    )


def quarantine_missing_product(spark, sf_dir):
    return silver.missing_products(
        feed.bronze_transactions(spark, sf_dir),
        feed.products_feed(spark, sf_dir),
    )


def _quarantine(spark, sf_dir) -> DataFrame:
    return silver.quarantine_rows(
        feed.bronze_transactions(spark, sf_dir),
        feed.products_feed(spark, sf_dir),
        feed.customers_feed(spark, sf_dir),
        AS_OF,
    )


def quarantine_rows(spark, sf_dir):
    return _quarantine(spark, sf_dir)


def quarantine_by_reason(spark, sf_dir):
    return validation.quarantine_by_reason(_quarantine(spark, sf_dir))


def _fact(
    spark, sf_dir, customers: DataFrame | None = None, products: DataFrame | None = None
) -> DataFrame:
    """The fact; queries that read a dimension again pass it in as written once."""
    return silver.fact_transaction(
        feed.transactions_feed(spark, sf_dir),
        _dim_product(spark, sf_dir) if products is None else products,
        _dim_customer(spark, sf_dir) if customers is None else customers,
    )


def fact_transaction(spark, sf_dir):
    return _fact(spark, sf_dir)


def fact_enriched(spark, sf_dir):
    customers = stage(_dim_customer(spark, sf_dir), "dim_customer")
    products = stage(_dim_product(spark, sf_dir), "dim_product")
    fact = _fact(spark, sf_dir, customers, products)
    return validation.fact_enriched(
        fact,
        customers,
        products,
    )


def scd2_history(spark, sf_dir):
    """First batch as the dimension, then the second batch as its changes."""
    rows = feed.customers_feed(spark, sf_dir)
    first = rows.filter("_source_path = 'batch-1'")
    dimension = stage(silver.dim_customer(first, AS_OF), "dim_customer")
    incoming = silver.customer_state(rows)
    after = scd2_apply(
        dimension, incoming, "customer_id", "customer_sk", "2024-03-01 00:00:00",
    )
    return _open_end_as_text(after)


def _priority_history(spark, sf_dir) -> DataFrame:
    """Order priorities as states of a customer; statuses arrive one after the other,
    so most rows of the later batches lie between those known."""
    states = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").cast("timestamp").alias("as_of_ingest_ts"),
        F.col("o_orderpriority").alias("row_hash"),
        F.col("o_orderstatus").alias("status"),
    )
    seen = states.drop("status").limit(0)
    history = seen.selectExpr(
        "CAST(NULL AS BIGINT) AS customer_sk",
        "*",
        "as_of_ingest_ts AS valid_from",
        "as_of_ingest_ts AS valid_to",
        "TRUE AS is_current",
    )
    for status in ("O", "F", "P"):
        batch = states.filter(F.col("status") == status).drop("status")
        history, seen = splice_versions(history, seen, batch, "customer_id", "customer_sk")
        history = stage(history, "history")
    return history


def late_versions(spark, sf_dir):
    """The history without its surrogate keys, whose numbers follow the batches."""
    history = _priority_history(spark, sf_dir).drop("row_hash", "as_of_ingest_ts")
    return _open_end_as_text(history.drop("customer_sk"))


def version_at(spark, sf_dir):
    """Every line item with its customer's state at the time it was shipped."""
    history = _priority_history(spark, sf_dir)
    shipped = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders").hint("merge"), F.expr("l_orderkey = o_orderkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            F.expr("IF(o_totalprice >= 6000, o_custkey, NULL)").alias("customer_id"),
            F.expr("CAST(l_shipdate AS TIMESTAMP) - INTERVAL 60 DAYS").alias("asked_at"),
        )
    )
    return valid_at(shipped, "customer_id", "asked_at", history, ["priority", "valid_from"])


# ------------------------------------------------------------------- gold


def daily_revenue(spark, sf_dir):
    return gold.daily_revenue(_fact(spark, sf_dir))


def net_revenue(spark, sf_dir):
    """Daily totals of discounted prices, which have four decimals."""
    net = table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_shipdate AS DATE) AS order_date",
        "round(l_extendedprice * (1 - l_discount), 4) AS transaction_amount",
        "l_orderkey * 8 + l_linenumber AS transaction_id",
    )
    return gold.daily_revenue(net, ids_unique=False)


def ranked_text(spark, sf_dir):
    """Customers ranked by market segment per nation: text, and ties."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment"
    )
    return rank_within(customers, "c_nationkey", "c_mktsegment", "segment_rank")


def customer_spend_by_month(spark, sf_dir):
    customers = stage(_dim_customer(spark, sf_dir), "dim_customer")
    return gold.customer_spend_by_month(
        _fact(spark, sf_dir, customers=customers),
        customers,
    )


def category_sales_daily(spark, sf_dir):
    products = stage(_dim_product(spark, sf_dir), "dim_product")
    fact = _fact(spark, sf_dir, products=products)
    return gold.category_sales_daily(fact, products)


def ranked_orders(spark, sf_dir):
    """Orders ranked by price per priority.

    Prices are rounded to thousands, so ties are many.
    """
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_orderpriority",
        "CAST(floor(o_totalprice / 1000) * 1000 AS DOUBLE) AS price",
    )
    return rank_within(orders, "o_orderpriority", "price", "price_rank")


def _two_states(spark, sf_dir, **dimensions) -> tuple[DataFrame, DataFrame]:
    """Facts of the target and of the source; the fact is computed once."""
    fact = stage(_fact(spark, sf_dir, **dimensions), "fact")
    before = fact.filter(
        f"order_date < DATE'{SOURCE_FROM}' "
        f"OR (channel = 'online' AND order_date < DATE'{TARGET_BEFORE}')"
    )
    return before, fact.filter(f"order_date >= DATE'{SOURCE_FROM}'")


def _daily_states(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    before, after = _two_states(spark, sf_dir)
    return gold.daily_revenue(before), gold.daily_revenue(after)


def gold_daily_upsert(spark, sf_dir):
    target, source = _daily_states(spark, sf_dir)
    return upsert(target, source, ["transaction_date"])


def gold_spend_upsert(spark, sf_dir):
    customers = stage(_dim_customer(spark, sf_dir), "dim_customer")
    target, source = (
        gold.customer_spend_by_month(fact, customers)
        for fact in _two_states(spark, sf_dir, customers=customers)
    )
    return upsert(target, source, ["month", "customer_id"])


def gold_category_upsert(spark, sf_dir):
    products = stage(_dim_product(spark, sf_dir), "dim_product")
    target, source = (
        gold.category_sales_daily(fact, products)
        for fact in _two_states(spark, sf_dir, products=products)
    )
    return upsert(target, source, ["transaction_date", "category"])


def daily_change_set(spark, sf_dir):
    target, source = _daily_states(spark, sf_dir)
    after = upsert(target, source, ["transaction_date"])
    return change_set(target, after, ["transaction_date"]).withColumnRenamed(
        "_change_type", "change_type"
    )


# ----------------------------------------------------------------- tables
#
# The same results by way of stored tables, in schemas of their own below the
# shared folder.


def _tables(spark, *names: str) -> dict[str, TableContract]:
    contracts = build_contracts("bigint", prefix=f"q{uuid4().hex[:12]}_")
    ensure_tables(
        spark,
        {name: contracts[name] for name in names},
        f"{shared_folder(spark)}/schemas",
    )
    return contracts


def _customer_csv(spark, sf_dir) -> tuple[str, list[str]]:
    columns = list(FEEDS["customers"].contract.feed_columns)
    path = f"{shared_folder(spark)}/feeds/customers-{uuid4().hex}"
    return write_csv(feed.customers_feed(spark, sf_dir).select(*columns), path), columns


def load_feed_twice(spark, sf_dir):
    """The customer feed as CSV, loaded twice: every content once."""
    contracts = _tables(spark, "bronze.customers", "bronze.feed_rejects")
    customers = feeds(contracts)["customers"]
    path, columns = _customer_csv(spark, sf_dir)
    for _ in range(2):
        load_feed(spark, customers, path, contracts["bronze.feed_rejects"])
    return read_table(spark, customers.contract).select(*columns, "_bronze_row_key")


def file_ingest(spark, sf_dir):
    """The same files by way of the stream, called twice."""
    contracts = _tables(spark, "bronze.customers", "bronze.feed_rejects")
    customers = feeds(contracts)["customers"]
    path, columns = _customer_csv(spark, sf_dir)
    checkpoint = f"{shared_folder(spark)}/streams/{uuid4().hex}"
    for _ in range(2):
        ingest_new_files(
            spark, customers, path, contracts["bronze.feed_rejects"], checkpoint
        )
    return read_table(spark, customers.contract).select(*columns, "_bronze_row_key")


def _bad_cells(spark, sf_dir) -> DataFrame:
    """Sales as CSV records: by quantity some are short, some long, some have a cell
    that is no number, no time, or absent."""
    return feed.transactions_feed(spark, sf_dir).selectExpr(
        "quantity",
        "channel",
        "IF(quantity = 47, ' ', CAST(transaction_id AS STRING)) AS id",
        "coalesce(CAST(customer_id AS STRING), '') AS customer",
        "CAST(product_id AS STRING) AS product",
        "CASE quantity WHEN 48 THEN 'n/a' WHEN 46 THEN 'Infinity' "
        "ELSE CAST(transaction_amount AS STRING) END AS amount",
        "IF(quantity = 45, 'noon', date_format(transaction_timestamp, 'yyyy-MM-dd HH:mm:ss')) "
        "AS moment",
    )


def _load_bad_sales(spark, sf_dir) -> dict[str, TableContract]:
    """Two folders of CSV files whose headers differ in order, loaded at once."""
    contracts = _tables(spark, "bronze.transactions", "bronze.feed_rejects")
    path = f"{shared_folder(spark)}/feeds/sales-{uuid4().hex}"
    cells = _bad_cells(spark, sf_dir)
    lines = {
        "online": (
            "transaction_id,customer_id,product_id,quantity,transaction_amount,"
            "transaction_timestamp,channel",
            ("id", "customer", "product", "quantity", "amount", "moment", "channel"),
        ),
        "store": (
            "channel,extra,transaction_timestamp,transaction_amount,quantity,product_id,"
            "customer_id,transaction_id",
            ("channel", "'\"a, b\"'", "moment", "amount", "quantity", "product", "customer", "id"),
        ),
    }
    for channel, (header, names) in lines.items():
        whole = f"concat_ws(',', {', '.join(names)})"
        record = (
            f"CASE quantity WHEN 50 THEN substring_index({whole}, ',', 4) "
            f"WHEN 49 THEN concat({whole}, ',more') ELSE {whole} END AS `{header}`"
        )
        # One column, so that a record is written as it is.
        written = cells.filter(F.col("channel") == channel).selectExpr(record).write
        written.options(**{**CSV_OPTIONS, "sep": "\x01", "quote": ""}).csv(
            f"{path}/{channel}", compression="gzip"
        )
    sales = feeds(contracts)["transactions"]
    load_feed(spark, sales, path, contracts["bronze.feed_rejects"], headers="any")
    return contracts


def load_feed_transactions(spark, sf_dir):
    """Good sales out of files with bad ones, typed, with their lineage."""
    contract = _load_bad_sales(spark, sf_dir)["bronze.transactions"]
    return read_table(spark, contract).select(
        *contract.feed_columns,
        "_bronze_row_key",
        F.expr(
            "endswith(_source_path, _source_name) AND _source_size_bytes > 0 "
            "AND contains(_source_path, concat('/', channel, '/'))"
        ).alias("has_lineage"),
    )


def feed_rejects(spark, sf_dir):
    """Bad sales by reason, in the audit's buckets, beside the number of good ones."""
    contracts = _load_bad_sales(spark, sf_dir)
    rejects = read_table(spark, contracts["bronze.feed_rejects"])
    good = read_table(spark, contracts["bronze.transactions"])
    counted = rejects.groupBy("feed", "reason").agg(
        F.count("*").alias("n_rows"), F.count_distinct("business_key").alias("n_keys")
    )
    buckets = validation.quarantine_by_reason(rejects).select(
        F.lit("bucket").alias("feed"),
        F.col("quarantine_category").alias("reason"),
        F.col("n").alias("n_rows"),
        F.lit(None).cast("bigint").alias("n_keys"),
    )
    stored = good.select(
        F.lit("good").alias("feed"), F.lit(None).cast("string").alias("reason"), "transaction_id"
    )
    return (
        counted.unionByName(buckets)
        .unionByName(
            stored.groupBy("feed", "reason").agg(
                F.count("*").alias("n_rows"),
                F.count_distinct("transaction_id").alias("n_keys"),
            )
        )
    )


def file_ledger(spark, sf_dir):
    """Customers as read by four calls over one folder: one part; another part that
    arrives; the first written anew with fewer rows; nothing."""
    contracts = _tables(spark, "bronze.customers", "bronze.feed_rejects")
    customers = feeds(contracts)["customers"]
    ledger = ledger_contract(customers.contract.prefix)
    ensure_tables(spark, {"ledger": ledger}, f"{shared_folder(spark)}/schemas")
    rows = feed.customers_feed(spark, sf_dir)
    columns = list(customers.contract.feed_columns)
    path = f"{shared_folder(spark)}/feeds/customers-{uuid4().hex}"
    first, second = "_source_path = 'batch-1'", "_source_path = 'batch-2'"
    arriving = (("a", first), ("b", second), ("a", f"{first} AND loyalty_tier = 'BUILDING'"), None)
    for call, part in enumerate(arriving, 1):
        if part:
            write_csv(rows.filter(part[1]).select(*columns), f"{path}/{part[0]}")
        load_new_files(
            spark,
            customers,
            path,
            contracts["bronze.feed_rejects"],
            ledger,
            ingest_ts=f"2024-03-0{call} 00:00:00",
        )
    return read_table(spark, customers.contract).select(
        *columns, "_bronze_row_key", F.day("_ingest_ts").alias("read_by")
    )


def replace_table_twice(spark, sf_dir):
    """The customer dimension, stored over an earlier state of itself."""
    contract = _tables(spark, "silver.dim_customer")["silver.dim_customer"]
    dimension = _dim_customer(spark, sf_dir)
    replace_table(spark, contract, dimension.filter("city = 'Moved'"))
    replace_table(spark, contract, dimension)
    return _open_end_as_text(read_table(spark, contract))


def merge_table_by_month(spark, sf_dir):
    """Both states of the spend mart, merged one after the other."""
    name = "gold.customer_spend_by_month"
    contract = _tables(spark, name)[name]
    customers = stage(_dim_customer(spark, sf_dir), "dim_customer")
    for fact in _two_states(spark, sf_dir, customers=customers):
        merge_table(spark, contract, gold.customer_spend_by_month(fact, customers))
    return read_table(spark, contract)


def _order_states(spark, sf_dir) -> TableContract:
    """A table of orders after three commits: inserts; updates and inserts; then its
    whole content once more as it is in the file, without the orders of one priority."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "CAST(trunc(o_orderdate, 'MM') AS DATE) AS order_month",
        "o_orderkey",
        "o_orderstatus AS status",
        "o_totalprice AS price",
        "o_orderpriority AS priority",
        "CAST(o_orderdate AS DATE) AS order_date",
    )
    contract = TableContract(
        "gold",
        "order_state",
        T.StructType.fromDDL(
            "order_month DATE NOT NULL, o_orderkey BIGINT NOT NULL, status STRING, "
            "price DOUBLE, priority STRING"
        ),
        keys=("order_month", "o_orderkey"),
        refresh="merge",
        partition="order_month",
        prefix=f"q{uuid4().hex[:12]}_",
    )
    ensure_tables(
        spark,
        {c.name: c for c in (contract, change_contract(contract))},
        f"{shared_folder(spark)}/schemas",
    )
    merge_with_changes(spark, contract, orders.filter(f"order_date < DATE'{TARGET_BEFORE}'"))
    dearer = orders.filter(f"order_date >= DATE'{SOURCE_FROM}'").withColumns(
        {"status": F.lit("X"), "price": F.col("price") * 2}
    )
    merge_with_changes(spark, contract, dearer)
    kept = orders.filter("priority <> '5-LOW'")
    merge_with_changes(spark, contract, kept, delete_missing=True)
    return contract


def change_feed(spark, sf_dir):
    """Net changes since the first commit, the state after the second, and the table."""
    contract = _order_states(spark, sf_dir)
    net = net_changes_between(spark, contract, 1).withColumnRenamed("_change_type", "what")
    second = state_at(spark, contract, 2).withColumn("what", F.lit("second"))
    now = read_table(spark, contract).withColumn("what", F.lit("table"))
    replayed = state_at(spark, contract).withColumn("what", F.lit("replayed"))
    return net.unionByName(second).unionByName(now).unionByName(replayed)


def _incremental_layers(spark, sf_dir) -> RunConfig:
    """Two runs that recompute what new rows touch.

    The second brings moved customers, the store's sales, and corrections of sales
    of both channels.
    """
    contracts = incremental_contracts("bigint", prefix=f"q{uuid4().hex[:12]}_")
    ensure_tables(spark, contracts, f"{shared_folder(spark)}/schemas")
    cfg = RunConfig(as_of=AS_OF, dimensions=HISTORY, contracts=contracts)
    customers = feed.bronze_customers(spark, sf_dir)
    sales = feed.bronze_transactions(spark, sf_dir)
    first, second = "_source_path = 'batch-1'", "_source_path = 'batch-2'"
    corrected = distinct_content(feed.corrections_feed(spark, sf_dir))
    loads = [
        {
            "customers": customers.filter(first),
            "products": feed.bronze_products(spark, sf_dir),
            "transactions": sales.filter(first),
        },
        {
            "customers": customers.filter(second),
            "transactions": sales.filter(second).unionByName(corrected),
        },
    ]
    for load in loads:
        for name, rows in load.items():
            merge_table(spark, contracts[f"bronze.{name}"], rows, "keep")
        run_incremental(spark, cfg)
    return cfg


def incremental_fact(spark, sf_dir):
    """The fact after both runs, with the business keys of the current versions."""
    contracts = _incremental_layers(spark, sf_dir).contracts
    customers = read_table(spark, contracts["silver.dim_customer"]).filter("is_current")
    products = read_table(spark, contracts["silver.dim_product"]).filter("is_current")
    return (
        read_table(spark, contracts["silver.fact_transaction"])
        .join(products.select("product_sk", "product_id"), "product_sk")
        .join(customers.select("customer_sk", "customer_id", "city"), "customer_sk", "left")
        .drop("customer_sk", "product_sk")
    )


def incremental_marts(spark, sf_dir):
    """All marts after both runs, in one shape."""
    contracts = _incremental_layers(spark, sf_dir).contracts
    daily, spend, category = (
        read_table(spark, contracts[f"gold.{name}"])
        for name in ("daily_revenue", "customer_spend_by_month", "category_sales_daily")
    )
    return (
        daily.selectExpr(
            "'daily' AS mart",
            "transaction_date AS day",
            "CAST(NULL AS STRING) AS key",
            "total_revenue AS total",
            "total_orders AS n_rows",
            "average_order_value AS average",
            "CAST(NULL AS INT) AS place",
        )
        .unionByName(
            spend.selectExpr(
                "'spend' AS mart",
                "month AS day",
                "concat(customer_id, ' ', customer_name) AS key",
                "total_spend AS total",
                "transaction_count AS n_rows",
                "CAST(NULL AS DOUBLE) AS average",
                "rank_by_spend AS place",
            )
        )
        .unionByName(
            category.selectExpr(
                "'category' AS mart",
                "transaction_date AS day",
                "category AS key",
                "total_revenue AS total",
                "CAST(NULL AS BIGINT) AS n_rows",
                "CAST(NULL AS DOUBLE) AS average",
                "CAST(NULL AS INT) AS place",
            )
        )
    )


def reconcile_revenue(spark, sf_dir):
    fact = stage(_fact(spark, sf_dir), "fact")
    return validation.reconcile_revenue(spark, fact, gold.daily_revenue(fact))


def layer_summary(spark, sf_dir):
    customers = stage(_dim_customer(spark, sf_dir), "dim_customer")
    products = stage(_dim_product(spark, sf_dir), "dim_product")
    fact = stage(_fact(spark, sf_dir, customers, products), "fact")
    return validation.layer_summary(
        spark,
        {
            "n_customers": feed.bronze_customers(spark, sf_dir),
            "n_products": feed.bronze_products(spark, sf_dir),
            "n_transactions": feed.bronze_transactions(spark, sf_dir),
            "dim_customer": customers,
            "dim_product": products,
            "fact_transaction": fact,
            "quarantine_rows": _quarantine(spark, sf_dir),
            "n_daily": gold.daily_revenue(fact),
            "n_cust_mo": gold.customer_spend(
                fact, customers
            ),
            "n_cat_day": gold.category_sales_daily(
                fact, products
            ),
        },
    )


def distinct_rollup(spark, sf_dir):
    """Distinct customers, products and sales per day, month and in all, from one state."""
    sales = feed.transactions_feed(spark, sf_dir).withColumn(
        "day", F.to_date("transaction_timestamp")
    )
    ids = ["customer_id", "product_id", "transaction_id"]
    online, store = (sales.filter(F.col("channel") == channel) for channel in ("online", "store"))
    loads = distinct_state(online, ["day"], ids).unionByName(distinct_state(store, ["day"], ids))
    state = stage(merge_states(loads, ["day"]), "distinct")
    days = distinct_counts(state, ["day"]).withColumn("level", F.lit("day"))
    by_month = state.withColumn("month", F.trunc("day", "MM")).drop("day")
    months = distinct_counts(by_month, ["month"]).withColumnRenamed("month", "day")
    whole = distinct_counts(state, []).withColumn("day", F.lit(None).cast("date"))
    return days.unionByName(months.withColumn("level", F.lit("month"))).unionByName(
        whole.withColumn("level", F.lit("all"))
    )


def reconcile_content(spark, sf_dir):
    """A fact in which two sales of some orders have each other's amounts: every sum is
    right, the rows are not."""
    fact = stage(_fact(spark, sf_dir), "fact")
    other = fact.filter("transaction_id % 8 IN (1, 2)").selectExpr(
        "CAST(IF(transaction_id % 8 = 1, transaction_id + 1, transaction_id - 1) AS BIGINT) AS id",
        "transaction_amount AS other_amount",
        "trunc(order_date, 'MM') AS other_month",
    )
    same = F.expr("transaction_id = id AND trunc(order_date, 'MM') = other_month")
    swaps = "id IS NOT NULL AND order_date < DATE'1997-01-01'"
    swapped = (
        fact.join(other, same, "left")
        .withColumn(
            "transaction_amount", F.expr(f"IF({swaps}, other_amount, transaction_amount)")
        )
        .select(*fact.columns)
    )
    return validation.fact_content(
        feed.transactions_feed(spark, sf_dir), _dim_product(spark, sf_dir), swapped
    )


def quarantine_audit(spark, sf_dir):
    """Four runs: with few products; the same again; with all of them; with few once more,
    but without the audit of customers."""
    contract = audit_contract(f"q{uuid4().hex[:12]}_")
    ensure_tables(spark, {"audit": contract}, f"{shared_folder(spark)}/schemas")
    sales = stage(feed.bronze_transactions(spark, sf_dir), "sales")
    products = feed.products_feed(spark, sf_dir)
    few = products.filter("price < 1500")
    customers = feed.customers_feed(spark, sf_dir)
    for at, known, audited in (
        (1, few, customers),
        (1, few, customers),
        (2, products, customers),
        (3, few, customers.limit(0)),
    ):
        moment = f"2024-02-0{at} 00:00:00"
        found = silver.quarantine_rows(sales, known, audited, moment)
        after = audit_after(read_table(spark, contract), found, f"run-{at}", moment)
        replace_table(spark, contract, after)
    return read_table(spark, contract)


def ordered_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the parts, numbered through from the first part to the last."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderkey").alias("order"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.concat("o_orderstatus", F.lit(', "'), "o_custkey", F.lit('"')).alias("note"),
    )
    path = f"{shared_folder(spark)}/ordered-export-{uuid4().hex}"
    write_ordered_csv(orders, path, by=["day"])
    parts = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("part"),
        F.split(F.regexp_replace("value", "\n$", ""), "\n").alias("lines"),
    )
    sizes = parts.select("part", F.size("lines").alias("size"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row per file
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return (
        parts.select("part", F.posexplode("lines").alias("place", "line"))
        .join(starts, "part")
        .select((F.col("start") + F.col("place") + 1).alias("line_no"), "line")
    )


def filter_limit(spark, sf_dir):
    """Filter, then the first rows of a total order."""
    dear = table(spark, sf_dir, "orders").filter("o_totalprice > 100000")
    return dear.orderBy("o_orderkey").limit(5)


QUERIES: dict[str, Query] = {
    "feed_customers": feed_customers,
    "feed_products": feed_products,
    "feed_transactions": feed_transactions,
    "row_key": row_key,
    "bronze_upsert": bronze_upsert,
    "bronze_upsert_keep": bronze_upsert_keep,
    "bronze_counts": bronze_counts,
    "duplicate_counts": duplicate_counts,
    "sample_rows": sample_rows,
    "incremental_since": incremental_rows,
    "latest_customers": latest_customers,
    "latest_products": latest_products,
    "latest_transactions": latest_transactions,
    "clean_customers": clean_customers,
    "customer_row_hash": customer_row_hash,
    "surrogate_key": surrogate_key,
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "dim_health": dim_health,
    "quarantine_missing_product": quarantine_missing_product,
    "quarantine_rows": quarantine_rows,
    "quarantine_by_reason": quarantine_by_reason,
    "fact_transaction": fact_transaction,
    "fact_enriched": fact_enriched,
    "scd2_apply": scd2_history,
    "daily_revenue": daily_revenue,
    "net_revenue": net_revenue,
    "rank_text": ranked_text,
    "customer_spend_by_month": customer_spend_by_month,
    "category_sales_daily": category_sales_daily,
    "rank_within": ranked_orders,
    "gold_daily_upsert": gold_daily_upsert,
    "gold_spend_upsert": gold_spend_upsert,
    "gold_category_upsert": gold_category_upsert,
    "change_set": daily_change_set,
    "reconcile_revenue": reconcile_revenue,
    "layer_summary": layer_summary,
    "load_feed": load_feed_twice,
    "file_ingest": file_ingest,
    "replace_table": replace_table_twice,
    "merge_table": merge_table_by_month,
    "filter_limit": filter_limit,
    "ordered_export": ordered_export,
    "load_feed_transactions": load_feed_transactions,
    "feed_rejects": feed_rejects,
    "file_ledger": file_ledger,
    "distinct_rollup": distinct_rollup,
    "reconcile_content": reconcile_content,
    "quarantine_audit": quarantine_audit,
    "late_versions": late_versions,
    "version_at": version_at,
    "change_feed": change_feed,
    "incremental_fact": incremental_fact,
    "incremental_marts": incremental_marts,
}

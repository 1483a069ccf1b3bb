"""Silver: dimensions, quarantine and fact, as pure functions of bronze."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.cleaning import customer_cleaning, is_blank
from lakestrata.functions.keys import fingerprint
from lakestrata.functions.times import instant
from lakestrata.operators.dedupe import latest_by, latest_content
from lakestrata.operators.joins import lookup, without_match
from lakestrata.operators.sequence import with_surrogate_key
from lakestrata.values import (
    ENTITY_CUSTOMER,
    ENTITY_TRANSACTION,
    OPEN_END,
    QUARANTINE_LAYER,
    REASON_EMAIL,
    REASON_MISSING_PRODUCT,
)

Moment = str | datetime | Column | None

CUSTOMER_HASH = (
    "customer_id",
    "first_name",
    "last_name",
    "email",
    "city",
    "state",
    "signup_date",
    "loyalty_tier",
)
PRODUCT_HASH = (
    "product_id",
    "product_name",
    "category",
    "brand",
    "price",
    "created_date",
)

# The feed's columns, which the fingerprint of a bronze row covers.
TRANSACTION_CONTENT = (
    "transaction_id",
    "customer_id",
    "product_id",
    "quantity",
    "transaction_amount",
    "transaction_timestamp",
    "channel",
)


def customer_state(bronze_customers: DataFrame) -> DataFrame:
    """Latest version of every customer: cleaned, with the hash of its raw content."""
    latest = latest_by(bronze_customers, ["customer_id"])
    return latest.withColumn("row_hash", fingerprint(*CUSTOMER_HASH)).selectExpr(
        "customer_id",
        *[f"{cell} AS {name}" for name, cell in customer_cleaning().items()],
        "signup_date",
        "loyalty_tier",
        "_ingest_ts AS as_of_ingest_ts",
        "row_hash",
    )


def product_state(bronze_products: DataFrame) -> DataFrame:
    latest = latest_by(bronze_products, ["product_id"])
    return latest.select(
        *PRODUCT_HASH,
        F.col("_ingest_ts").alias("as_of_ingest_ts"),
        fingerprint(*PRODUCT_HASH).alias("row_hash"),
    )


def _dimension(
    state: DataFrame, key: str, surrogate: str, as_of: Moment
) -> DataFrame:
    numbered = with_surrogate_key(state, key, surrogate)
    return numbered.select(
        surrogate,
        *state.columns,
        instant(as_of).alias("valid_from"),
        instant(OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def dim_customer(bronze_customers: DataFrame, as_of: Moment = None) -> DataFrame:
    """One current row per customer, numbered by customer_id."""
    state = customer_state(bronze_customers)
    return _dimension(state, "customer_id", "customer_sk", as_of)


def dim_product(bronze_products: DataFrame, as_of: Moment = None) -> DataFrame:
    """One current row per product, numbered by product_id."""
    state = product_state(bronze_products)
    return _dimension(state, "product_id", "product_sk", as_of)


def missing_products(
    bronze_transactions: DataFrame,
    bronze_products: DataFrame,
) -> DataFrame:
    """Every stored version of a transaction whose product no feed row names."""
    narrow = bronze_transactions.select("transaction_id", "product_id")
    return without_match(narrow, bronze_products, "product_id", "transaction_id")


def quarantine_rows(
    bronze_transactions: DataFrame,
    bronze_products: DataFrame,
    bronze_customers: DataFrame,
    as_of: Moment = None,
    rejects: DataFrame | None = None,
) -> DataFrame:
    """Audit rows: unknown products, absent emails, and rejected feed rows."""

    def audit(rows: DataFrame, entity: str | Column, key: str, reason: str | Column):
        return rows.select(
            instant(as_of).alias("quarantined_at"),
            F.lit(QUARANTINE_LAYER).alias("source_layer"),
            F.lit(entity).alias("entity"),
            F.col(key).cast("string").alias("business_key"),
            F.lit(reason).alias("reason"),
        )

    no_product = missing_products(bronze_transactions, bronze_products)
    no_email = latest_by(bronze_customers, ["customer_id"]).filter(is_blank("email"))
    audited = audit(
        no_product, ENTITY_TRANSACTION, "transaction_id", REASON_MISSING_PRODUCT
    ).unionByName(audit(no_email, ENTITY_CUSTOMER, "customer_id", REASON_EMAIL))
    if rejects is not None:
        entity = F.regexp_replace("feed", "s$", "")
        audited = audited.unionByName(
            audit(rejects, entity, "business_key", F.col("reason"))
        )
    return audited


def fact_transaction(
    bronze_transactions: DataFrame,
    products: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Latest version of every transaction with its dimension keys.

    Unknown products drop the row (the quarantine has it), unknown and absent
    customers keep it unlinked.  The dimensions go in as two columns each.
    """
    product_keys = products.filter("is_current").select("product_id", "product_sk")
    customer_keys = customers.filter("is_current").select("customer_id", "customer_sk")
    latest = latest_content(bronze_transactions, ["transaction_id"], TRANSACTION_CONTENT)
    with_product = lookup(latest, product_keys, "product_id")
    linked = lookup(
        with_product, customer_keys, "customer_id", "left", spread_by="transaction_id"
    )
    return linked.selectExpr(
        "transaction_id",
        "customer_sk",
        "product_sk",
        "to_date(transaction_timestamp) AS order_date",
        "transaction_timestamp",
        "transaction_amount",
        "quantity",
        "channel",
        "customer_id IS NULL OR customer_sk IS NULL AS is_anonymous_or_unlinked",
    )

"""The given tables seen as the three retail feeds.

Defects follow from the data: account balance bands decide which customer cells
are absent, seventh line items name a product no feed has, small orders are
anonymous.  Copies and corrections come out of one pass over the
table.  ``oracle.py`` states the same mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.contracts import build_contracts, conform
from lakestrata.plans.bronze import distinct_content
from lakestrata.sources.feeds import Feed, add_fingerprint, feeds

CONTRACTS = build_contracts(id_type="bigint")
FEEDS = feeds(CONTRACTS)
AS_OF = "2024-02-01 00:00:00"

# Stated, so that no job has to look into the files for them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _lineage(batch: str) -> list[str]:
    return [
        f"CAST(concat('2024-01-0', {batch}, ' 00:00:00') AS TIMESTAMP) AS _ingest_ts",
        f"concat('batch-', {batch}) AS _source_path",
        f"concat('batch-', {batch}) AS _source_name",
        "0L AS _source_size_bytes",
    ]


def _fingerprinted(rows: DataFrame, feed: Feed) -> DataFrame:
    return conform(add_fingerprint(rows, feed), feed.contract)


def customers_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer, some twice, and households again after a move.

    The copies leave one pass over the table as array elements.
    """
    copies = """explode(array_compact(array(
        1,
        IF(c_acctbal BETWEEN 1200 AND 1499.99, 1, NULL),
        IF(c_mktsegment = 'HOUSEHOLD', 2, NULL)))) AS batch"""
    return _fingerprinted(
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
        .selectExpr("*", copies)
        .selectExpr(
            "c_custkey AS customer_id",
            "IF(c_acctbal >= -700, 'Customer', NULL) AS first_name",
            "substring_index(c_name, '#', -1) AS last_name",
            """CASE WHEN c_acctbal BETWEEN 0 AND 299.99 THEN NULL
                    WHEN c_acctbal BETWEEN 300 AND 599.99 THEN '  '
                    ELSE concat('user', c_custkey, '@example.com') END AS email""",
            """CASE WHEN batch = 2 THEN 'Moved'
                    WHEN c_acctbal BETWEEN 600 AND 899.99 THEN NULL
                    ELSE n_name END AS city""",
            "IF(c_acctbal BETWEEN 900 AND 1199.99, '', left(r_name, 2)) AS state",
            "date_add(DATE'2020-01-01', CAST(floor(abs(c_acctbal) / 10) AS INT)) AS signup_date",
            "c_mktsegment AS loyalty_tier",
            *_lineage("batch"),
        ),
        FEEDS["customers"],
    )


def products_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fingerprinted(
        table(spark, sf_dir, "part")
        .selectExpr(
            "p_partkey AS product_id",
            "p_name AS product_name",
            "p_type AS category",
            "p_brand AS brand",
            "p_retailprice AS price",
            "date_add(DATE'2019-01-01', p_size * 20) AS created_date",
            *_lineage("1"),
        ),
        FEEDS["products"],
    )


def transactions_feed(
    spark: SparkSession, sf_dir: str, batch: str = "IF(l_returnflag = 'R', 2, 1)"
) -> DataFrame:
    """Every line item; returned ones come a day later.  Ids repeat by nature.

    Both tables grow with the data, so the join is a merge join at every scale.
    """
    return _fingerprinted(
        table(spark, sf_dir, "lineitem")
        .join(
            table(spark, sf_dir, "orders").hint("merge"),
            F.expr("l_orderkey = o_orderkey"),
        )
        .selectExpr(
            "l_orderkey * 8 + l_linenumber AS transaction_id",
            "IF(o_totalprice >= 6000, o_custkey, NULL) AS customer_id",
            "IF(l_linenumber = 7, -l_partkey, l_partkey) AS product_id",
            "CAST(l_quantity AS INT) AS quantity",
            "l_extendedprice AS transaction_amount",
            "CAST(l_shipdate AS TIMESTAMP) AS transaction_timestamp",
            "IF(l_returnflag = 'R', 'store', 'online') AS channel",
            *_lineage(batch),
        ),
        FEEDS["transactions"],
    )


def corrections_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Big sales sent again: other amounts, some on another day, some with a product
    no feed has."""
    return _fingerprinted(
        transactions_feed(spark, sf_dir, "3")
        .filter("quantity >= 45")
        .withColumns(
            {
                "transaction_amount": F.expr("quantity * 100D"),
                "product_id": F.expr("IF(quantity = 50, -abs(product_id), product_id)"),
                "transaction_timestamp": F.expr(
                    "transaction_timestamp + IF(quantity = 49, 40, 0) * INTERVAL 1 DAY"
                ),
            }
        ),
        FEEDS["transactions"],
    )


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_content(customers_feed(spark, sf_dir))


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_content(products_feed(spark, sf_dir))


def bronze_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_content(transactions_feed(spark, sf_dir), FEEDS["transactions"])

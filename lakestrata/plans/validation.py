"""Checks of the layers, each one a small result table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.money import money_sum
from lakestrata.functions.times import month_start
from lakestrata.operators.dedupe import latest_content
from lakestrata.operators.digests import content_differences
from lakestrata.operators.joins import lookup
from lakestrata.operators.staging import stage
from lakestrata.plans.silver import TRANSACTION_CONTENT
from lakestrata.values import BUCKET_EMAIL, BUCKET_MISSING_PRODUCT, BUCKET_OTHER


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def key_counts(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and distinct business keys per table."""
    return _stack(
        [
            df.agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("row_count"),
                F.count_distinct(key).alias("dist_keys"),
            )
            for name, (df, key) in tables.items()
        ]
    )


def duplicate_counts(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows beyond the first of their key; rows without a key all count."""
    return _stack(
        [
            df.agg(
                F.lit(f"dup_{key}").alias("check_name"),
                (F.count("*") - F.count_distinct(key)).alias("dup_count"),
            )
            for _, (df, key) in tables.items()
        ]
    )


def dimension_health(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, distinct business keys and current rows; all equal on full refresh."""
    return _stack(
        [
            df.agg(
                F.lit(name).alias("obj"),
                F.count("*").alias("n"),
                F.count_distinct(key).alias("dist_bk"),
                F.count_if(F.col("is_current")).alias("current_rows"),
            )
            for name, (df, key) in tables.items()
        ]
    )


def quarantine_by_reason(quarantine: DataFrame) -> DataFrame:
    reason = F.col("reason")
    bucket = (
        F.when(reason.contains("product_id_not_in"), BUCKET_MISSING_PRODUCT)
        .when(reason.contains("email_null"), BUCKET_EMAIL)
        .otherwise(BUCKET_OTHER)
    )
    return (
        quarantine.groupBy(bucket.alias("quarantine_category"))
        .agg(F.count("*").alias("n"))
        .orderBy("quarantine_category")
    )


def fact_enriched(
    fact: DataFrame,
    customers: DataFrame,
    products: DataFrame,
) -> DataFrame:
    """Facts with the current customer name (if linked) and product category."""
    names = customers.filter("is_current").select("customer_sk", "customer_name")
    categories = products.filter("is_current").select("product_sk", "category")
    with_category = lookup(fact, categories, "product_sk")
    return lookup(
        with_category,
        names,
        "customer_sk",
        "left",
        spread_by="transaction_id",
    ).select(
        "transaction_id",
        "order_date",
        "customer_name",
        "category",
        "transaction_amount",
        "is_anonymous_or_unlinked",
    )


def sample_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first rows by a key: a sample that is the same in every run."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)


def exact_total(df: DataFrame, amount: str) -> Column:
    return df.agg(F.round(money_sum(amount), 2)).scalar()


def reconcile_revenue(
    spark: SparkSession, fact: DataFrame, daily: DataFrame
) -> DataFrame:
    """Fact total beside the total of the daily mart: one row, equal when sound."""
    return spark.range(1).select(
        exact_total(fact, "transaction_amount").alias("fact_total"),
        exact_total(daily, "total_revenue").alias("sum_daily"),
    )


def layer_summary(spark: SparkSession, counts: dict[str, DataFrame]) -> DataFrame:
    """One row with the row count of every table."""
    return spark.range(1).select(
        *[df.agg(F.count("*")).scalar().alias(name) for name, df in counts.items()]
    )


FACT_CONTENT = ("order_month", "transaction_id", "order_date", "transaction_amount", "quantity", "channel")


def fact_content(
    bronze_transactions: DataFrame, products: DataFrame, fact: DataFrame
) -> DataFrame:
    """Rows that bronze and the fact do not hold alike, with how often each has them.

    Totals can agree where contents do not.  Months are compared by digest first, and
    only those that differ by row; the rows expected are written once for both.
    """
    known = products.filter("is_current").select("product_id")
    latest = latest_content(bronze_transactions, ["transaction_id"], TRANSACTION_CONTENT)
    expected = lookup(latest, known, "product_id", "left_semi")
    sides = [
        df.withColumn("order_date", F.to_date("transaction_timestamp"))
        .withColumn("order_month", month_start("order_date"))
        .select(*FACT_CONTENT)
        for df in (expected, fact)
    ]
    sides[0] = stage(sides[0], "expected")
    return content_differences(*sides, "order_month", FACT_CONTENT)

"""Gold: marts over the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.money import (
    money_again,
    money_parts,
    money_sum,
    money_total,
    safe_ratio,
)
from lakestrata.functions.times import month_start
from lakestrata.operators.ranking import rank_within


def daily_revenue(fact: DataFrame, ids_unique: bool = True) -> DataFrame:
    """Revenue, order count and average order value per day.

    The fact holds every transaction once, so counting its rows counts distinct
    orders, and only one partial result per task and day is shuffled.  For
    other inputs ``ids_unique=False`` counts distinct ids, which shuffles them.
    """
    count = F.count if ids_unique else F.count_distinct
    daily = fact.groupBy(F.col("order_date").alias("transaction_date")).agg(
        money_sum("transaction_amount").alias("total_revenue"),
        count("transaction_id").alias("total_orders"),
    )
    return daily.select(
        "transaction_date",
        "total_revenue",
        safe_ratio("total_revenue", "total_orders").alias("average_order_value"),
        "total_orders",
    )


def customer_spend(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Spend per month and linked customer, without the rank.

    Facts are summed per surrogate key before they meet the dimension: a busy
    customer arrives at the join as one row per month, not as its transactions.
    A customer has one current row, so grouping by its key or its name is one.
    """
    per_key = (
        fact.filter(F.col("customer_sk").isNotNull())
        .groupBy(month_start("order_date").alias("month"), "customer_sk")
        .agg(
            money_sum("transaction_amount").alias("total_spend"),
            F.count("*").alias("transaction_count"),
        )
    )
    current = customers.filter("is_current").select(
        "customer_sk", "customer_id", "customer_name"
    )
    return per_key.join(current, "customer_sk").select(
        "month", "customer_id", "customer_name", "total_spend", "transaction_count"
    )


def customer_spend_by_month(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer spend per month, ranked in the month; equal spend shares a rank.

    The stored rank is an INT; a month of more customers fails with CAST_OVERFLOW.
    """
    ranked = rank_within(
        customer_spend(fact, customers), "month", "total_spend", "rank_by_spend"
    )
    return ranked.withColumn("rank_by_spend", F.col("rank_by_spend").cast("int"))


def category_sales_daily(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per day and category.

    Facts are summed per day and product before they meet the dimension, which
    also evens out hot products.
    """
    current = products.filter("is_current").select("product_sk", "category")
    per_product = fact.groupBy(
        F.col("order_date").alias("transaction_date"), "product_sk"
    ).agg(*money_parts("transaction_amount"))
    return (
        per_product.join(current, "product_sk")
        .groupBy("transaction_date", "category")
        .agg(*money_again())
        .select("transaction_date", "category", money_total().alias("total_revenue"))
    )

"""Physical plans: what is read, what is shuffled, what skew does."""

from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lakestrata.contracts import use_catalog
from lakestrata.functions.keys import fingerprint
from lakestrata.operators import latest_by, lookup, upsert_stored, with_surrogate_key
from lakestrata.operators.dedupe import latest_content
from lakestrata.operators.staging import staged
from lakestrata.plans import gold
from lakestrata.plans.bronze import distinct_content
from lakestrata.plans.silver import TRANSACTION_CONTENT
from lakestrata.session import shared_folder
from lakestrata.sources import feeds, read_months, read_table, register_views


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact") / "fact")
    spark.range(5000).selectExpr(
        "id AS transaction_id",
        "IF(id % 3 = 0, NULL, id % 50) AS customer_sk",
        "id % 20 AS product_sk",
        "date_add(DATE'2024-01-01', CAST(id % 90 AS INT)) AS order_date",
        "CAST(id AS DOUBLE) AS transaction_amount",
        "'online' AS channel",
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_daily_revenue_reads_three_columns_and_shuffles_days(fact, plan):
    text = plan(gold.daily_revenue(fact))
    assert text.count("Exchange") == 2  # one node, named in the tree and in the details
    assert "ReadSchema: struct<transaction_id:bigint,order_date:date,transaction_amount:double>" in text


def test_filters_reach_the_files(fact, plan):
    late = fact.filter("order_date >= DATE'2024-03-01'")
    assert "GreaterThanOrEqual(order_date,2024-03-01)" in plan(gold.daily_revenue(late))


def test_months_prune_partitions(spark, contracts, plan):
    text = plan(read_months(spark, contracts["silver.fact_transaction"], first="2024-02-15"))
    filters = next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert "_order_month" in filters and ">= 2024-02-01" in filters


def test_category_sums_come_before_the_join(spark, fact, plan, setting):
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    dim = spark.range(20).selectExpr("id AS product_sk", "'c' AS category", "TRUE AS is_current")
    text = plan(gold.category_sales_daily(fact, dim), "simple")
    join = text.index("SortMergeJoin")
    assert "Broadcast" not in text
    assert "partial_try_sum" in text[join:] or "partial_sum" in text[join:]


def test_no_operator_needs_a_single_task(spark, plan):
    numbered = with_surrogate_key(spark.range(1000), "id", "sk")
    big_side = plan(numbered, "simple").split("BroadcastExchange")[0]
    assert "SinglePartition" not in big_side


def test_no_plan_is_picked_by_a_row_count(spark, fact, plan, setting):
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    dim = spark.range(50).selectExpr(
        "id AS customer_sk", "id AS customer_id", "'n' AS customer_name", "TRUE AS is_current"
    )
    text = plan(gold.customer_spend_by_month(fact, dim), "simple")
    assert "Broadcast" not in text and "SinglePartition" not in text


def test_small_source_leaves_the_target_unshuffled(spark, fact, plan):
    source = fact.limit(10)
    text = plan(upsert_stored(fact, source, ["transaction_id"]), "simple")
    assert "LeftAnti" in text and "hashpartitioning" not in text


def test_hot_key_is_split_by_the_join(spark, plan, setting):
    setting(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    facts = spark.range(0, 60000, 1, 8).selectExpr("id AS t", "IF(id % 3 = 0, 7, id) AS k")
    dim = spark.range(0, 60000, 1, 8).selectExpr("id AS k", "id * 2 AS sk")
    joined = lookup(facts, dim, "k", "left", spread_by="t")
    joined.collect()
    assert "skew=true" in plan(joined, "simple")
    assert joined.filter("sk = 2 * k").count() == 60000


def test_rows_without_key_are_spread(spark):
    facts = spark.range(4000).selectExpr("id AS t", "CAST(NULL AS BIGINT) AS k")
    dim = spark.range(10).selectExpr("id AS k", "id AS sk").hint("merge")
    joined = lookup(facts, dim, "k", "left", spread_by="t")
    tasks = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 4000


def test_latest_of_a_hot_key_sends_one_row_per_task(spark):
    hot = spark.range(0, 10000, 1, 4).selectExpr("1 AS id", "id AS v")
    assert latest_by(hot, ["id"], [F.col("v").desc()]).collect() == [(1, 9999)]


def _versions(spark):
    """Versions of few sales: other times, other paths, ties on both, and copies."""
    cells = spark.range(400).selectExpr(
        "id % 9 AS transaction_id",
        "id % 4 AS customer_id",
        "5L AS product_id",
        "CAST(id % 3 AS INT) AS quantity",
        "1.5D AS transaction_amount",
        "TIMESTAMP'2024-01-01 00:00:00' AS transaction_timestamp",
        "IF(id % 2 = 0, 'online', NULL) AS channel",
        "timestamp_seconds(id % 5) AS _ingest_ts",
        "concat('p', id % 2) AS _source_path",
    )
    return cells.withColumn("_bronze_row_key", fingerprint(*TRANSACTION_CONTENT))


def test_latest_of_contents_moves_no_fingerprints(spark, plan, rows):
    df = _versions(spark)
    found = latest_content(df, ["transaction_id"], TRANSACTION_CONTENT)
    text = plan(found, "simple")
    assert text.count("Exchange") == 1
    assert "sha2" not in text[text.index("Exchange") :]
    assert rows(found) == rows(latest_by(df, ["transaction_id"]))


def test_distinct_contents_move_no_fingerprints(spark, plan, rows):
    df = _versions(spark)
    found = distinct_content(df, feeds()["transactions"])
    text = plan(found, "simple")
    assert text.count("Exchange") == 1
    assert "sha2" not in text[text.index("Exchange") :]
    assert rows(found) == rows(distinct_content(df))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_has_to_name_the_folder():
    class Unset:
        conf = SimpleNamespace(get=lambda name, default: default)
        sparkContext = SimpleNamespace(
            getCheckpointDir=lambda: None, master="spark://somewhere:7077"
        )

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Unset())


def test_stages_leave_nothing_behind(spark):
    with staged(spark.range(10), "test") as rows:
        assert rows.count() == 10
        files = rows.inputFiles()
    assert not any(Path(file.removeprefix("file://")).exists() for file in files)


def test_views_and_current_schema(spark, contracts):
    names = register_views(spark, contracts)
    assert spark.sql("SELECT * FROM fact_transaction").columns == read_table(
        spark, contracts["silver.fact_transaction"]
    ).columns
    schema = contracts["gold.daily_revenue"].schema
    use_catalog(spark, "spark_catalog", schema)
    assert spark.catalog.currentDatabase() == schema
    use_catalog(spark, schema="default")
    for name in names:
        spark.catalog.dropTempView(name)

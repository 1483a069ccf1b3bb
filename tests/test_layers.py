"""Silver and gold rules on literal bronze rows, and the ordered run."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lakestrata.contracts import conform
from lakestrata.plans import gold, silver, validation
from lakestrata.plans.run import (
    HISTORY,
    RunConfig,
    run_gold,
    run_layers,
    run_silver,
    validate,
)
from lakestrata.sinks import append_run, last_event_ts, merge_table, write_csv
from lakestrata.sources import add_fingerprint, feeds, read_months, read_table

FEEDS = feeds()
AS_OF = "2024-02-01 00:00:00"
LINEAGE = "_ingest_ts string, _source_path string"


def bronze(spark, feed, data):
    """Bronze rows from feed cells plus (ingest time, path)."""
    contract = FEEDS[feed].contract
    text = ", ".join(f"{c} string" for c in contract.feed_columns)
    cells = [tuple(None if v is None else str(v) for v in row) for row in data]
    df = spark.createDataFrame(cells, f"{text}, {LINEAGE}")
    typed = conform(
        df.selectExpr(
            "*",
            "_source_path AS _source_name",
            "0L AS _source_size_bytes",
            "'' AS _bronze_row_key",
        ),
        contract,
    )
    return add_fingerprint(typed, FEEDS[feed])


T1, T2 = ("2024-01-01", "a"), ("2024-01-02", "b")


@pytest.fixture(scope="module")
def customers(spark):
    return bronze(
        spark,
        "customers",
        [
            (3, "Ann", "Lee", None, "Rome", "IT", "2020-01-01", "Gold", *T1),
            (4, "", "Lee", "  ", None, " ", "2020-01-01", "Gold", *T1),
            (5, None, None, " e@x ", " Oslo ", "NO", None, None, *T1),
            (8, "Bo", "Ek", "b@x", "A", "SE", "2020-01-01", "Gold", *T1),
            (8, "Bo", "Ek", "b@x", "B", "SE", "2020-01-01", "Gold", *T2),
        ],
    ).cache()


@pytest.fixture(scope="module")
def products(spark):
    return bronze(
        spark,
        "products",
        [(1, "n1", "Toys", "b", 1.5, "2020-01-01", *T1), (2, "n2", "Books", None, 2, None, *T1)],
    ).cache()


def sale(i, customer, product, amount, day="2024-01-05", when=T1):
    return (i, customer, product, 1, amount, f"{day} 10:00:00", "online", *when)


@pytest.fixture(scope="module")
def transactions(spark):
    return bronze(
        spark,
        "transactions",
        [
            sale(1, 3, 1, 100),
            sale(2, 4, 1, 100),
            sale(3, 8, 2, 50, "2024-01-06"),
            sale(4, None, 1, 7),  # anonymous
            sale(5, 99, 1, 3),  # unknown customer
            sale(6, 3, 77, 5),  # unknown product, in two versions
            sale(6, 3, 77, 6, when=T2),
            sale(7, 8, 2, 1, "2024-02-01"),
            sale(7, 8, 2, 2, "2024-02-01", T2),  # corrected
        ],
    ).cache()


@pytest.fixture(scope="module")
def dims(customers, products):
    return (
        silver.dim_customer(customers, AS_OF).cache(),
        silver.dim_product(products, AS_OF).cache(),
    )


@pytest.fixture(scope="module")
def fact(transactions, dims):
    return silver.fact_transaction(transactions, dims[1], dims[0]).cache()


def test_customer_cleaning(customers, rows):
    state = silver.customer_state(customers)
    assert rows(state, "customer_id", "first_name", "last_name", "customer_name") == [
        (3, "Ann", "Lee", "Ann Lee"),
        (4, "", "Lee", "Lee"),
        (5, "Unknown", "Unknown", ""),
        (8, "Bo", "Ek", "Bo Ek"),
    ]
    assert rows(state, "customer_id", "email", "email_raw", "city", "city_raw", "state") == [
        (3, "unknown+3@imputed.invalid", None, "Rome", "Rome", "IT"),
        (4, "unknown+4@imputed.invalid", "  ", "Unknown", None, "UN"),
        (5, "e@x", " e@x ", "Oslo", " Oslo ", "NO"),
        (8, "b@x", "b@x", "B", "B", "SE"),
    ]


def test_dimensions(customers, products, dims, rows):
    shown = ("customer_sk", "customer_id", "is_current", F.col("valid_to").cast("string"))
    assert rows(dims[0], *shown) == [
        (1, 3, True, "9999-12-31 23:59:59"),
        (2, 4, True, "9999-12-31 23:59:59"),
        (3, 5, True, "9999-12-31 23:59:59"),
        (4, 8, True, "9999-12-31 23:59:59"),
    ]
    assert rows(dims[1], "product_sk", "product_id", "price") == [(1, 1, 1.5), (2, 2, 2.0)]
    distributed = silver.dim_customer(customers, AS_OF)
    assert rows(distributed) == rows(dims[0])
    health = validation.dimension_health(
        {"dim_customer": (dims[0], "customer_id"), "dim_product": (dims[1], "product_id")}
    )
    assert rows(health) == [("dim_customer", 4, 4, 4), ("dim_product", 2, 2, 2)]


def test_quarantine(transactions, products, customers, rows):
    audit = silver.quarantine_rows(transactions, products, customers, AS_OF)
    assert rows(audit, "entity", "business_key", "reason") == [
        ("customer", "3", "email_null_will_impute_in_dim"),
        ("customer", "4", "email_null_will_impute_in_dim"),
        ("transaction", "6", "product_id_not_in_bronze_product_feed"),
        ("transaction", "6", "product_id_not_in_bronze_product_feed"),
    ]
    assert rows(validation.quarantine_by_reason(audit)) == [
        ("email_null_audit", 2),
        ("missing_product", 2),
    ]


FACT_ROWS = [
    (1, 1, 1, 100.0, False),
    (2, 2, 1, 100.0, False),
    (3, 4, 2, 50.0, False),
    (4, None, 1, 7.0, True),
    (5, None, 1, 3.0, True),
    (7, 4, 2, 2.0, False),
]


def test_fact(transactions, dims, fact, rows):
    shown = (
        "transaction_id",
        "customer_sk",
        "product_sk",
        "transaction_amount",
        "is_anonymous_or_unlinked",
    )
    assert rows(fact, *shown) == FACT_ROWS
    shuffled = silver.fact_transaction(transactions, dims[1], dims[0])
    assert rows(shuffled, *shown) == FACT_ROWS


def test_every_transaction_is_in_the_fact_or_quarantined(transactions, fact, products):
    seen = fact.select("transaction_id").union(
        silver.missing_products(transactions, products).select("transaction_id")
    )
    assert transactions.join(seen, "transaction_id", "left_anti").count() == 0


def test_daily_revenue(fact, rows):
    text = F.col("transaction_date").cast("string")
    expected = [
        ("2024-01-05", 210.0, 52.5, 4),
        ("2024-01-06", 50.0, 50.0, 1),
        ("2024-02-01", 2.0, 2.0, 1),
    ]
    shown = (text, "total_revenue", "average_order_value", "total_orders")
    assert rows(gold.daily_revenue(fact), *shown) == expected
    twice = fact.unionByName(fact)
    counted = gold.daily_revenue(twice, ids_unique=False)
    assert rows(counted, "total_orders") == [(1,), (1,), (4,)]


def test_spend_ties_share_a_rank(fact, dims, rows):
    month = F.col("month").cast("string")
    expected = [
        ("2024-01-01", 3, "Ann Lee", 100.0, 1, 1),
        ("2024-01-01", 4, "Lee", 100.0, 1, 1),
        ("2024-01-01", 8, "Bo Ek", 50.0, 1, 3),
        ("2024-02-01", 8, "Bo Ek", 2.0, 1, 1),
    ]
    shown = (
        month, "customer_id", "customer_name", "total_spend", "transaction_count",
        "rank_by_spend",
    )
    assert rows(gold.customer_spend_by_month(fact, dims[0]), *shown) == expected


def test_category_sales(fact, dims, rows):
    sales = gold.category_sales_daily(fact, dims[1])
    assert rows(sales, F.col("transaction_date").cast("string"), "category", "total_revenue") == [
        ("2024-01-05", "Toys", 210.0),
        ("2024-01-06", "Books", 50.0),
        ("2024-02-01", "Books", 2.0),
    ]


def test_checks(spark, fact, dims, transactions, products, rows):
    total = validation.reconcile_revenue(spark, fact, gold.daily_revenue(fact))
    assert rows(total) == [(262.0, 262.0)]
    tables = {"transactions": (transactions, "transaction_id"), "products": (products, "product_id")}
    assert rows(validation.key_counts(tables)) == [("products", 2, 2), ("transactions", 9, 7)]
    assert rows(validation.duplicate_counts(tables)) == [
        ("dup_product_id", 0),
        ("dup_transaction_id", 2),
    ]
    enriched = validation.fact_enriched(fact, *dims)
    assert rows(enriched, "transaction_id", "customer_name", "category")[3:] == [
        (4, None, "Toys"), (5, None, "Toys"), (7, "Bo Ek", "Books"),
    ]
    assert rows(validation.sample_rows(fact, ["transaction_id"], 2), "transaction_id") == [
        (1,), (2,),
    ]
    assert rows(validation.layer_summary(spark, {"a": fact, "b": products})) == [(6, 2)]


def mart(spark, data):
    df = spark.createDataFrame(data, "month string, customer_id int, total_spend double")
    return df.selectExpr(
        "CAST(month AS DATE) AS month",
        "customer_id",
        "'n' AS customer_name",
        "total_spend",
        "1L AS transaction_count",
        "1 AS rank_by_spend",
    )


def test_merge_touches_only_named_partitions(spark, contracts, rows):
    contract = contracts["gold.customer_spend_by_month"]
    shown = (F.col("month").cast("string"), "customer_id", "total_spend")
    merge_table(
        spark, contract, mart(spark, [("2024-01-01", 1, 1.0), ("2024-02-01", 1, 2.0)])
    )

    def files():
        return {f for f in spark.table(contract.table).inputFiles() if "month=2024-01-01" in f}

    january = files()
    merge_table(
        spark, contract, mart(spark, [("2024-02-01", 1, 9.0), ("2024-03-01", 2, 3.0)])
    )
    assert files() == january
    assert rows(read_table(spark, contract), *shown) == [
        ("2024-01-01", 1, 1.0),
        ("2024-02-01", 1, 9.0),
        ("2024-03-01", 2, 3.0),
    ]
    merge_table(spark, contract, mart(spark, [("2024-03-01", 3, 4.0)]), delete_missing=True)
    assert rows(read_table(spark, contract), *shown) == [("2024-03-01", 3, 4.0)]
    twice = mart(spark, [("2024-03-01", 3, 4.0)] * 2)
    with pytest.raises(Exception, match="duplicate key"):
        merge_table(spark, contract, twice)
    assert read_table(spark, contract).count() == 1


def test_run_log(spark, contracts):
    log = contracts["meta.layer_run_state"]
    assert last_event_ts(spark, log, "bronze") is None
    for day in ("2024-01-02", "2024-01-01"):
        append_run(spark, log, "bronze", day, "run")
    assert last_event_ts(spark, log, "bronze") == "2024-01-02 00:00:00"


def test_layers_run_twice_alike(spark, contracts, customers, products, transactions, rows, tmp_path):
    paths = {
        name: write_csv(
            df.select(*FEEDS[name].contract.feed_columns).distinct(), str(tmp_path / name)
        )
        for name, df in {
            "customers": customers.filter("_source_path = 'a'"),
            "products": products,
            "transactions": transactions.filter("_source_path = 'a'"),
        }.items()
    }
    cfg = RunConfig(paths, "keep", AS_OF, contracts=contracts)
    first = rows(run_layers(spark, cfg))
    tables = ("dim_customer", "dim_product", "fact_transaction", "quarantine_rows")

    def silver_rows():
        return [rows(read_table(spark, contracts[f"silver.{t}"])) for t in tables]

    before = silver_rows()
    assert rows(run_layers(spark, cfg)) == first
    assert silver_rows() == before
    checks = validate(spark, cfg)
    total, daily = checks["reconcile_revenue"].first()
    assert total == daily == 261.0
    assert rows(checks["duplicate_counts"], "dup_count") == [(0,), (0,), (0,)]
    log = read_table(spark, contracts["meta.layer_run_state"])
    assert rows(log.groupBy("layer").count()) == [("bronze", 2), ("gold", 2), ("silver", 2)]
    gold_mark = last_event_ts(spark, contracts["meta.layer_run_state"], "gold")
    assert gold_mark == "2024-02-01 10:00:00"

    # Marts of recent months only: the same rows, older ones untouched.
    fact_contract = contracts["silver.fact_transaction"]
    recent = read_months(spark, fact_contract, first="2024-02-15")
    assert rows(recent, "transaction_id") == [(7,)]
    assert rows(read_months(spark, fact_contract, last="2024-01-15")) == rows(
        read_table(spark, fact_contract).filter("order_date < '2024-02-01'")
    )
    marts = [contracts[f"gold.{m}"] for m in ("daily_revenue", "customer_spend_by_month")]
    gold_rows = [rows(read_table(spark, m)) for m in marts]
    run_gold(spark, replace(cfg, gold_from="2024-02-15"))
    assert [rows(read_table(spark, m)) for m in marts] == gold_rows
    with pytest.raises(ValueError, match="gold_from"):
        run_gold(spark, replace(cfg, gold_from="2024-02-15", delete_missing=True))

    # A corrected customer arrives; history keeps the old version and its key.
    moved = customers.filter("_source_path = 'b'").select(*FEEDS["customers"].contract.feed_columns)
    write_csv(moved, f"{paths['customers']}/later")
    later = RunConfig(
        paths, "keep", "2024-03-01 00:00:00", HISTORY, "append", contracts=contracts
    )
    run_layers(spark, later)
    dim = read_table(spark, contracts["silver.dim_customer"])
    assert rows(dim.filter("customer_id = 8"), "customer_sk", "city", "is_current") == [
        (4, "A", False),
        (5, "B", True),
    ]
    audit = read_table(spark, contracts["silver.quarantine_rows"])
    assert audit.count() == 2 * len(before[3])
    run_silver(spark, later)
    assert read_table(spark, contracts["silver.dim_customer"]).count() == 5

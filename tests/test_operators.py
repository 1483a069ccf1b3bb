"""Operators on small literal rows; bigger random ones against brute force."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.contracts import assert_not_null, build_contracts, conform
from lakestrata.functions import fingerprint
from lakestrata.functions.conversion import try_convert
from lakestrata.functions.money import money_again, money_parts, money_sum, money_total
from lakestrata.operators import (
    assert_unique,
    change_set,
    incremental_since,
    latest_by,
    lookup,
    rank_within,
    scd2_apply,
    upsert,
    upsert_stored,
    with_surrogate_key,
    without_match,
)
from lakestrata.operators.merge import new_rows
from lakestrata.operators.staging import stage

VERSION = "id int, v double, _ingest_ts timestamp, _source_path string, _bronze_row_key string"


def versions(spark, data):
    return spark.createDataFrame(data, VERSION.replace("timestamp", "string")).withColumn(
        "_ingest_ts", F.to_timestamp("_ingest_ts")
    )


@pytest.mark.parametrize("partitions", [1, 5])
@pytest.mark.parametrize("flip", [False, True])
def test_latest_by_never_depends_on_row_order(spark, rows, partitions, flip):
    data = [
        (10, 5.0, "2024-01-01", "b", "k1"),
        (10, 9.0, "2024-01-01", "a", "k3"),
        (10, 7.0, "2024-01-01", "a", "k2"),
        (11, 1.0, "2024-01-01", "a", "k4"),
        (11, 2.0, "2024-01-02", "z", "k5"),
    ]
    df = versions(spark, data[::-1] if flip else data).repartition(partitions)
    assert rows(latest_by(df, ["id"]), "id", "v") == [(10, 7.0), (11, 2.0)]


def test_latest_by_cuts_a_hot_key_before_the_shuffle(spark, capsys):
    df = versions(spark, [(1, float(i), "2024-01-01", "a", str(i)) for i in range(50)])
    latest_by(df, ["id"]).explain()
    assert capsys.readouterr().out.count("WindowGroupLimit") == 2


def test_assert_unique(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert rows(assert_unique(df, ["id"])) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="duplicate key in source: id"):
        assert_unique(df.unionByName(df), ["id"]).collect()


def test_fingerprint_formula(spark):
    import hashlib

    row = spark.createDataFrame([(7, None, "x", 1.5)], "a int, b string, c string, d double")
    key = row.select(fingerprint("a", "b", "c", "d")).first()[0]
    assert key == hashlib.sha256(b"7||||x||1.5").hexdigest()
    kept_apart = row.select(fingerprint("a", "b", "c", "d", null_token="<null>")).first()[0]
    assert kept_apart == hashlib.sha256(b"7||<null>||x||1.5").hexdigest()


def test_surrogate_key_small(spark, rows):
    df = spark.createDataFrame([(5,), (2,), (9,)], "id int")
    numbered = with_surrogate_key(df, "id", "sk")
    assert rows(numbered) == [(2, 1), (5, 2), (9, 3)]
    assert dict(numbered.dtypes)["sk"] == "bigint"


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_surrogate_key_distributed(spark, partitions):
    ids = random.Random(partitions).sample(range(10**6), 5000)
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(partitions)
    numbered = with_surrogate_key(df, "id", "sk", start=100)
    expected = {i: n for n, i in enumerate(sorted(ids), 101)}
    assert {r.id: r.sk for r in numbered.collect()} == expected


def brute_rank(data):
    groups = {}
    for group, value, _ in data:
        groups.setdefault(group, []).append(value)

    def greater(a, b):
        return a is not None and (b is None or a > b)

    return {
        (g, v, i): 1 + sum(greater(other, v) for other in groups[g]) for g, v, i in data
    }


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_rank_within_ties_and_nulls(spark, setting, partitions):
    """A tie and a NULL group that hold a third of the rows each, over several tasks."""
    setting(spark__sql__shuffle__partitions=str(partitions))
    rng = random.Random(partitions)
    data = [("big", float(rng.randint(1, 300)), i) for i in range(500)]
    data += [("big", 77.0, 1000 + i) for i in range(400)]
    data += [("big", None, 2000 + i) for i in range(90)]
    data += [(None, float(rng.randint(1, 50)), 3000 + i) for i in range(400)]
    data += [(None, None, 4000 + i) for i in range(10)]
    data += [("flat", 1.0, i) for i in range(300)]
    data += [("small", float(i % 3), i) for i in range(10)]
    df = spark.createDataFrame(data, "g string, v double, i long").repartition(3)
    ranked = rank_within(df, "g", "v", "r")
    assert dict(ranked.dtypes)["r"] == "bigint"
    assert {(r.g, r.v, r.i): r.r for r in ranked.collect()} == brute_rank(data)


def test_rank_within_text(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "x", 3)], "g string, v string, i int")
    assert rows(rank_within(df, "g", "v"), "i", "rank") == [(1, 2), (2, 1), (3, 2)]


@pytest.mark.parametrize(
    "amounts, total",
    [
        ([0.004] * 1000, 4.0),
        ([1e17, 1.0], 1e17),
        ([1e300, 1e300], 2e300),
        ([0.1] * 10, 1.0),
        ([1.0, None], 1.0),
        ([None], None),
        ([0.1, 1e-20], 0.1),
        ([float("inf"), 1.0], float("inf")),
    ],
)
def test_money_loses_nothing(spark, amounts, total):
    df = spark.createDataFrame([(a, k % 3) for k, a in enumerate(amounts)], "a double, g int")
    assert df.agg(money_sum("a").alias("s")).first().s == total
    parts = df.groupBy("g").agg(*money_parts("a")).agg(*money_again())
    assert parts.select(money_total().alias("s")).first().s == total


def test_text_that_is_no_finite_number_does_not_convert(spark, rows):
    cells = ["1.5", " 2 ", "NaN", "Infinity", "-inf", "1e400", "x", "", None]
    df = spark.createDataFrame([(k, c) for k, c in enumerate(cells)], "k int, t string")
    read = df.selectExpr("k", f"{try_convert('t', T.DoubleType())} AS v").where("v IS NOT NULL")
    assert rows(read) == [(0, 1.5), (1, 2.0)]


def test_money_keeps_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "a double")
    assert str(df.agg(money_sum("a").alias("s")).first().s) == "nan"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(2, "B"), (3, None)], "id int, v string")


@pytest.mark.parametrize("way", [upsert, upsert_stored])
@pytest.mark.parametrize(
    ("options", "expected"),
    [
        ({}, [(1, "a"), (2, "B"), (3, None)]),
        ({"on_match": "keep"}, [(1, "a"), (2, "b"), (3, None)]),
        ({"delete_missing": True}, [(2, "B"), (3, None)]),
        ({"delete_missing": True, "on_match": "keep"}, [(2, "b"), (3, None)]),
    ],
)
def test_upsert(rows, target, source, way, options, expected):
    assert rows(way(target, source, ["id"], **options)) == expected


def test_upsert_takes_a_null_from_the_source(spark, rows, target):
    nothing = spark.createDataFrame([(1, None)], "id int, v string")
    assert rows(upsert(target, nothing, ["id"])) == [(1, None), (2, "b")]


def test_upsert_rejects_duplicates_and_bad_modes(spark, target):
    twice = spark.createDataFrame([(2, "B"), (2, "X")], "id int, v string")
    with pytest.raises(Exception, match="duplicate key"):
        upsert(target, twice, ["id"]).collect()
    with pytest.raises(ValueError, match="on_match"):
        upsert(target, twice, ["id"], on_match="touch")


def test_null_keys_never_match(spark, rows):
    df = spark.createDataFrame([(None, "x")], "id int, v string")
    assert rows(upsert(df, df, ["id"])) == [(None, "x"), (None, "x")]
    assert rows(new_rows(df, df, ["id"])) == [(None, "x")]


def test_change_set(spark, rows):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "id int, v string")
    after = spark.createDataFrame([(2, "B"), (3, None), (4, None), (5, "e")], "id int, v string")
    assert rows(change_set(before, after, ["id"])) == sorted(
        [
            (1, "a", "delete"),
            (2, "b", "update_preimage"),
            (2, "B", "update_postimage"),
            (4, "d", "update_preimage"),
            (4, None, "update_postimage"),
            (5, "e", "insert"),
        ],
        key=repr,
    )


def test_change_set_of_key_only_tables(spark, rows):
    before = spark.createDataFrame([(1,), (2,)], "id int")
    after = spark.createDataFrame([(2,), (3,)], "id int")
    assert rows(change_set(before, after, ["id"])) == [(1, "delete"), (3, "insert")]


def test_incremental_since(spark, rows):
    df = versions(
        spark, [(1, 0.0, "2024-01-01", "a", "k"), (2, 0.0, "2024-01-02", "a", "k")]
    )
    assert rows(incremental_since(df, "_ingest_ts", "2024-01-01"), "id") == [(2,)]
    assert rows(incremental_since(df, "_ingest_ts", None), "id") == [(1,), (2,)]


def test_lookup_keeps_rows_without_a_key(spark, rows):
    facts = spark.createDataFrame([(i, None if i % 2 else i) for i in range(6)], "t int, k int")
    dim = spark.createDataFrame([(0, "zero"), (2, "two")], "k int, name string")
    joined = lookup(facts, dim, "k", "left", spread_by="t")
    assert rows(joined, "t", "name") == [
        (0, "zero"), (1, None), (2, "two"), (3, None), (4, None), (5, None),
    ]
    missing = without_match(facts, dim, "k", spread_by="t")
    assert rows(missing, "t") == [(1,), (3,), (4,), (5,)]


DIM = (
    "sk long, id int, v string, row_hash string, as_of_ingest_ts string, "
    "valid_from string, valid_to string, is_current boolean"
)


def dimension(spark, data):
    df = spark.createDataFrame(data, DIM)
    return df.withColumns(
        {c: F.to_timestamp(c) for c in ("as_of_ingest_ts", "valid_from", "valid_to")}
    )


def incoming(spark, data):
    df = spark.createDataFrame(data, "id int, v string, row_hash string, as_of_ingest_ts string")
    return df.withColumn("as_of_ingest_ts", F.to_timestamp("as_of_ingest_ts"))


def test_scd2_closes_opens_and_repeats(spark, rows):
    never = "9999-12-31 23:59:59"
    dim = dimension(
        spark,
        [
            (1, 1, "old", "h0", "2023-01-01", "2023-01-01", "2024-01-01", False),
            (2, 1, "a", "h1", "2024-01-01", "2024-01-01", never, True),
            (3, 2, "b", "h2", "2024-01-05", "2024-01-05", never, True),
            (4, 3, "c", "h3", "2024-01-01", "2024-01-01", never, True),
        ],
    )
    batch = incoming(
        spark,
        [
            (1, "A", "h9", "2024-02-01"),  # changed
            (2, "late", "h8", "2024-01-01"),  # older than the current version
            (3, "c", "h3", "2024-02-01"),  # unchanged
            (7, "new", "h7", "2024-02-01"),
            (5, "new", "h5", "2024-02-01"),
        ],
    )
    after = scd2_apply(dim, batch, "id", "sk", "2024-02-02")
    shown = ("sk", "id", "v", F.col("valid_to").cast("date").cast("string"), "is_current")
    expected = [
        (1, 1, "old", "2024-01-01", False),
        (2, 1, "a", "2024-02-02", False),
        (3, 2, "b", "9999-12-31", True),
        (4, 3, "c", "9999-12-31", True),
        (5, 1, "A", "9999-12-31", True),
        (6, 5, "new", "9999-12-31", True),
        (7, 7, "new", "9999-12-31", True),
    ]
    assert rows(after, *shown) == expected
    again = scd2_apply(after, batch, "id", "sk", "2024-02-03")
    assert rows(again, *shown) == expected
    distributed = scd2_apply(dim, batch, "id", "sk", "2024-02-02")
    assert rows(distributed, *shown) == expected


def test_conform_orders_casts_and_checks(spark, rows):
    contract = build_contracts()["gold.category_sales_daily"]
    df = spark.createDataFrame(
        [(1, "Toys", "2024-01-01")], "total_revenue int, category string, transaction_date string"
    )
    assert conform(df, contract).dtypes == [
        ("transaction_date", "date"),
        ("category", "string"),
        ("total_revenue", "double"),
    ]
    hole = df.withColumn("category", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="category must not be NULL"):
        conform(hole, contract).collect()
    with pytest.raises(Exception, match="category must not be NULL"):
        assert_not_null(hole, ["category"]).collect()
    assert rows(assert_not_null(hole, ["total_revenue"])) == [(1, None, "2024-01-01")]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if "shuffle_" in files.apply(k).getName()}


def test_a_stage_leaves_no_shuffle_files(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, kept = spark.conf.get(name), shuffle_files(spark)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    counted = stage(counts, "counted")
    assert not shuffle_files(spark) - kept
    assert counted.count() == 7
    assert spark.conf.get(name) == before

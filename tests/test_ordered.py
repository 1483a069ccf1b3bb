"""Carrying values along a key's order, late versions, and lookups in time."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import last_before, ordered, splice_versions, valid_at, versions_of
from lakestrata.operators.staging import stage

SEEN = "id int, place string, as_of_ingest_ts timestamp, row_hash string"
END = "9999-12-31 23:59:59"


@pytest.mark.parametrize("descending", [False, True])
def test_last_before_cuts_hot_keys(spark, setting, descending):
    """One key has most rows and few values, so values are carried over several ranges."""
    setting(spark__sql__shuffle__partitions="9", spark__sql__adaptive__enabled="false")
    rng = random.Random(1)
    rows = [
        (rng.choice([1, 1, 1, 1, 2, 3, None]), k, rng.choice([None] * 60 + [f"v{k}"]))
        for k in range(900)
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "key int, at int, value string")
    found = last_before(df, "key", ["at"], "value", "before", descending)
    expected, last = [], {}
    for key, at, value in sorted(rows, key=lambda r: -r[1] if descending else r[1]):
        expected.append((key, at, value, last.get(key) if key is not None else None))
        if value is not None:
            last[key] = value
    assert Counter(map(tuple, found.collect())) == Counter(expected)
    assert found.rdd.getNumPartitions() > 1


@pytest.fixture
def small_cuts(monkeypatch):
    monkeypatch.setattr(ordered, "_CUT_ROWS", 20)
    monkeypatch.setattr(ordered, "_SAMPLED", 2)


@pytest.mark.parametrize("descending", [False, True])
def test_values_are_carried_over_cuts(spark, small_cuts, descending):
    """A hot key is cut by its order; some cuts have no value, some orders are null."""
    rng = random.Random(3)
    rows = [
        (rng.choice([1, 1, 1, 2, None]), rng.choice([k, k, k, None]), rng.choice([None] * 60 + ["v"]))
        for k in range(600)
    ]
    # Rows without order tie, so none of them has a value.
    rows = [(key, at, f"v{at}" if value and at is not None else None) for key, at, value in rows]
    df = spark.createDataFrame(rows, "key int, at int, value string")
    placed, cut = ordered.with_cuts(df, "key", ["at"])
    parts = {key: set() for key in (1, 2, None)}
    for row in placed.collect():
        parts[row["key"]].add(row["_cut"])
    assert cut and len(parts[1]) > 5 and 0 not in parts[1] and len(parts[None]) > 5
    found = last_before(df, "key", ["at"], "value", "before", descending)
    expected, last = [], {}
    sign = -1 if descending else 1  # nulls are the least
    for key, at, value in sorted(rows, key=lambda r: sign * (-1 if r[1] is None else r[1])):
        expected.append((key, at, value, last.get(key) if key is not None else None))
        if value is not None:
            last[key] = value
    assert found.columns == ["key", "at", "value", "before"]
    assert Counter(map(tuple, found.collect())) == Counter(expected)


def test_versions_of_a_hot_key(spark, small_cuts):
    """Both looks use the same cuts."""
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 2]), d, rng.choice("ab")) for d in range(1, 29) for _ in range(4)]
    assert intervals(versions_of(observed(spark, rows), "id")) == plain_intervals(rows)


def test_small_keys_are_not_cut(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "key int, at int")
    placed, cut = ordered.with_cuts(df, "key", ["at"])
    assert not cut and {r["_cut"] for r in placed.collect()} == {0}


def observed(spark, rows):
    df = spark.createDataFrame(
        [(i, v, f"2024-01-{d:02} 00:00:00", v) for i, d, v in rows],
        "id int, place string, as_of_ingest_ts string, row_hash string",
    )
    return df.withColumn("as_of_ingest_ts", F.col("as_of_ingest_ts").cast("timestamp"))


def intervals(df):
    return sorted(
        tuple(r)
        for r in df.selectExpr(
            "id", "place", "day(valid_from)", "IF(is_current, NULL, day(valid_to))"
        ).collect()
    )


def plain_intervals(rows):
    states = defaultdict(dict)
    for i, d, v in rows:
        states[i][d] = min(v, states[i].get(d, v))
    found = []
    for i, days in states.items():
        starts = []
        for d in sorted(days):
            if not starts or starts[-1][1] != days[d]:
                starts.append((d, days[d]))
        for k, (d, v) in enumerate(starts):
            found.append((i, v, d, starts[k + 1][0] if k + 1 < len(starts) else None))
    return sorted(found, key=lambda r: tuple(r[:3]))


def test_versions_merge_equal_neighbours(spark):
    rows = [(1, 5, "a"), (1, 2, "a"), (1, 9, "b"), (1, 9, "c"), (1, 12, "b"), (2, 1, "x")]
    assert intervals(versions_of(observed(spark, rows), "id")) == [
        (1, "a", 2, 9),
        (1, "b", 9, None),
        (2, "x", 1, None),
    ]
    ends = {r[0] for r in versions_of(observed(spark, rows), "id").filter("is_current")
            .select(F.col("valid_to").cast("string")).collect()}
    assert ends == {END}


def test_any_order_of_batches_gives_one_history(spark):
    rng = random.Random(2)
    rows = [(rng.randint(1, 4), rng.randint(1, 28), rng.choice("abc")) for _ in range(40)]
    expected = plain_intervals(rows)
    for seed in (1, 2):
        order = rows[:]
        random.Random(seed).shuffle(order)
        seen = observed(spark, []).limit(0)
        history = versions_of(seen, "id").withColumn("sk", F.lit(None).cast("bigint"))
        keys = {}
        for batch in (order[:13], order[13:26], order[26:], order[:5]):
            history, seen = splice_versions(history, seen, observed(spark, batch), "id", "sk")
            history = stage(history, "history")
            numbers = [r["sk"] for r in history.collect()]
            assert len(set(numbers)) == len(numbers) and None not in numbers
            for row in history.collect():  # a start that stays keeps its key
                at = (row["id"], row["valid_from"])
                assert keys.get(at, row["sk"]) == row["sk"]
            keys = {(r["id"], r["valid_from"]): r["sk"] for r in history.collect()}
        assert intervals(history) == expected


def test_late_row_cuts_and_reopens(spark):
    seen = observed(spark, []).limit(0)
    history = versions_of(seen, "id").withColumn("sk", F.lit(None).cast("bigint"))
    for batch in ([(1, 1, "a"), (1, 5, "a"), (1, 9, "a")], [(1, 3, "b")]):
        history, seen = splice_versions(history, seen, observed(spark, batch), "id", "sk")
        history = stage(history, "history")
    assert intervals(history) == [(1, "a", 1, 3), (1, "a", 5, None), (1, "b", 3, 5)]


def test_valid_at(spark):
    versions = spark.createDataFrame(
        [(1, 10, 0, 5), (1, 11, 5, 7), (1, 12, 9, None), (2, 20, 3, None), (None, 99, 0, None)],
        "key int, sk int, valid_from int, valid_to int",
    )
    facts = spark.createDataFrame(
        [(1, -1), (1, 0), (1, 4), (1, 5), (1, 6), (1, 7), (1, 9), (1, 9), (2, 2), (2, 3), (3, 1),
         (None, 1), (1, None)],
        "key int, at int",
    )
    found = valid_at(facts, "key", "at", versions, ["sk"])
    assert found.columns == ["key", "at", "sk"]
    assert Counter(map(tuple, found.collect())) == Counter(
        [(1, -1, None), (1, 0, 10), (1, 4, 10), (1, 5, 11), (1, 6, 11), (1, 7, None), (1, 9, 12),
         (1, 9, 12), (2, 2, None), (2, 3, 20), (3, 1, None), (None, 1, None), (1, None, None)]
    )
    assert valid_at(facts.limit(0), "key", "at", versions, ["sk"]).collect() == []
    assert {r["sk"] for r in valid_at(facts, "key", "at", versions.limit(0), ["sk"]).collect()} == {None}


def test_valid_at_works_facts_out_once(spark):
    """Facts may be a costly join: not once for places, once for rows, once for loose ones."""
    seen = spark.sparkContext.accumulator(0)

    def note(at):
        seen.add(1)
        return at

    noted = F.udf(note, "int").asNondeterministic()
    facts = spark.createDataFrame(
        [(1, 4), (1, 6), (2, 1), (None, 1), (1, None)], "key int, at int"
    ).withColumn("at", noted("at"))
    versions = spark.createDataFrame(
        [(1, 10, 0, 5), (1, 11, 5, None)], "key int, sk int, valid_from int, valid_to int"
    )
    found = valid_at(facts, "key", "at", versions, ["sk"])
    assert Counter(r["sk"] for r in found.collect()) == {10: 1, 11: 1, None: 3}
    assert seen.value == 5

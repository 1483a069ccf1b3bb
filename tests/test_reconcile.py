"""Distinct counts that add up, contents compared by digest, findings over runs."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakestrata.contracts import audit_contract, ensure_tables
from lakestrata.operators import (
    audit_after,
    content_differences,
    distinct_counts,
    distinct_state,
    merge_states,
    multiset_digest,
)
from lakestrata.operators.staging import stage
from lakestrata.plans.run import RunConfig, run_silver
from lakestrata.sources import read_table
from verification.queries import reconcile_content


def test_distinct_counts_add_up(spark):
    """Ids of any sign and size, nulls, loads that overlap, groups without ids."""
    rng = random.Random(1)
    ids = [None, 0, 1, -1, 32768, 32769, -32768, -32769, 2**40, -(2**40), *range(50)]
    rows = [(rng.choice("abc"), rng.choice("xyz"), rng.choice(ids)) for _ in range(600)]
    df = spark.createDataFrame(rows, "day string, place string, id long")
    halves = [
        distinct_state(df.filter(f"place {sign} 'x'"), ["day", "place"], ["id"]) for sign in ("=", "<>")
    ]
    state = stage(merge_states(halves[0].unionByName(halves[1]), ["day", "place"]), "state")
    for groups in (["day", "place"], ["day"], []):
        places = [["day", "place"].index(g) for g in groups]
        found = {
            tuple(r[g] for g in groups): (r["n_rows"], r["n_distinct"], r["surplus"])
            for r in distinct_counts(state, groups).collect()
        }
        expected = {}
        for row in rows:
            if row[2] is not None:
                expected.setdefault(tuple(row[p] for p in places), []).append(row[2])
        assert found == {
            k: (len(v), len(set(v)), len(v) - len(set(v))) for k, v in expected.items()
        }
    assert distinct_counts(distinct_state(df.limit(0), ["day"], ["id"]), []).collect() == []


def test_sparse_ids_take_no_block_each(spark, plan):
    """Ids far apart are a few bytes in the state, and are summed up by hash."""
    df = spark.range(100).selectExpr("'a' AS day", "id * 100000 AS id")
    state = distinct_state(df, ["day"], ["id"])
    assert state.schema["bitmap"].dataType.simpleString() == "bigint"
    merged = merge_states(state, ["day"])
    assert "SortAggregate" not in plan(merged)
    assert "ObjectHashAggregate" not in plan(merged)
    row = distinct_counts(merged, []).first()
    assert (row["n_rows"], row["n_distinct"]) == (100, 100)


def test_differences_of_contents(spark, rows):
    """Swaps that keep sums, copies that cancel in an xor, nulls, groups of one side."""
    left = [(1, "a", 5.0), (1, "b", 7.0), (2, "c", 1.0), (2, "c", 1.0), (3, None, 0.0), (4, "x", 1.0),
            (None, "n", 1.0), (6, "z", None)]
    right = [(1, "b", 5.0), (1, "a", 7.0), (2, "c", 1.0), (3, None, 0.0), (5, "x", 1.0),
             (None, "n", 2.0), (6, None, None)]
    schema = "month int, name string, amount double"
    a, b = (spark.createDataFrame(x, schema) for x in (left, right))
    found = rows(content_differences(a, b, "month", ["month", "name", "amount"]))
    ours, theirs = Counter(left), Counter(right)
    expected = [
        (*row, ours[row], theirs[row]) for row in ours | theirs if ours[row] != theirs[row]
    ]
    assert found == sorted(expected, key=repr)
    assert content_differences(a, a.repartition(5), "month", a.columns).collect() == []
    sums = {r["month"]: r["n_rows"] for r in multiset_digest(a, "month", a.columns).collect()}
    assert sums == {1: 2, 2: 2, 3: 1, 4: 1, None: 1, 6: 1}


def test_planted_swap_is_found(spark):
    found = reconcile_content(spark, "/root/testdata/sf0.01").collect()
    assert found and max(r["order_month"].year for r in found) < 1997
    assert sum(r["transaction_amount"] * (r["n_left"] - r["n_right"]) for r in found) == pytest.approx(0)


def test_findings_over_runs(spark):
    contract = audit_contract("findings_")
    ensure_tables(spark, {"audit": contract})
    schema = "source_layer string, entity string, business_key string, reason string"
    runs = [
        ("r1", 1, [("b", "t", "1", "x"), ("b", "t", "1", "x"), ("b", "t", None, "y")]),
        ("r1", 1, [("b", "t", "1", "x"), ("b", "t", "1", "x"), ("b", "t", None, "y")]),
        ("r2", 2, [("b", "t", None, "y"), ("b", "c", "7", "x")]),
        ("r2", 2, [("b", "t", None, "y"), ("b", "c", "7", "x")]),
        ("r3", 3, [("b", "t", "1", "x")]),
        ("r3", 3, [("b", "t", "1", "x")]),
    ]
    audit, states = read_table(spark, contract), []
    for run, day, found in runs:
        df = spark.createDataFrame(found, schema)
        after = audit_after(audit, df, run, f"2024-01-0{day} 00:00:00")
        audit = stage(after.select(*contract.names), "audit")
        states.append(
            {
                (r["entity"], r["business_key"], r["reason"]): (
                    r["n_rows"], r["first_run"], r["last_run"], r["resolved_run"], r["times_opened"],
                    r["first_seen_at"].day, r["last_seen_at"].day,
                    r["resolved_at"] and r["resolved_at"].day,
                )
                for r in audit.collect()
            }
        )
    assert states[0] == states[1] and states[2] == states[3] and states[4] == states[5]
    assert states[2] == {
        ("t", "1", "x"): (2, "r1", "r1", "r2", 1, 1, 1, 2),
        ("t", "", "y"): (1, "r1", "r2", None, 1, 1, 2, None),
        ("c", "7", "x"): (1, "r2", "r2", None, 1, 2, 2, None),
    }
    assert states[4] == {
        ("t", "1", "x"): (1, "r1", "r3", None, 2, 1, 3, None),
        ("t", "", "y"): (1, "r1", "r2", "r3", 1, 1, 2, 3),
        ("c", "7", "x"): (1, "r2", "r2", "r3", 1, 2, 2, 3),
    }


def test_silver_writes_the_audit(spark, contracts):
    contract = audit_contract(contracts["silver.quarantine_rows"].prefix)
    ensure_tables(spark, {"audit": contract})
    cfg = RunConfig(as_of="2024-02-01 00:00:00", quarantine="audit", contracts=contracts)
    spark.sql(
        f"INSERT INTO {contracts['bronze.feed_rejects'].table} VALUES "
        "('products', NULL, 'short_record', '1', 'p', TIMESTAMP'2024-01-01', 'k')"
    )
    for _ in range(2):
        run_silver(spark, cfg)
    (row,) = read_table(spark, contract).collect()
    assert (row["entity"], row["reason"], row["n_rows"]) == ("product", "short_record", 1)
    assert row["first_run"] == row["last_run"] == "2024-02-01 00:00:00"

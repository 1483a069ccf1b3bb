"""Stored changes, runs from the mark, and marts kept up by changes."""

import random
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.contracts import TableContract, change_contract, ensure_tables, incremental_contracts
from lakestrata.operators import net_changes
from lakestrata.plans import gold, silver
from lakestrata.plans.incremental import (
    run_gold_by_changes,
    run_incremental,
    run_silver_since,
)
from lakestrata.plans.marts import MARTS, refresh_mart
from lakestrata.plans.run import HISTORY, RunConfig, run_silver
from lakestrata.sinks import commits, last_commit, merge_table, merge_with_changes
from lakestrata.session import brief_shuffles, shared_folder
from lakestrata.sinks.commits import net_changes_between, read_changes, state_at
from lakestrata.sources import read_table
from tests.test_layers import AS_OF, bronze

SCHEMA = "month date, id int, value string"


def make_contract(spark, prefix, partition):
    contract = TableContract(
        "gold",
        "items",
        T.StructType.fromDDL("month DATE NOT NULL, id INT NOT NULL, value STRING"),
        keys=("month", "id"),
        refresh="merge",
        partition="month" if partition else None,
        prefix=prefix,
    )
    ensure_tables(spark, {c.name: c for c in (contract, change_contract(contract))})
    return contract


def items(spark, cells):
    """{(month, id): value} as rows."""
    data = [(f"2024-{m:02}-01", i, v) for (m, i), v in cells.items()]
    df = spark.createDataFrame(data, "month string, id int, value string")
    return df.withColumn("month", F.col("month").cast("date"))


def cells(df):
    return {(r["month"].month, r["id"]): r["value"] for r in df.collect()}


@pytest.mark.parametrize("partition", [True, False])
def test_replayed_changes_equal_the_table(spark, partition):
    contract = make_contract(spark, f"commits{int(partition)}_", partition)
    rng = random.Random(3)
    state, states = {}, [{}]
    for step in range(4):
        batch = {
            (rng.randint(1, 3), rng.randint(1, 6)): rng.choice(["a", "b", None]) for _ in range(6)
        }
        if step == 2:
            merge_with_changes(spark, contract, items(spark, batch), delete_missing=True)
            state = batch
        else:
            merge_with_changes(spark, contract, items(spark, batch))
            state = state | batch
        states.append(state)
        assert cells(read_table(spark, contract)) == state
    upto = last_commit(spark, contract)
    assert upto == 4
    for commit in (1, 3, upto):
        assert cells(state_at(spark, contract, commit)) == states[commit]
    before, after = states[1], states[upto]
    net = {}
    for row in net_changes_between(spark, contract, 1).collect():
        net.setdefault((row["month"].month, row["id"]), {})[row["_change_type"]] = row["value"]
    expected = {}
    for key in before.keys() | after.keys():
        if key not in before:
            expected[key] = {"insert": after[key]}
        elif key not in after:
            expected[key] = {"delete": before[key]}
        elif before[key] != after[key]:
            expected[key] = {"update_preimage": before[key], "update_postimage": after[key]}
    assert net == expected
    # Nothing new: no commit, no files.
    assert merge_with_changes(spark, contract, items(spark, state)) is None
    assert last_commit(spark, contract) == upto


def test_keep_and_scope(spark):
    contract = make_contract(spark, "scopes_", True)
    merge_with_changes(spark, contract, items(spark, {(1, 1): "a", (1, 2): "b", (2, 3): "c"}))
    merge_with_changes(spark, contract, items(spark, {(1, 1): "x", (3, 4): "d"}), "keep")
    assert cells(read_table(spark, contract)) == {(1, 1): "a", (1, 2): "b", (2, 3): "c", (3, 4): "d"}
    # The source is the whole content of the scope's keys: what it lacks goes, and an
    # emptied month with it.
    scope = items(spark, {(2, 3): None, (1, 2): None})
    merge_with_changes(spark, contract, items(spark, {(1, 2): "z"}), scope=scope)
    assert cells(read_table(spark, contract)) == {(1, 1): "a", (1, 2): "z", (3, 4): "d"}
    assert "month=2024-02-01" not in [
        r[0] for r in spark.sql(f"SHOW PARTITIONS {contract.table}").collect()
    ]
    with pytest.raises(ValueError):
        merge_with_changes(spark, contract, items(spark, {}), "replace")


def test_a_commit_cut_short_is_finished(spark, monkeypatch):
    """The images are visible, the table is not yet or half written: the next call goes on."""
    contract = make_contract(spark, "cut_", True)
    merge_with_changes(spark, contract, items(spark, {(1, 1): "a", (2, 2): "b"}))

    def die(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(commits, "rewrite_rows", die)
        with pytest.raises(RuntimeError):
            merge_with_changes(spark, contract, items(spark, {(1, 1): "x", (3, 3): "c"}))
    assert cells(read_table(spark, contract)) == {(1, 1): "a", (2, 2): "b"}
    assert read_changes(spark, contract).filter("_commit = 2").isEmpty()  # not done yet
    with monkeypatch.context() as patched:  # inserts only, written but not counted as done
        patched.setattr(commits, "set_table_number", die)
        with pytest.raises(RuntimeError):
            merge_with_changes(spark, contract, items(spark, {(5, 5): "e"}))
    merge_with_changes(spark, contract, items(spark, {(5, 5): "e"}))
    expected = {(1, 1): "x", (2, 2): "b", (3, 3): "c", (5, 5): "e"}
    assert cells(read_table(spark, contract)) == expected
    assert cells(state_at(spark, contract)) == expected


def test_net_changes_collapse(spark):
    data = [
        (1, "a", "insert", 1), (1, "a", "update_preimage", 2), (1, "b", "update_postimage", 2),
        (2, "a", "insert", 1), (2, "a", "delete", 3),
        (3, "a", "delete", 1), (3, "a", "insert", 2),
        (4, "a", "delete", 1), (4, None, "insert", 2),
        (5, "a", "update_preimage", 1), (5, None, "update_postimage", 1), (5, None, "delete", 4),
        (6, None, "insert", 9),
    ]
    changes = spark.createDataFrame(data, "id int, value string, _change_type string, _commit long")
    found = {tuple(r) for r in net_changes(changes, ["id"]).collect()}
    assert found == {
        (1, "b", "insert"),
        (4, "a", "update_preimage"),
        (4, None, "update_postimage"),
        (5, "a", "delete"),
        (6, None, "insert"),
    }


# ------------------------------------------------------------- layered runs


def sale(i, customer, product, amount, day, when):
    return (i, customer, product, 1, amount, f"{day} 10:00:00", "online", *when)


def stored(df, *drop):
    return Counter(map(tuple, df.drop(*drop).collect()))


def test_runs_from_the_mark_equal_full_ones(spark):
    """Corrections, vanishing rows and groups, moved customers, late products, odd amounts."""
    contracts = incremental_contracts(prefix="marked_")
    ensure_tables(spark, contracts)
    cfg = RunConfig(as_of=AS_OF, dimensions=HISTORY, contracts=contracts)
    t = [(f"2024-01-0{k}", f"b{k}") for k in range(1, 4)]
    customer = ("Lee", None, "Rome", "IT", "2020-01-01", "Gold")
    loads = [
        {
            "customers": [(1, "Ann", *customer, *t[0]), (2, "Bo", *customer, *t[0])],
            "products": [(1, "n1", "Toys", "b", 1.5, "2020-01-01", *t[0])],
            "transactions": [
                sale(1, 1, 1, 10.1, "2024-01-05", t[0]),
                sale(2, 2, 1, 20.2, "2024-01-05", t[0]),
                sale(3, 1, 1, 5.5, "2024-02-07", t[0]),
                sale(4, None, 1, 7.0, "2024-02-07", t[0]),
                sale(5, 2, 9, 8.0, "2024-02-08", t[0]),  # product not known yet
                sale(6, 1, 1, 1e-13, "2024-03-01", t[0]),  # no decimal of ten digits
            ],
        },
        {
            "customers": [(1, "Anna", *customer, *t[1])],  # another name
            "products": [(9, "n9", "Books", "b", 2.5, None, *t[1])],
            "transactions": [
                sale(2, 2, 1, 21.2, "2024-02-05", t[1]),  # another amount and month
                sale(3, 1, 7, 5.5, "2024-02-07", t[1]),  # now with an unknown product
                sale(4, 2, 1, 7.0, "2024-02-07", t[1]),  # now with a customer
                sale(6, 1, 1, 2.0, "2024-03-01", t[1]),
            ],
        },
        {"transactions": [sale(7, 2, 1, 0.1, "2024-03-01", t[2])]},
    ]
    fact = contracts["silver.fact_transaction"]
    for load in loads:
        for name, data in load.items():
            merge_table(spark, contracts[f"bronze.{name}"], bronze(spark, name, data), "keep")
        run_incremental(spark, cfg)
        now = read_table(spark, fact)
        customers = read_table(spark, contracts["silver.dim_customer"])
        products = read_table(spark, contracts["silver.dim_product"])
        full = {
            "daily_revenue": gold.daily_revenue(now),
            "customer_spend_by_month": gold.customer_spend_by_month(now, customers),
            "category_sales_daily": gold.category_sales_daily(now, products),
        }
        for name, mart in full.items():
            contract = contracts[f"gold.{name}"]
            assert stored(read_table(spark, contract)) == stored(mart.select(*contract.names)), name
    done = last_commit(spark, fact)

    # The same rows by full runs with history.
    again = incremental_contracts(prefix="whole_")
    again["silver.fact_transaction"] = replace(again["silver.fact_transaction"], refresh="replace")
    ensure_tables(spark, again)
    for load in loads:
        for name, data in load.items():
            merge_table(spark, again[f"bronze.{name}"], bronze(spark, name, data), "keep")
        run_silver(spark, RunConfig(as_of=AS_OF, dimensions=HISTORY, contracts=again))
    for name in ("dim_customer", "dim_product", "fact_transaction", "quarantine_rows"):
        ours, theirs = (read_table(spark, c[f"silver.{name}"]) for c in (contracts, again))
        assert stored(ours) == stored(theirs), name

    # Nothing new: nothing is written.
    run_incremental(spark, cfg)
    assert last_commit(spark, fact) == done

    # A mart that lost count of its commits reads them again and counts none twice.
    marts = [contracts[f"gold.{mart.name}"] for mart in MARTS]
    before = [stored(read_table(spark, c)) for c in marts]
    for mart in MARTS:
        commits.set_table_number(
            spark, contracts[f"gold.{mart.name}_state"].table, "lakestrata.applied", 0
        )
    assert refresh_mart(spark, contracts, MARTS[0]) > 0
    run_gold_by_changes(spark, cfg)
    assert [stored(read_table(spark, c)) for c in marts] == before


def two_sales(spark, prefix):
    """A run from the mark over a small load, ready for its silver layer."""
    contracts = incremental_contracts(prefix=prefix)
    ensure_tables(spark, contracts)
    cfg = RunConfig(as_of=AS_OF, dimensions=HISTORY, contracts=contracts)
    when = ("2024-01-01", "b1")
    customer = ("Lee", None, "Rome", "IT", "2020-01-01", "Gold")
    load = {
        "customers": [(1, "Ann", *customer, *when)],
        "products": [(1, "n1", "Toys", "b", 1.5, "2020-01-01", *when)],
        "transactions": [sale(k, 1, 1, k * 1.5, "2024-01-05", when) for k in (1, 2)],
    }
    for name, data in load.items():
        merge_table(spark, contracts[f"bronze.{name}"], bronze(spark, name, data), "keep")
    return cfg


def stages_with_rows(spark, but=()):
    folder = Path(shared_folder(spark).removeprefix("file:"), "stages")
    new = set(folder.glob("*")) - set(but)
    return new, {p.name.rsplit("-", 1)[0] for p in new if spark.read.parquet(str(p)).count()}


def test_silver_from_the_mark_leaves_no_copy_of_bronze(spark):
    cfg = two_sales(spark, "brief_")
    before, _ = stages_with_rows(spark)
    run_silver_since(spark, cfg)
    _, left = stages_with_rows(spark, before)
    assert not left & {"affected", "affected-rows", "ids", "fact_transaction"}
    assert read_table(spark, cfg.contracts["silver.fact_transaction"]).count() == 2


def test_rows_of_affected_transactions_carry_no_fingerprints(spark, monkeypatch):
    cfg, seen = two_sales(spark, "narrow_"), []
    whole = silver.fact_transaction
    monkeypatch.setattr(
        silver, "fact_transaction", lambda rows, *a: seen.append(rows.columns) or whole(rows, *a)
    )
    run_silver_since(spark, cfg)
    assert seen and "_bronze_row_key" not in seen[0] and "_source_name" not in seen[0]


def test_marts_by_changes_leave_no_stages_of_deltas(spark):
    cfg = two_sales(spark, "lean_")
    run_silver_since(spark, cfg)
    before, _ = stages_with_rows(spark)
    run_gold_by_changes(spark, cfg)
    _, left = stages_with_rows(spark, before)
    assert not left & {"deltas", "touched", "state", "daily_revenue", "category_sales_daily"}
    assert read_table(spark, cfg.contracts["gold.daily_revenue"]).first().total_revenue == 4.5


def test_tables_and_commits_are_zstd(spark):
    cfg = two_sales(spark, "packed_")
    run_silver_since(spark, cfg)
    fact = cfg.contracts["silver.fact_transaction"]
    for contract in (cfg.contracts["bronze.transactions"], fact, change_contract(fact)):
        files = spark.table(contract.table).inputFiles()
        assert files and all(".zstd." in name for name in files), contract.table


def test_overlapping_blocks_put_the_setting_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, one, other = spark.conf.get(name), brief_shuffles(spark), brief_shuffles(spark)
    one.__enter__()
    other.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(name) == "true"
    other.__exit__(None, None, None)
    assert spark.conf.get(name) == before

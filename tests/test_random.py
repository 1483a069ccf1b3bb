"""Random tables against plain Python, and loads in different orders."""

import random

import pytest

from lakestrata.operators import change_set, scd2_apply, upsert, upsert_stored
from lakestrata.plans.bronze import load_feed
from lakestrata.sources import feeds, read_table

KEYS = 40


def random_table(rng):
    return {
        (rng.randint(1, KEYS), rng.choice("ab")): rng.choice([None, "x", "y", "z"])
        for _ in range(KEYS)
    }


def frame(spark, table):
    return spark.createDataFrame(
        [(*key, value) for key, value in table.items()], "k int, l string, v string"
    ).repartition(3)


def as_table(df):
    return {(r.k, r.l): r.v for r in df.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_upsert_is_a_dict_update(spark, seed):
    rng = random.Random(seed)
    old, new = random_table(rng), random_table(rng)
    for way in (upsert, upsert_stored):
        result = way(frame(spark, old), frame(spark, new), ["k", "l"])
        assert result.count() == len(old | new)
        assert as_table(result) == old | new
        kept = way(frame(spark, old), frame(spark, new), ["k", "l"], on_match="keep")
        assert as_table(kept) == new | old


@pytest.mark.parametrize("seed", range(2))
def test_changes_replay_to_the_new_state(spark, seed):
    rng = random.Random(100 + seed)
    old, new = random_table(rng), random_table(rng)
    changes = change_set(frame(spark, old), frame(spark, new), ["k", "l"]).collect()
    replayed = dict(old)
    for row in changes:
        if row._change_type == "delete":
            assert replayed.pop((row.k, row.l)) == row.v
        elif row._change_type == "update_preimage":
            assert old[row.k, row.l] == row.v != new[row.k, row.l]
        else:
            replayed[row.k, row.l] = row.v
    assert replayed == new
    same = sum(old[k] == new[k] for k in old.keys() & new.keys())
    assert len(changes) == len(old) + len(new) - 2 * same


def test_history_over_random_batches(spark):
    rng = random.Random(7)
    dim = spark.createDataFrame(
        [],
        "sk long, id int, row_hash string, as_of_ingest_ts timestamp, "
        "valid_from timestamp, valid_to timestamp, is_current boolean",
    )
    versions, current = 0, {}
    for day in range(1, 4):
        state = {i: str(rng.randint(1, 2)) for i in rng.sample(range(30), 20)}
        versions += sum(current.get(i) != h for i, h in state.items())
        current |= state
        batch = spark.createDataFrame(list(state.items()), "id int, row_hash string").selectExpr(
            "*", f"TIMESTAMP'2024-01-0{day} 00:00:00' AS as_of_ingest_ts"
        )
        dim = scd2_apply(dim, batch, "id", "sk", f"2024-01-0{day} 12:00:00")
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    rows = dim.collect()
    assert {r.id: r.row_hash for r in rows if r.is_current} == current
    assert sorted(r.sk for r in rows) == list(range(1, versions + 1))
    for key in current:
        spans = sorted((r.valid_from, r.valid_to) for r in rows if r.id == key)
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert spans[-1][1].year == 9999


def test_two_loads_equal_one(spark, rows, contracts, tmp_path):
    """With "keep", batches one after the other give the rows of both at once."""
    head = "product_id,product_name,category,brand,price,created_date\n"
    batches = ["1,a,c,b,1,\n2,a,c,b,2,\n", "2,a,c,b,2,\n2,new,c,b,2,\n3,a,c,b,x,\n"]
    columns = contracts["bronze.products"].feed_columns

    def load(*names):
        for name in names:
            load_feed(
                spark,
                feeds(contracts)["products"],
                str(tmp_path / name),
                contracts["bronze.feed_rejects"],
                on_match="keep",
            )
        return rows(read_table(spark, contracts["bronze.products"]), *columns)

    for name, text in zip(("one", "two"), batches):
        (tmp_path / "both" / name).mkdir(parents=True)
        (tmp_path / "both" / name / "f.csv").write_text(head + text)
    apart = load("both/one", "both/two")
    assert load("both") == apart
    assert [row[:2] for row in apart] == [(1, "a"), (2, "a"), (2, "new")]
    assert read_table(spark, contracts["bronze.feed_rejects"]).count() == 1

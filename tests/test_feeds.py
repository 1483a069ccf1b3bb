"""CSV in and out, typing, lineage, bronze loads, file ingest."""

from pathlib import Path

import pytest

from lakestrata.contracts import ensure_tables, ledger_contract
from lakestrata.plans import bronze
from lakestrata.plans.bronze import load_feed
from lakestrata.plans.ledger import load_new_files
from lakestrata.session import shared_folder
from lakestrata.sinks import show_overview, write_csv, write_ordered_csv
from lakestrata.sources import (
    feeds,
    read_feed,
    read_table,
    reject_rows,
    require_table,
    session_info,
    typed_rows,
    valid_rows,
)
from lakestrata.streaming import ingest_new_files

PRODUCTS = "product_id,product_name,category,brand,price,created_date\n"


def write(folder: Path, name: str, text: str) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def load(spark, contracts, feed, path, **options):
    load_feed(spark, feeds(contracts)[feed], path, contracts["bronze.feed_rejects"], **options)
    return read_table(spark, contracts[f"bronze.{feed}"])


def test_quotes_survive_the_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame(
        [(1, 'say "hi"', "a,b", "  x ", 1.5, "2024-01-01")],
        "product_id int, product_name string, category string, brand string, "
        "price double, created_date string",
    )
    path = write_csv(df, str(tmp_path / "out"))
    back = read_feed(spark, feeds()["products"], path)
    assert rows(back, *df.columns) == [("1", 'say "hi"', "a,b", "  x ", "1.5", "2024-01-01")]


def test_lineage_names_the_file(spark, tmp_path):
    path = write(tmp_path / "deep" / "er", "p.csv", PRODUCTS + "1,n,c,b,1.5,2024-01-01\n")
    row = read_feed(spark, feeds()["products"], str(tmp_path), "2024-01-01").first()
    assert row._source_name == "p.csv"
    assert row._source_path.endswith(f"{path}/p.csv")
    assert row._source_size_bytes == Path(path, "p.csv").stat().st_size
    assert str(row._ingest_ts) == "2024-01-01 00:00:00"


def test_columns_are_found_by_name(spark, rows, tmp_path):
    text = "price,brand,extra,product_id,product_name,category,created_date\n9.5,b,?,1,n,c,\n"
    path = write(tmp_path, "p.csv", text)
    feed = feeds()["products"]
    typed = valid_rows(typed_rows(read_feed(spark, feed, path), feed), feed)
    assert rows(typed, "product_id", "brand", "price") == [(1, "b", 9.5)]
    write(tmp_path / "short", "p.csv", "product_id,price\n1,2\n")
    with pytest.raises(ValueError, match="no column product_name, category"):
        read_feed(spark, feed, str(tmp_path / "short"))


def test_bad_cells_reject_the_row_only(spark, rows, tmp_path):
    text = PRODUCTS + (
        "1,good,c,b,1.5,2024-01-01\n"
        "2,bad price,c,b,abc,2024-01-01\n"
        "3,bad date,c,b,1,2024-13-01\n"
        ",no id,c,b,1,2024-01-01\n"
        "x,bad id,c,b,1,2024-01-01\n"
        "4,blank price,c,b, ,\n"
    )
    feed = feeds()["products"]
    typed = typed_rows(read_feed(spark, feed, write(tmp_path, "p.csv", text)), feed)
    assert rows(valid_rows(typed, feed), "product_id", "price") == [(1, 1.5), (4, None)]
    assert rows(reject_rows(typed, feed), "business_key", "reason") == sorted(
        [
            ("2", "cast_failed:price"),
            ("3", "cast_failed:created_date"),
            (None, "required_null:product_id"),
            ("x", "cast_failed:product_id"),
        ],
        key=repr,
    )
    assert '"price":"abc"' in reject_rows(typed, feed).filter("business_key = '2'").first().raw_row


def test_load_is_repeatable(spark, rows, contracts, tmp_path):
    text = PRODUCTS + "1,n,c,b,1.5,2024-01-01\n1,n,c,b,1.5,2024-01-01\n2,n,c,b,bad,\n"
    path = write(tmp_path, "p.csv", text)
    first = load(spark, contracts, "products", path, ingest_ts="2024-01-01")
    assert first.count() == 1
    kept = load(spark, contracts, "products", path, on_match="keep", ingest_ts="2024-01-02")
    assert [str(r._ingest_ts) for r in kept.collect()] == ["2024-01-01 00:00:00"]
    touched = load(spark, contracts, "products", path, ingest_ts="2024-01-03")
    assert [str(r._ingest_ts) for r in touched.collect()] == ["2024-01-03 00:00:00"]
    rejects = read_table(spark, contracts["bronze.feed_rejects"])
    assert rows(rejects, "feed", "business_key", "reason") == [
        ("products", "2", "cast_failed:price")
    ]
    write(tmp_path, "q.csv", PRODUCTS + "1,renamed,c,b,1.5,2024-01-01\n")
    both = load(spark, contracts, "products", path, on_match="keep", ingest_ts="2024-01-04")
    assert rows(both, "product_id", "product_name") == [(1, "n"), (1, "renamed")]
    with pytest.raises(ValueError, match="on_match"):
        load(spark, contracts, "products", path, on_match="update")


def test_transactions_in_month_partitions(spark, rows, contracts, tmp_path):
    head = (
        "transaction_id,customer_id,product_id,quantity,"
        "transaction_amount,transaction_timestamp,channel\n"
    )
    january = "1,7,1,2,10.50,2024-01-05 10:00:00,online\n"
    path = write(tmp_path, "a.csv", head + january + "2,,1,1,5,2024-02-01T00:00:00,store\n")
    loaded = load(spark, contracts, "transactions", path, ingest_ts="2024-03-01")
    assert rows(loaded, "transaction_id", "customer_id", "transaction_amount") == [
        (1, 7, 10.5),
        (2, None, 5.0),
    ]
    assert loaded.columns == contracts["bronze.transactions"].names
    other = write(tmp_path / "new", "b.csv", head + january + "3,7,1,1,1,2024-03-01,store\n")
    merged = load(spark, contracts, "transactions", other, ingest_ts="2024-04-01")
    assert rows(merged, "transaction_id", "_source_name") == [
        (1, "b.csv"),
        (2, "a.csv"),
        (3, "b.csv"),
    ]
    partitions = spark.sql(f"SHOW PARTITIONS {contracts['bronze.transactions'].table}")
    assert partitions.count() == 3
    again = load(spark, contracts, "transactions", path, on_match="keep")
    assert again.count() == 3


def test_missing_table_is_named(spark, tmp_path):
    with pytest.raises(RuntimeError, match="nowhere.to_be_found"):
        require_table(spark, "nowhere.to_be_found")


def test_ensure_tables_can_run_again(spark, contracts):
    ensure_tables(spark, contracts)
    assert len(contracts) == 12
    for contract in contracts.values():
        stored = read_table(spark, contract)
        assert stored.columns == contract.names
        assert [f.dataType for f in stored.schema.fields] == [
            f.dataType for f in contract.columns.fields
        ]


def test_new_files_are_read_once(spark, rows, contracts, tmp_path):
    path = write(tmp_path / "in", "a.csv", PRODUCTS + "1,n,c,b,1.5,\n2,n,c,b,2,\n")

    def ingest():
        ingest_new_files(
            spark,
            feeds(contracts)["products"],
            path,
            contracts["bronze.feed_rejects"],
            str(tmp_path / "checkpoint"),
        )
        return rows(
            read_table(spark, contracts["bronze.products"]), "product_id", "_source_name"
        )

    assert ingest() == [(1, "a.csv"), (2, "a.csv")]
    assert ingest() == [(1, "a.csv"), (2, "a.csv")]
    write(tmp_path / "in", "b.csv", PRODUCTS + "2,n,c,b,2,\n3,n,c,b,3,\n4,n,c,b,bad,\n")
    assert ingest() == [(1, "a.csv"), (2, "a.csv"), (3, "b.csv")]
    assert read_table(spark, contracts["bronze.feed_rejects"]).count() == 1


def test_session_info_and_overview(spark, capsys):
    info = session_info(spark).first()
    assert info.user and info.ts
    show_overview("one row", spark.range(1))
    shown = capsys.readouterr().out
    assert "== one row" in shown and "1 rows" in shown


HEADER = PRODUCTS.strip()


def test_short_and_long_records_are_rejects(spark, tmp_path, contracts, rows):
    """Every record is a good row or a reject; quoted commas and quotes do not count."""
    good = ['1,"a, ""b""",c,d,1.5,2020-01-01', '2,"x,y,z",c,d,,']
    bad = ["3,a,c", "4,a,c,d,1.5,2020-01-01,more", '5,"a,b",c,d,1', "6,a,c,d,nan,2020-01-01", ",,,,,"]
    write(tmp_path, "p.csv", "\n".join([HEADER, *good, *bad]) + "\n")
    load_feed(spark, feeds(contracts)["products"], str(tmp_path), contracts["bronze.feed_rejects"])
    stored = read_table(spark, contracts["bronze.products"])
    assert rows(stored, "product_id", "product_name", "price") == [
        (1, 'a, "b"', 1.5),
        (2, "x,y,z", None),
    ]
    rejects = read_table(spark, contracts["bronze.feed_rejects"])
    assert rows(rejects, "business_key", "reason") == sorted(
        [
            ("3", "short_record"),
            ("4", "long_record"),
            ("5", "short_record"),
            ("6", "cast_failed:price"),
            (None, "required_null:product_id"),
        ],
        key=repr,
    )
    assert "4,a,c,d,1.5,2020-01-01,more" in [r["raw_row"] for r in rejects.collect()]


def test_headers_of_any_order(spark, tmp_path, contracts, rows):
    write(tmp_path, "a b.csv", f"{HEADER}\n1,n,c,b,1.0,2020-01-01\n")
    write(tmp_path, "b.csv", 'price,"brand",extra,product_id,category,created_date,product_name\n2.0,b,"e,e",2,c,,n\n3.0,b,3\n')
    products = feeds(contracts)["products"]
    with pytest.raises(Exception):
        read_feed(spark, products, str(tmp_path)).collect()
    found = read_feed(spark, products, str(tmp_path), headers="any")
    assert rows(found, "product_id", "product_name", "price", "_record_problem") == sorted(
        [("1", "n", "1.0", None), ("2", "n", "2.0", None), (None, None, "3.0", "short_record")], key=repr
    )
    with pytest.raises(ValueError):
        read_feed(spark, products, str(tmp_path), headers="some")
    other = tmp_path / "none"
    other.mkdir()
    write(other, "c.csv", "product_id,price\n1,2\n")
    with pytest.raises(ValueError, match="no file"):
        read_feed(spark, products, str(other), headers="any")


def test_ledger_reads_changed_files_once_more(spark, tmp_path, contracts, rows):
    products, rejects = feeds(contracts)["products"], contracts["bronze.feed_rejects"]
    ledger, folder = ledger_contract(products.contract.prefix), tmp_path / "in"
    ensure_tables(spark, {"ledger": ledger})
    folder.mkdir()

    def call(n):
        return load_new_files(
            spark, products, str(folder), rejects, ledger, ingest_ts=f"2024-01-0{n} 00:00:00"
        )

    write(folder, "a 1.csv", f"{HEADER}\n1,n,c,b,1.0,\n")
    assert (call(1), call(2)) == (1, 0)
    write(folder, "b.csv", f"{HEADER}\n2,n,c,b,1.0,\n")
    assert call(3) == 1
    write(folder, "a 1.csv", f"{HEADER}\n1,n,c,b,1.0,\n3,n,c,b,1.0,\n")
    assert (call(4), call(5)) == (1, 0)
    stored = read_table(spark, products.contract).selectExpr("product_id", "day(_ingest_ts)")
    assert rows(stored) == [(1, 4), (2, 3), (3, 4)]
    assert read_table(spark, ledger).count() == 3

    # A stream over the same folder leaves them out, and tells the ledger of its own.
    write(folder, "c.csv", f"{HEADER}\n4,n,c,b,1.0,\n5,n\n")
    ingest_new_files(
        spark, products, str(folder), rejects, str(tmp_path / "stream"),
        ingest_ts="2024-01-06 00:00:00", ledger=ledger,
    )
    stored = read_table(spark, products.contract).selectExpr("product_id", "day(_ingest_ts)")
    assert rows(stored) == [(1, 4), (2, 3), (3, 4), (4, 6)]
    assert rows(read_table(spark, rejects), "reason") == [("short_record",)]
    assert call(7) == 0 and read_table(spark, ledger).count() == 4


def joined_parts(path):
    return b"".join(part.read_bytes() for part in sorted(Path(path).glob("part-*")))


@pytest.mark.parametrize("rows", [0, 1, 400])
def test_ordered_parts_are_one_file(spark, tmp_path, rows):
    """Quotes, separators, line ends, nulls, and a day that a third of the rows have."""
    notes = ['a "b", c', "", None, "two\nlines", " edge ", "x,y", "back\\slash"]
    df = spark.createDataFrame(
        [
            (k, 1 if k % 3 == 0 else k % 40, notes[k % 7], None if k % 5 else k / 4)
            for k in range(rows)
        ],
        "id int, part int, value string, c1 double",
    ).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = write_ordered_csv(df, str(tmp_path / "parts"), by=["part"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    single = write_csv(df.orderBy("part", "id").coalesce(1), str(tmp_path / "single"))
    expected = joined_parts(single) or b"id,part,value,c1\n"
    assert joined_parts(parts) == expected
    if rows > 100:
        assert len(list(Path(parts).glob("part-*"))) > 2


def test_update_writes_rows_once_into_their_months(spark, rows, contracts, tmp_path, capsys):
    """No key is shuffled, no source row is staged, and months keep their other rows."""
    feed = feeds(contracts)["transactions"]
    head = ",".join(feed.contract.feed_columns) + "\n"
    line = "{},7,8,1,2.5,2024-0{}-03 00:00:00,online\n"
    path = write(tmp_path, "a.csv", head + line.format(1, 1) * 3 + line.format(2, 2) + "x" * 9 + "\n")
    typed = typed_rows(read_feed(spark, feed, path, "2024-05-01"), feed)
    placed = bronze._placed(typed, feed)
    capsys.readouterr()
    placed.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1
    assert "sha2" not in plan[plan.index("Exchange") :]
    folder = Path(shared_folder(spark), "stages")
    staged = set(folder.glob("transactions-*"))
    load(spark, contracts, "transactions", path, ingest_ts="2024-05-01")
    write(tmp_path, "a.csv", head + line.format(1, 1) + line.format(3, 1) + line.format(4, 3))
    after = load(spark, contracts, "transactions", path, ingest_ts="2024-05-02")
    assert rows(after.selectExpr("transaction_id", "day(_ingest_ts)", "month(transaction_timestamp)")) == [
        (1, 2, 1), (2, 1, 2), (3, 2, 1), (4, 2, 3)
    ]
    assert set(folder.glob("transactions-*")) == staged
    assert rows(read_table(spark, contracts["bronze.feed_rejects"]), "raw_row") == [("x" * 9,)]

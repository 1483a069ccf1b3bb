"""Bronze: one row per distinct feed row."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack
from datetime import datetime
from functools import partial, reduce
from itertools import takewhile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.contracts import TableContract
from lakestrata.functions.keys import content_text
from lakestrata.operators.dedupe import latest_by, recency_order
from lakestrata.operators.staging import staged
from lakestrata.session import side_by_side
from lakestrata.sinks.tables import merge_placed, merge_table
from lakestrata.sources.feeds import (
    Feed,
    add_fingerprint,
    add_keys,
    read_feed,
    reject_rows,
    typed_rows,
    valid_rows,
)
from lakestrata.sources.tables import require_table


def distinct_content(rows: DataFrame, feed: Feed | None = None) -> DataFrame:
    """Exact copies reduced to one row, chosen by the total order of lineage.

    With ``feed``, whose key is a number, rows are placed by that key and their
    fingerprints, which name it, are worked out after the shuffle.
    """
    order = recency_order()[:2]
    if feed is None:
        return latest_by(rows, ["_bronze_row_key"], order)
    placed = rows.drop("_bronze_row_key").repartition(feed.business_key)
    keyed = add_fingerprint(placed, feed)
    return latest_by(keyed, [feed.business_key, "_bronze_row_key"], order).select(*rows.columns)


def load_feed(
    spark: SparkSession,
    feed: Feed,
    path: str,
    rejects: TableContract,
    on_match: str = "touch",
    ingest_ts: str | datetime | Column | None = None,
    headers: str = "same",
) -> None:
    """Load a feed folder into its bronze table and set bad rows aside.

    A row already stored gets this load's lineage with ``on_match="touch"`` and
    keeps its first lineage with ``"keep"``.  Content never changes under one
    key: a corrected record is a new row.  Keep is the mode for folders that
    still hold old files, and the cheap one: it only appends.
    """
    load_feeds(spark, [(feed, path)], rejects, on_match, ingest_ts, headers)


def load_feeds(
    spark: SparkSession,
    sources: Sequence[tuple[Feed, str | list[str]]],
    rejects: TableContract,
    on_match: str = "touch",
    ingest_ts: str | datetime | Column | None = None,
    headers: str = "same",
) -> None:
    """Load several feeds, which do not depend on each other, side by side."""
    for feed, _ in sources:
        require_table(spark, feed.contract.table)
    typed = [
        (feed, typed_rows(read_feed(spark, feed, path, ingest_ts, headers), feed))
        for feed, path in sources
    ]
    store_typed(spark, typed, rejects, on_match)


def store_typed(
    spark: SparkSession,
    typed: Sequence[tuple[Feed, DataFrame]],
    rejects: TableContract,
    on_match: str,
) -> None:
    """Write typed rows to their bronze tables and all rejects to one table.

    Good and bad rows are deduplicated together and written once, so the text is
    read, typed and shuffled once for both tables.  An update of a partitioned table
    needs no stage: its rows are shuffled by partition and content, without their
    fingerprints, and what is written are the table's new files.
    """
    if on_match not in ("touch", "keep"):
        raise ValueError(f"on_match must be 'touch' or 'keep', not {on_match!r}")
    mode = "update" if on_match == "touch" else "keep"
    with ExitStack() as stages:
        bad: list[DataFrame] = []

        def store(feed: Feed, rows: DataFrame) -> None:
            if mode == "update" and feed.contract.partition:
                bad.append(reject_rows(merge_placed(spark, feed.contract, _placed(rows, feed)), feed))
                return
            keyed = rows.selectExpr("*", "coalesce(_reject_key, _bronze_row_key) AS _row")
            distinct = latest_by(keyed, ["_row"], recency_order()[:2]).drop("_row")
            stored = stages.enter_context(staged(distinct, feed.name))
            merge_table(spark, feed.contract, valid_rows(stored, feed), mode, stored=True)
            bad.append(reject_rows(stored, feed))

        side_by_side(spark, [partial(store, feed, rows) for feed, rows in typed])
        if bad:
            all_bad = reduce(DataFrame.unionByName, bad)
            merge_table(spark, rejects, all_bad, "keep", stored=True)


# Tasks, and so files, that the good rows of one partition are dealt over at most.
_PARTS = 16
_BAD_PARTS = 1024


def _placed(typed: DataFrame, feed: Feed) -> DataFrame:
    """One row per content, those of a partition in few tasks; bad rows have none.

    The partition follows from the content, so copies meet wherever rows are placed by
    partition and a hash of content.  Keys are worked out after the shuffle.
    """
    contract = feed.contract
    place = contract.partition_expr or contract.partition
    kind = contract.stored_columns()[-1][1].simpleString()
    missing = f"raise_error('{contract.table}: {contract.partition} must not be NULL')"
    good = F.col("_reject_reason").isNull()
    part = F.when(good, F.pmod(_content_hash(feed), F.lit(_PARTS))).otherwise(
        F.pmod(F.xxhash64("_raw_row"), F.lit(_BAD_PARTS))
    )
    placed = (
        typed.drop("_bronze_row_key", "_reject_key")
        .withColumn(
            contract.partition,
            F.when(good, F.expr(f"coalesce(CAST({place} AS {kind}), CAST({missing} AS {kind}))")),
        )
        .withColumn("_part", part.cast("int"))
        .repartition(contract.partition, "_part")
    )
    keyed = add_keys(placed, feed).selectExpr(
        "*", "coalesce(_reject_key, _bronze_row_key) AS _row"
    )
    distinct = latest_by(keyed, [contract.partition, "_part", "_row"], recency_order()[:2])
    return distinct.drop("_part", "_row")


def _content_hash(feed: Feed) -> Column:
    """Equal for rows of one fingerprint, from numbers where the feed begins with some.

    Numbers in front of all text stand for themselves in the text that is digested;
    times do not where a clock is set back.
    """
    typed = list(takewhile(lambda c: not isinstance(c.dataType, T.StringType), feed.columns))
    numbers = [c.name for c in typed if isinstance(c.dataType, T.NumericType)]
    return F.xxhash64(*numbers or [content_text(*feed.contract.feed_columns)])

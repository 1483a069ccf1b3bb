"""A ledger of feed files that batch loads and streams share.

A file is known by path, size and time of modification: one that is written anew
is read once more, one that stays is never read again.
"""

from __future__ import annotations

from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.contracts import TableContract
from lakestrata.functions.times import instant
from lakestrata.operators.staging import stage
from lakestrata.plans.bronze import load_feed
from lakestrata.sinks.tables import append_table
from lakestrata.sources.feeds import Feed
from lakestrata.sources.tables import read_table

FILE_KEY = ["feed", "path", "size_bytes", "modified"]


def files_in(spark: SparkSession, feed: Feed, path: str) -> DataFrame:
    """The files below a folder as they are now; their contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select(
        F.lit(feed.name).alias("feed"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size_bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def files_of(rows: DataFrame, feed: Feed) -> DataFrame:
    """The files that rows with lineage and ``_modified`` come from."""
    return rows.select(
        F.lit(feed.name).alias("feed"),
        F.col("_source_path").alias("path"),
        F.col("_source_size_bytes").alias("size_bytes"),
        F.col("_modified").alias("modified"),
    ).distinct()


def unread_files(
    spark: SparkSession, feed: Feed, path: str, ledger: TableContract
) -> DataFrame:
    return files_in(spark, feed, path).join(read_table(spark, ledger), FILE_KEY, "left_anti")


def note_files(
    spark: SparkSession,
    ledger: TableContract,
    files: DataFrame,
    ingest_ts: str | datetime | Column | None = None,
) -> None:
    """Enter files that the ledger does not have as they are."""
    new = files.join(read_table(spark, ledger), FILE_KEY, "left_anti")
    append_table(spark, ledger, new.withColumn("_ingest_ts", instant(ingest_ts)))


def load_new_files(
    spark: SparkSession,
    feed: Feed,
    path: str,
    rejects: TableContract,
    ledger: TableContract,
    on_match: str = "touch",
    ingest_ts: str | datetime | Column | None = None,
    headers: str = "same",
) -> int:
    """Load the files that are new or changed since any earlier call; returns how many.

    They are entered after their rows are stored: a load that dies in between reads
    them again, and adds nothing twice.  The names of new files come to the driver.
    """
    files = stage(unread_files(spark, feed, path, ledger), "files")
    names = [unquote(row["path"]) for row in files.select("path").collect()]
    if names:
        load_feed(spark, feed, sorted(names), rejects, on_match, ingest_ts, headers)
        note_files(spark, ledger, files, ingest_ts)
    return len(names)

"""Incremental file ingest: every file is read once, however often it runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.contracts import TableContract
from lakestrata.operators.staging import stage
from lakestrata.plans.bronze import store_typed
from lakestrata.plans.ledger import FILE_KEY, files_of, note_files
from lakestrata.sources.feeds import (
    CSV_OPTIONS,
    MALFORMED,
    Feed,
    lineage_columns,
    record_columns,
    typed_rows,
)
from lakestrata.sources.tables import read_table, require_table


def ingest_new_files(
    spark: SparkSession,
    feed: Feed,
    path: str,
    rejects: TableContract,
    checkpoint: str,
    max_files: int | None = None,
    ingest_ts: str | datetime | Column | None = None,
    ledger: TableContract | None = None,
) -> None:
    """Load the files that arrived since the last call, then stop.

    The stream's checkpoint remembers the files.  A batch repeated after a
    failure adds nothing twice, because stored rows are kept by fingerprint.
    ``max_files`` bounds one batch for first loads of big folders.  With a ledger,
    files that a batch load has read are left out, and those read here are noted
    in it.
    """
    require_table(spark, feed.contract.table)
    schema, columns = record_columns(feed)
    reader = (
        spark.readStream.schema(schema)
        .options(**CSV_OPTIONS)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("recursiveFileLookup", "true")
        .option("enforceSchema", "false")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    arriving = reader.csv(path).select(
        *columns,
        *[column.alias(name) for name, column in lineage_columns(ingest_ts).items()],
        F.col("_metadata.file_modification_time").alias("_modified"),
    )

    def store(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        if ledger is not None:
            files = stage(files_of(batch, feed), "files")
            known = files.join(read_table(session, ledger), FILE_KEY, "left_semi")
            read = [F.col("_source_path") == known["path"], F.col("_modified") == known["modified"]]
            batch = batch.join(known.select("path", "modified"), read, "left_anti")
        rows = typed_rows(batch, feed)
        store_typed(session, [(feed, rows)], rejects, "keep")
        if ledger is not None:
            note_files(session, ledger, files, ingest_ts)

    query = (
        arriving.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Batches run in a session of their own; this one has to look at files anew.
    for contract in filter(None, (feed.contract, rejects, ledger)):
        spark.catalog.refreshTable(contract.table)

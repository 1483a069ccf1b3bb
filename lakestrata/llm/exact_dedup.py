"""Exact deduplication as a stateful stream.

Texts arrive as a stream of files.  State on disk (RocksDB), keyed by the
digest of the normalised text and never expired, retains the stable identifier
that stays, the content's locator (file and row in it) and the group's size.  A
digest that is known counts as a hit; the bytes of hits are compared in full with
the content that the state points to, and texts that differ in spite of one digest
are told apart by them.  Texts whose digest came up once are not sent anywhere.

The state's updates combine on the sending side, so a text that a third of all
rows hold arrives as one row per task.  ``doc_id`` is a BIGINT.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from lakestrata.llm.bitmaps import MARKS, with_mark
from lakestrata.operators.staging import stage
from lakestrata.session import shared_folder

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": _PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Many small stores: no disk set aside for their logs.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _seen(file: Column, row: Column) -> Column:
    """Identifier and locator; a null id stays only where a group has no other."""
    return F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", file.alias("file"), row.alias("row")
    )


def stage_texts(docs: DataFrame, folder: str) -> str:
    """Write ids, normalised texts and their digests as the source of the stream."""
    path = f"{folder}/texts"
    text = normalised(F.col("text"))
    docs.select(
        "doc_id", text.alias("text"), F.sha2(text, 256).alias("text_sha256")
    ).write.option("compression", "zstd").parquet(path)
    return path


def _rows(
    reader: DataFrameReader | DataStreamReader, source: str, digits: int, record: str | None
) -> DataFrame:
    """doc_id, text, text_sha256, digest and place of each row of a source.

    ``record`` names the struct that holds a source's doc_id and text.  Files that
    bring no digest get it from their text.
    """
    schema = "doc_id bigint, text string"
    if record is not None:
        schema = f"{record} struct<doc_id: bigint, text: string>"
    rows = reader.schema(f"{schema}, text_sha256 string").parquet(source)
    prefix = "" if record is None else f"{record}."
    text = normalised(F.col(f"{prefix}text"))
    sha = F.coalesce("text_sha256", F.sha2(text, 256))
    return rows.select(
        F.col(f"{prefix}doc_id").alias("doc_id"),
        text.alias("text"),
        sha.alias("text_sha256"),
        F.substring(sha, 1, digits).alias("digest"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def update_state(
    spark: SparkSession,
    source: str,
    folder: str,
    digits: int = 64,
    files: int = 100_000,
    record: str | None = None,
) -> None:
    """Bring the keyed state up to the files in ``source``; then it stops.

    A later call with the same ``folder`` takes up new files only.  ``files`` is
    the most that one batch reads; the state is the same for any value.
    """
    before = {key: spark.conf.get(key, None) for key in _SETTINGS}
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    try:
        reader = spark.readStream.option("maxFilesPerTrigger", files)
        rows = _rows(reader, source, digits, record)
        state = (
            rows.select("digest", _seen(F.col("file"), F.col("row")).alias("seen"))
            .groupBy("digest")
            .agg(F.min("seen").alias("first"), F.count("*").alias("size"))
        )

        def keep(batch: DataFrame, number: int) -> None:
            # Named by its number, so that a repeated batch replaces itself.
            batch.write.mode("overwrite").parquet(f"{folder}/updates/batch={number}")

        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", f"{folder}/state")
            .trigger(availableNow=True)
            .foreachBatch(keep)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def state_now(spark: SparkSession, folder: str) -> DataFrame:
    """digest, first (struct of id and locator) and size, one row per key."""
    schema = (
        "digest string, first struct<unnamed:boolean, doc_id:bigint, file:string, row:bigint>, "
        "size bigint, batch int"
    )
    updates = spark.read.schema(schema).parquet(f"{folder}/updates")
    return updates.groupBy("digest").agg(
        F.min("first").alias("first"), F.max("size").alias("size")
    )


def deduplicate(docs: DataFrame, digits: int = 64, files: int = 100_000) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the smallest doc_id stays; null texts are empty
    texts.  Where the smallest id is repeated, one of its rows is kept.  A null
    id comes last; in a group of null ids one row is kept and keep_id is null.
    Other columns are not read.  ``digits`` of the digest key the state; fewer
    than all make clashes, which the full comparison resolves.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/exact-dedup/{uuid4().hex}"
    source = stage_texts(docs, folder)
    update_state(spark, source, folder, digits, files)
    return resolve(spark, source, folder, digits)


def resolve(spark: SparkSession, source: str, folder: str, digits: int = 64) -> DataFrame:
    """What ``deduplicate`` returns, for the state in ``folder``."""
    return _resolved(spark, source, folder, digits).drop("file", "row")


def _number() -> Column:
    return F.conv(F.substring("digest", 1, 7), 16, 10).cast("long") % MARKS


def marked(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Rows whose digest may be one of ``hits``, filtered by a bitmap where they are read."""
    numbers = hits.select(_number().alias("number"))
    return with_mark(rows, _number(), numbers, "_hit").where("_hit").drop("_hit")


def clashing(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Digests whose rows differ in bytes from the content the state points to.

    Only rows that may be hits are read on; what the filter lets pass besides, the
    join with the state takes out.  Copies combine by their bytes before they are sent.
    """
    hits = state.where("size > 1").select("digest", "first")
    contents = marked(rows, hits).groupBy("digest", "text").agg(
        F.min(_seen(F.col("file"), F.col("row"))).alias("at")
    )
    contents = stage(contents.join(hits, "digest"), "exact-dedup-contents")
    same_place = (F.col("at.file") == F.col("first.file")) & (F.col("at.row") == F.col("first.row"))
    pointed = contents.where(same_place).select("digest", F.col("text").alias("known"))
    # Also a digest whose locator leads to none of its rows is told apart by bytes.
    checked = contents.join(pointed, "digest", "left")
    return checked.where("known IS NULL OR text <> known").select("digest").distinct()


def _resolved(
    spark: SparkSession, source: str, folder: str, digits: int, record: str | None = None
) -> DataFrame:
    """Join the state back to the rows, and check the bytes of hits."""
    rows = _rows(spark.read, source, digits, record)
    # Read from files, the state is dealt out for the join alone, so that Spark can
    # split the partition of a digest that many rows have.
    state = stage(state_now(spark, folder), "exact-dedup-state")
    clashes = stage(clashing(rows, state), "exact-dedup-clashes")
    sound = rows.drop("text").join(state, "digest")
    sound = sound.join(clashes, "digest", "left_anti")
    clashed = rows.join(clashes, "digest", "left_semi")
    apart = clashed.groupBy("digest", "text").agg(
        F.min(_seen(F.col("file"), F.col("row"))).alias("first"), F.count("*").alias("size")
    )
    clashed = clashed.join(apart, ["digest", "text"])
    columns = (
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (
            (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))
        ).alias("kept"),
        "text_sha256",
        "file",
        "row",
    )
    return sound.select(*columns).unionByName(clashed.select(*columns))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all columns of ``docs``.

    Rows are told apart by a number of their own, so repeated ids do no harm.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/exact-dedup/{uuid4().hex}"
    source = f"{folder}/docs"
    # The user's columns stay in one struct, apart from those made here.
    sha = F.sha2(normalised(F.col("text")), 256).alias("text_sha256")
    packed = docs.select(F.struct("*").alias("doc"), sha)
    packed.write.option("compression", "zstd").parquet(source)
    update_state(spark, source, folder, record="doc")
    kept = _resolved(spark, source, folder, 64, record="doc").where("kept")
    stored = spark.read.schema(packed.schema).parquet(source)
    placed = stored.select(
        "doc", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    return placed.join(kept.select("file", "row"), ["file", "row"], "left_semi").select("doc.*")

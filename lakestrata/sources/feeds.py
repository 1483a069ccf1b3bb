"""CSV feeds: text in, typed and fingerprinted rows out, bad rows set aside."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.contracts import TableContract, build_contracts
from lakestrata.functions.conversion import try_convert
from lakestrata.functions.keys import fingerprint
from lakestrata.functions.times import instant

# The same options on the reading and the writing side, so that quotes and
# outer blanks of a value survive the round trip.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# A record that does not fit its header, and what is wrong with it.
MALFORMED, PROBLEM = "_malformed", "_record_problem"

_LINEAGE = ["_ingest_ts", "_source_path", "_source_name", "_source_size_bytes"]


@dataclass(frozen=True)
class Feed:
    """A feed and the bronze table it fills."""

    contract: TableContract
    business_key: str

    @property
    def name(self) -> str:
        return self.contract.name

    @property
    def columns(self) -> list[T.StructField]:
        return [self.contract.columns[c] for c in self.contract.feed_columns]

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, T.StringType()) for f in self.columns]
        )


def feeds(contracts: dict[str, TableContract] | None = None) -> dict[str, Feed]:
    contracts = contracts or build_contracts()
    return {
        "customers": Feed(contracts["bronze.customers"], "customer_id"),
        "products": Feed(contracts["bronze.products"], "product_id"),
        "transactions": Feed(contracts["bronze.transactions"], "transaction_id"),
    }


def record_columns(feed: Feed) -> tuple[T.StructType, list[Column]]:
    """Schema and columns of records whose cells are in the feed's own order."""
    schema = T.StructType([*feed.text_schema.fields, T.StructField(MALFORMED, T.StringType())])
    problem = _record_problem(len(feed.columns)).alias(PROBLEM)
    return schema, [*map(F.col, schema.names), problem]


def lineage_columns(ingest_ts: str | datetime | Column | None = None) -> dict[str, Column]:
    return {
        "_ingest_ts": instant(ingest_ts),
        "_source_path": F.col("_metadata.file_path"),
        "_source_name": F.col("_metadata.file_name"),
        "_source_size_bytes": F.col("_metadata.file_size"),
    }


def read_feed(
    spark: SparkSession,
    feed: Feed,
    path: str | list[str],
    ingest_ts: str | datetime | Column | None = None,
    headers: str = "same",
) -> DataFrame:
    """All cells of a feed folder, or of listed files, as text, with lineage.

    Columns are found by their header name; columns the feed does not know are left
    out.  With ``headers="same"`` files whose headers differ from each other fail
    instead of shifting cells.  With ``"any"`` every file has its own order of
    columns; the headers are looked up first, by a pass over the lines.  A record of
    fewer or more cells than its header keeps its text in ``_malformed``.
    """
    if headers not in ("same", "any"):
        raise ValueError(f"headers must be 'same' or 'any', not {headers!r}")
    if headers == "any":
        groups = _files_by_header(spark, feed, path)
    else:
        groups = [(_csv_reader(spark).csv(path).columns, path)]
    parts = []
    for names, files in groups:
        missing = [f.name for f in feed.columns if f.name not in names]
        if missing:
            raise ValueError(f"feed {feed.name}: no column {', '.join(missing)} in {path}")
        text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])
        raw = (
            _csv_reader(spark)
            .schema(text)
            .option("columnNameOfCorruptRecord", MALFORMED)
            .option("columnPruning", "false")  # else cells of columns left out are not counted
            .csv(files)
        )
        parts.append(
            raw.select(
                *[F.col(f.name) for f in feed.columns],
                _record_problem(len(names)).alias(PROBLEM),
                MALFORMED,
                *[column.alias(name) for name, column in lineage_columns(ingest_ts).items()],
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _csv_reader(spark: SparkSession) -> DataFrameReader:
    return (
        spark.read.options(**CSV_OPTIONS)
        .option("recursiveFileLookup", "true")
        .option("enforceSchema", "false")
    )


def _record_problem(cells: int) -> Column:
    """Why a record does not fit its header, from its text outside of quotes; else NULL."""
    bare = f"""regexp_replace({MALFORMED}, '"([^"]|"")*"', '')"""
    found = f"length({bare}) - length(replace({bare}, ',', '')) + 1"
    return F.expr(
        f"CASE WHEN {MALFORMED} IS NULL THEN NULL WHEN {found} < {cells} THEN 'short_record' "
        f"WHEN {found} > {cells} THEN 'long_record' ELSE 'malformed_record' END"
    )


def _files_by_header(
    spark: SparkSession, feed: Feed, path: str | list[str]
) -> list[tuple[list[str], list[str]]]:
    """(column names, files that have them in this order).

    A header is a line that names all columns of the feed.  One row for each file
    comes to the driver: metadata, not data.
    """
    names = F.transform(F.split("value", ","), lambda name: F.trim(F.btrim(name, F.lit('"'))))
    known = [F.array_contains("names", f.name) for f in feed.columns]
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    found = (
        lines.filter(F.col("value").contains(feed.columns[0].name))
        .select(F.col("_metadata.file_path").alias("file"), names.alias("names"))
        .filter(reduce(Column.__and__, known))
        .groupBy("file")
        .agg(F.min("names").alias("names"), F.max("names").alias("other"))
        .collect()
    )
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in found:
        if row["names"] != row["other"]:
            raise ValueError(f"feed {feed.name}: two headers in {row['file']}")
        groups.setdefault(tuple(row["names"]), []).append(unquote(row["file"]))
    if not groups:
        raise ValueError(f"feed {feed.name}: no file with its columns in {path}")
    return [(list(names), sorted(files)) for names, files in sorted(groups.items())]


def typed_rows(raw: DataFrame, feed: Feed) -> DataFrame:
    """Typed cells, the fingerprint, and ``_reject_reason`` (NULL for good rows).

    A record of too few or too many cells is rejected as a whole.  A cell that does
    not read as its type, or a required cell that is absent, rejects its row with the
    name of the first such column; the load goes on.  The text is kept for rejected
    rows only.
    """
    names = [c.name for c in feed.columns]
    reasons = [f"WHEN {PROBLEM} IS NOT NULL THEN {PROBLEM}"]
    for column in feed.columns:
        name = column.name
        if not isinstance(column.dataType, T.StringType):
            reasons.append(
                f"WHEN {name} IS NULL AND trim(_text.{name}) <> '' THEN 'cast_failed:{name}'"
            )
        if not column.nullable:
            reasons.append(f"WHEN {name} IS NULL THEN 'required_null:{name}'")
    # One projection per step, so that no cell is converted more than once.
    cells = raw.selectExpr(
        *[f"{try_convert(c.name, c.dataType)} AS {c.name}" for c in feed.columns],
        *_LINEAGE,
        f"struct({', '.join(names)}) AS _text",
        PROBLEM,
        MALFORMED,
    )
    judged = cells.selectExpr(
        *names,
        *_LINEAGE,
        f"CASE {' '.join(reasons)} END AS _reject_reason",
        "_text",
        MALFORMED,
    )
    kept_text = judged.selectExpr(
        *names,
        *_LINEAGE,
        "_reject_reason",
        f"IF(_reject_reason IS NULL, NULL, coalesce({MALFORMED}, to_json(_text))) AS _raw_row",
        f"IF(_reject_reason IS NULL, NULL, _text.{feed.business_key}) AS _raw_key",
    )
    return add_keys(kept_text, feed)


def add_keys(rows: DataFrame, feed: Feed) -> DataFrame:
    """The fingerprint, and ``_reject_key`` of rejected rows.

    A rejected row is known by its text: typed cells are NULL where it is bad.
    """
    return add_fingerprint(rows, feed).withColumn(
        "_reject_key",
        F.when(F.expr("_reject_reason IS NOT NULL"), fingerprint(f"'{feed.name}'", "_raw_row")),
    )


def add_fingerprint(rows: DataFrame, feed: Feed) -> DataFrame:
    return rows.withColumn("_bronze_row_key", fingerprint(*feed.contract.feed_columns))


def valid_rows(typed: DataFrame, feed: Feed) -> DataFrame:
    return typed.filter("_reject_reason IS NULL").select(*feed.contract.names)


def reject_rows(typed: DataFrame, feed: Feed) -> DataFrame:
    """Rejected rows in the shape of the reject table, text included.

    The key holds no path or time, so loading a folder again adds no rejects.
    """
    return typed.filter("_reject_reason IS NOT NULL").select(
        F.lit(feed.name).alias("feed"),
        F.col("_raw_key").alias("business_key"),
        F.col("_reject_reason").alias("reason"),
        F.col("_raw_row").alias("raw_row"),
        "_source_path",
        "_ingest_ts",
        "_reject_key",
    )

"""Table contracts: columns, keys, required columns and storage layout.

A contract is the one description of a table.  ``ensure_tables`` creates the
tables from it and ``conform`` brings any DataFrame into its shape on the way
to a write.  Parquet tables drop NOT NULL, so the check is part of ``conform``.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BRONZE, SILVER, GOLD, META = "bronze", "silver", "gold", "meta"

LAYER_COMMENTS = {
    BRONZE: "Raw feed rows with lineage and a content fingerprint",
    SILVER: "Cleaned dimensions, fact table and quarantine",
    GOLD: "Reporting aggregates, one row per business key",
    META: "Run log of the layers",
}


@dataclass(frozen=True)
class TableContract:
    """One table.

    ``partition`` names the partition column.  With ``partition_expr`` it is a
    storage-only column derived from the row (readers never see it), otherwise
    it is one of the table's own columns.  ``refresh`` says how the table
    changes: "replace" rewrites it whole, "merge" updates rows by ``keys``,
    "append" only grows.
    """

    layer: str
    name: str
    columns: T.StructType
    keys: tuple[str, ...] = ()
    refresh: str = "replace"
    comment: str = ""
    partition: str | None = None
    partition_expr: str | None = None
    feed_columns: tuple[str, ...] = field(default=())
    prefix: str = ""

    @property
    def schema(self) -> str:
        return f"{self.prefix}{self.layer}"

    @property
    def table(self) -> str:
        return f"{self.schema}.{self.name}"

    @property
    def names(self) -> list[str]:
        return self.columns.names

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.columns.fields if not f.nullable]

    def stored_columns(self) -> list[tuple[str, T.DataType, bool]]:
        """Columns in storage order: the partition column comes last."""
        stored = [(f.name, f.dataType, f.nullable) for f in self.columns.fields]
        if self.partition_expr:
            stored.append((self.partition, T.DateType(), False))
        elif self.partition:
            stored.sort(key=lambda column: column[0] == self.partition)
        return stored


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "money": T.DecimalType(38, 10),
}


def _columns(text: str) -> T.StructType:
    """``"id int!, name string"`` to a StructType; ``!`` marks NOT NULL."""
    columns = T.StructType()
    for item in text.split(","):
        name, kind = item.split()
        columns.add(name, _TYPES[kind.rstrip("!")], not kind.endswith("!"))
    return columns


_LINEAGE = (
    "_ingest_ts timestamp!, _source_path string!, _source_name string, "
    "_source_size_bytes bigint, _bronze_row_key string!"
)


def build_contracts(id_type: str = "int", prefix: str = "") -> dict[str, TableContract]:
    """All tables by ``layer.name``; ``prefix`` goes before the schema names.

    Business ids are INT by default.  ``id_type="bigint"`` widens them for
    feeds with more than two billion keys; fingerprints do not change, because
    they hash the text of a value.
    """
    customer_feed = (
        f"customer_id {id_type}!, first_name string, last_name string, email string, "
        "city string, state string, signup_date date, loyalty_tier string"
    )
    product_feed = (
        f"product_id {id_type}!, product_name string, category string, brand string, "
        "price double, created_date date"
    )
    transaction_feed = (
        f"transaction_id {id_type}!, customer_id {id_type}, product_id {id_type}!, "
        "quantity int!, transaction_amount double!, transaction_timestamp timestamp!, "
        "channel string!"
    )
    validity = (
        "as_of_ingest_ts timestamp, row_hash string, valid_from timestamp, "
        "valid_to timestamp, is_current boolean"
    )

    def bronze(name: str, feed: str, **layout: str) -> TableContract:
        return TableContract(
            BRONZE,
            name,
            _columns(f"{feed}, {_LINEAGE}"),
            keys=("_bronze_row_key",),
            refresh="merge",
            comment=f"{name} feed, one row per distinct content",
            feed_columns=tuple(_columns(feed).names),
            **layout,
        )

    contracts = [
        bronze("customers", customer_feed),
        bronze("products", product_feed),
        # The month follows from the content, so it follows from the key too:
        # a load touches only the months it brings rows for.
        bronze(
            "transactions",
            transaction_feed,
            partition="_event_month",
            partition_expr="CAST(trunc(transaction_timestamp, 'MM') AS DATE)",
        ),
        TableContract(
            BRONZE,
            "feed_rejects",
            _columns(
                "feed string!, business_key string, reason string!, "
                "raw_row string, _source_path string!, _ingest_ts timestamp!, "
                "_reject_key string!"
            ),
            keys=("_reject_key",),
            refresh="merge",
            comment="Feed rows that could not be typed",
        ),
        TableContract(
            SILVER,
            "dim_customer",
            _columns(
                f"customer_sk bigint!, customer_id {id_type}!, first_name string, "
                "last_name string, customer_name string, email string, "
                "email_raw string, city string, city_raw string, state string, "
                f"signup_date date, loyalty_tier string, {validity}"
            ),
            keys=("customer_sk",),
            comment="Customers; history by row_hash and validity",
        ),
        TableContract(
            SILVER,
            "dim_product",
            _columns(
                f"product_sk bigint!, product_id {id_type}!, product_name string, "
                "category string, brand string, price double, created_date date, "
                f"{validity}"
            ),
            keys=("product_sk",),
            comment="Products; history by row_hash and validity",
        ),
        TableContract(
            SILVER,
            "quarantine_rows",
            _columns(
                "quarantined_at timestamp, source_layer string, entity string, "
                "business_key string, reason string"
            ),
            comment="Audit of rows with defects",
        ),
        TableContract(
            SILVER,
            "fact_transaction",
            _columns(
                f"transaction_id {id_type}!, customer_sk bigint, product_sk bigint!, "
                "order_date date!, transaction_timestamp timestamp!, "
                "transaction_amount double!, quantity int!, channel string!, "
                "is_anonymous_or_unlinked boolean!"
            ),
            keys=("transaction_id",),
            comment="One row per transaction",
            partition="_order_month",
            partition_expr="CAST(trunc(order_date, 'MM') AS DATE)",
        ),
        TableContract(
            GOLD,
            "daily_revenue",
            _columns(
                "transaction_date date!, total_revenue double!, "
                "average_order_value double!, total_orders bigint!"
            ),
            keys=("transaction_date",),
            refresh="merge",
            comment="One row per calendar day",
        ),
        TableContract(
            GOLD,
            "customer_spend_by_month",
            _columns(
                f"month date!, customer_id {id_type}!, customer_name string!, "
                "total_spend double!, transaction_count bigint!, rank_by_spend int!"
            ),
            keys=("month", "customer_id"),
            refresh="merge",
            comment="Customer spend per month with rank in the month",
            partition="month",
        ),
        TableContract(
            GOLD,
            "category_sales_daily",
            _columns(
                "transaction_date date!, category string!, total_revenue double!"
            ),
            keys=("transaction_date", "category"),
            refresh="merge",
            comment="Revenue per category and day",
        ),
        TableContract(
            META,
            "layer_run_state",
            _columns(
                "layer string!, last_event_ts timestamp!, run_id string, "
                "run_notes string"
            ),
            refresh="append",
            comment="Last successful run per layer, with the data time it reached",
        ),
    ]
    return {
        f"{contract.layer}.{contract.name}": replace(contract, prefix=prefix)
        for contract in contracts
    }


def ledger_contract(prefix: str = "") -> TableContract:
    """The table of feed files that have been read."""
    return TableContract(
        META,
        "file_ledger",
        _columns(
            "feed string!, path string!, size_bytes bigint!, modified timestamp!, "
            "_ingest_ts timestamp!"
        ),
        refresh="append",
        comment="Feed files read, as they were then",
        prefix=prefix,
    )


def audit_contract(prefix: str = "") -> TableContract:
    """The quarantine over several runs, one row for each finding."""
    return TableContract(
        SILVER,
        "quarantine_audit",
        _columns(
            "entity string!, business_key string!, reason string!, source_layer string, "
            "n_rows bigint!, first_run string!, first_seen_at timestamp!, last_run string!, "
            "last_seen_at timestamp!, resolved_run string, resolved_at timestamp, "
            "times_opened int!"
        ),
        keys=("entity", "business_key", "reason"),
        comment="Findings with the runs that saw and resolved them",
        prefix=prefix,
    )


def change_contract(contract: TableContract) -> TableContract:
    """The table that holds the row images of every commit to ``contract``'s table."""
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in contract.columns.fields])
    columns.add("_change_type", T.StringType(), False)
    columns.add("_commit_ts", T.TimestampType(), False)
    columns.add("_commit", T.LongType(), False)
    return TableContract(
        contract.layer,
        f"{contract.name}_changes",
        columns,
        refresh="append",
        comment=f"Row images of the commits to {contract.name}",
        partition="_commit",
        prefix=contract.prefix,
    )


def incremental_contracts(id_type: str = "int", prefix: str = "") -> dict[str, TableContract]:
    """All tables of runs that recompute only what new rows touch.

    Dimensions and fact keep their changes; the fact's months are switched one by
    one; every mart has a state of sums and counts that changes add to.
    """
    contracts = build_contracts(id_type, prefix)
    fact = "silver.fact_transaction"
    contracts[fact] = replace(contracts[fact], refresh="merge")
    for name in ("silver.dim_customer", "silver.dim_product", fact):
        contracts[f"{name}_changes"] = change_contract(contracts[name])
    for name in ("daily_revenue", "customer_spend_by_month", "category_sales_daily"):
        mart = contracts[f"gold.{name}"]
        columns = T.StructType([mart.columns[key] for key in mart.keys])
        for column in _columns("amount money!, unsound bigint!, n_rows bigint!, _applied bigint!"):
            columns.add(column)
        contracts[f"gold.{name}_state"] = replace(
            mart, name=f"{name}_state", columns=columns, comment=f"Sums and counts of {name}"
        )
    return contracts


def conform(df: DataFrame, contract: TableContract, stored: bool = False) -> DataFrame:
    """Select, order and cast to the contract; a NULL in a required column fails.

    The check is one expression in the projection that feeds the write, so it
    costs no pass of its own.  ``stored=True`` adds the storage-only partition
    column and the storage order.
    """
    if stored and contract.partition_expr:
        df = df.withColumn(contract.partition, F.expr(contract.partition_expr))
    kinds = (
        contract.stored_columns()
        if stored
        else [(f.name, f.dataType, f.nullable) for f in contract.columns.fields]
    )
    projected = []
    for name, data_type, nullable in kinds:
        kind = data_type.simpleString()
        cell = f"CAST({name} AS {kind})"
        if not nullable:
            cell = _not_null(cell, kind, f"{contract.table}: {name}")
        projected.append(f"{cell} AS {name}")
    return df.selectExpr(*projected)


def _not_null(cell: str, kind: str, what: str) -> str:
    return f"coalesce({cell}, CAST(raise_error('{what} must not be NULL') AS {kind}))"


def assert_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail the job on the first NULL in ``columns``; other columns pass through."""
    return df.selectExpr(
        *[
            f"{_not_null(f.name, f.dataType.simpleString(), f.name)} AS {f.name}"
            if f.name in columns
            else f.name
            for f in df.schema.fields
        ]
    )


def create_statement(contract: TableContract) -> str:
    columns = ", ".join(
        f"`{name}` {data_type.simpleString()}{'' if nullable else ' NOT NULL'}"
        for name, data_type, nullable in contract.stored_columns()
    )
    partitioned = f" PARTITIONED BY (`{contract.partition}`)" if contract.partition else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {contract.table} ({columns}) "
        f"USING parquet OPTIONS (compression 'zstd'){partitioned} COMMENT '{contract.comment}'"
    )


def ensure_schemas(
    spark: SparkSession, prefix: str = "", location: str | None = None
) -> None:
    """Create the layer schemas, in the warehouse or below a given folder."""
    for layer, comment in LAYER_COMMENTS.items():
        schema = f"{prefix}{layer}"
        place = f" LOCATION '{location}/{schema}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} COMMENT '{comment}'{place}")


def ensure_tables(
    spark: SparkSession,
    contracts: dict[str, TableContract] | None = None,
    location: str | None = None,
) -> None:
    """Create the schemas and all missing tables.

    A partitioned table that is replaced whole finds its partitions by listing
    its folder, so one location switch swaps all of them at once.  A merged one
    keeps its partitions in the catalog, where each can be switched alone.
    """
    contracts = contracts or build_contracts()
    for prefix in {contract.prefix for contract in contracts.values()}:
        ensure_schemas(spark, prefix, location)
    setting = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(setting)
    try:
        for contract in contracts.values():
            by_listing = contract.partition and contract.refresh == "replace"
            spark.conf.set(setting, "false" if by_listing else "true")
            spark.sql(create_statement(contract))
    finally:
        spark.conf.set(setting, before)


def use_catalog(spark: SparkSession, catalog: str | None = None, schema: str | None = None) -> None:
    """Make a catalog and schema current for two-part and one-part names."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    if schema:
        spark.catalog.setCurrentDatabase(schema)

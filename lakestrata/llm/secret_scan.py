"""Secret scans over an incremental blob ledger.

Every text is a blob named by its SHA-256.  The ledger holds the pairs of blob
and rule version that were scanned and what was found in them.  A scan works on
unseen pairs only, each distinct blob once, and joins findings back to all rows
that hold the blob.  Everything is built-in functions: a rule's pattern cuts the
text, and the lengths of cuts and matches give the places in code points.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakestrata.operators.staging import stage
from lakestrata.session import shared_folder

LEDGER_SCHEMA = (
    "blob string, kind string, version int, "
    "spans array<struct<start_at int, end_at int>>"
)


@dataclass(frozen=True)
class Rule:
    """All matches count whose ``value`` group has ``least`` characters.

    ``pattern`` is matched leftmost and non-overlapping, and never matches the
    empty text.  ``hint`` is a pattern without which nothing can match.
    A changed rule needs a new ``version``.
    """

    kind: str
    version: int
    pattern: str
    value: int
    least: int
    hint: str


# Fixed values of the base rules, in the order that sorts equal places.
RULES = (
    Rule(
        "assign",
        1,
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+)",
        2,
        12,
        r"(?i:passw|secret|token|api_?key)",
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, "AKIA[A-Z0-9]{14}"),
    Rule("hex", 1, r"[0-9a-f]+", 0, 16, "[0-9a-f]{16}"),
)


def found_spans(text: Column, rule: Rule) -> Column:
    """Places of a rule's matches, by start; an empty array where there are none."""
    pattern = F.lit(rule.pattern)
    pieces = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    value = whole if rule.value == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.value))
    steps = F.arrays_zip(
        pieces.alias("gap"),
        F.transform(whole, F.length).alias("size"),
        F.transform(value, F.length).alias("value"),
    )
    walked = F.transform(F.array(steps), lambda all_steps: _walked(all_steps, rule.least))[0]
    none = F.array().cast("array<struct<start_at:int,end_at:int>>")
    return F.when(text.rlike(rule.hint), walked).otherwise(none)


def _walked(steps: Column, least: int) -> Column:
    """Spans of the steps that hold ``least`` characters.

    An array that grows by one is copied each time.  So steps are walked in blocks of
    about the root of their number, from nothing each, and then moved to their places.
    """
    spans = "array<struct<start_at:int,end_at:int>>"
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(steps))).cast("int"))
    firsts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(steps)), block)

    def one(first: Column) -> Column:
        return F.aggregate(
            F.slice(steps, first, block),
            F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("spans")),
            lambda state, step: F.struct(
                (state["at"] + step["gap"] + F.coalesce(step["size"], F.lit(0))).alias("at"),
                F.when(
                    step["value"] >= least,
                    F.concat(
                        state["spans"],
                        F.array(
                            F.struct(
                                (state["at"] + step["gap"]).alias("start_at"),
                                (state["at"] + step["gap"] + step["size"]).alias("end_at"),
                            )
                        ),
                    ),
                )
                .otherwise(state["spans"])
                .alias("spans"),
            ),
        )

    def joined(blocks: Column) -> Column:
        places = F.aggregate(
            blocks,
            F.array(F.lit(0)),
            lambda ends, done: F.concat(ends, F.array(F.element_at(ends, -1) + done["at"])),
        )

        def moved(done: Column, number: Column, at: Column) -> Column:
            return F.transform(
                done["spans"],
                lambda span: F.struct(
                    (span["start_at"] + F.get(at, number)).alias("start_at"),
                    (span["end_at"] + F.get(at, number)).alias("end_at"),
                ),
            )

        # An array of one element names a value that is needed many times.
        return F.transform(
            F.array(places),
            lambda at: F.flatten(F.transform(blocks, lambda done, number: moved(done, number, at))),
        )[0]

    return F.transform(F.array(F.transform(firsts, one)), joined)[0]


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def scan_unseen(
    docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """New ledger rows: those of ``docs``' blobs and ``rules`` the ledger lacks.

    ``docs`` needs a ``text``; each distinct text is scanned once however many
    rows hold it.  Blobs without findings get rows too, so that they count as
    seen.  The ledger's findings are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    blobs = docs.select(F.sha2(text, 256).alias("blob"), text.alias("text"))
    first = W.partitionBy("blob").orderBy("blob")
    blobs = blobs.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    if ledger is not None:
        wanted = [F.struct(F.lit(r.kind).alias("k"), F.lit(r.version).alias("v")) for r in rules]
        seen = ledger.groupBy("blob").agg(
            F.collect_set(F.struct(F.col("kind").alias("k"), F.col("version").alias("v"))).alias(
                "seen"
            )
        )
        blobs = blobs.join(seen, "blob", "left").withColumn(
            "todo", F.array_except(F.array(*wanted), F.coalesce("seen", F.array().cast(seen.schema["seen"].dataType)))
        )
    else:
        blobs = blobs.withColumn("todo", F.lit(None).cast("array<struct<k:string,v:int>>"))

    def due(rule: Rule) -> Column:
        key = F.struct(F.lit(rule.kind).alias("k"), F.lit(rule.version).alias("v"))
        return F.col("todo").isNull() | F.array_contains("todo", key)

    scans = F.array(
        *(
            F.when(
                due(rule),
                F.struct(
                    F.lit(rule.kind).alias("kind"),
                    F.lit(rule.version).alias("version"),
                    found_spans(F.col("text"), rule).alias("spans"),
                ),
            )
            for rule in rules
        )
    )
    return blobs.select("blob", F.explode(F.array_compact(scans)).alias("scan")).select(
        "blob", "scan.*"
    )


def join_back(
    docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Findings of the current rules for each row of ``docs``.

    One row per row: doc_id, a count ``n_<kind>`` for each rule, ``base_sha256``
    and ``spans`` (kind:start:end by start, then in the order of ``rules``).
    Null texts are empty; repeated rows and null ids stay rows of their own.
    """
    current = None
    for rule in rules:
        one = (F.col("kind") == rule.kind) & (F.col("version") == rule.version)
        current = one if current is None else current | one
    place = F.create_map(*(x for n, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(n))))
    spans = F.transform(
        "spans",
        lambda s: F.struct(
            s["start_at"].alias("start_at"),
            place[F.col("kind")].alias("place"),
            s["end_at"].alias("end_at"),
            F.col("kind").alias("kind"),
        ),
    )
    found = (
        ledger.where(current & (F.size("spans") > 0))
        .select("blob", "kind", spans.alias("spans"))
        .groupBy("blob")  # a row for each rule at most
        .agg(
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("all"),
            *(
                F.sum(F.when(F.col("kind") == r.kind, F.size("spans")).otherwise(0)).alias(
                    f"n_{r.kind}"
                )
                for r in rules
            ),
        )
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    # Read from files, the findings are dealt out for the join alone, so that Spark
    # can split the partition of a blob that many rows hold.
    found = stage(found, "secret-findings")
    joined = docs.select("doc_id", F.sha2(text, 256).alias("blob")).join(found, "blob", "left")
    listed = F.coalesce(
        F.array_join(
            F.transform(
                "all",
                lambda s: F.concat_ws(
                    ":", s["kind"], s["start_at"].cast("string"), s["end_at"].cast("string")
                ),
            ),
            ",",
        ),
        F.lit(""),
    )
    return joined.select(
        "doc_id",
        *(F.coalesce(F.col(f"n_{r.kind}"), F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in rules),
        F.sha2(listed, 256).alias("base_sha256"),
        listed.alias("spans"),
    )


def find_secrets(
    docs: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Scan what the ledger at ``ledger_path`` has not seen, add it, and join back.

    Without a path the ledger is a new one in the shared folder.  A job that
    dies leaves the ledger without its rows; the next scan repeats them.
    """
    spark = docs.sparkSession
    if ledger_path is None:
        ledger_path = f"{shared_folder(spark)}/ledgers/secrets-{uuid4().hex}"
        empty_ledger(spark).write.parquet(ledger_path)
    ledger = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
    stage_first = stage(scan_unseen(docs, ledger, rules), "secret-scan")
    stage_first.write.mode("append").parquet(ledger_path)
    return join_back(docs, spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path), rules)

"""Findings over several runs: when each was first and last seen, and when resolved."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.times import instant

AUDIT_KEYS = ("entity", "business_key", "reason")


def audit_after(
    audit: DataFrame, found: DataFrame, run_id: str, at: str | datetime | Column
) -> DataFrame:
    """The audit after a run that found the rows ``found``, all that are there now.

    One row per entity, key and reason (an absent key is an empty one).  A finding
    that comes again keeps its first run; one that is gone is resolved by this run;
    one that comes back is opened once more.  The same run applied twice changes
    nothing.  Findings meet as partial counts, so one found very often is no single
    task.
    """
    now = found.groupBy(
        "entity", F.coalesce("business_key", F.lit("")).alias("business_key"), "reason"
    ).agg(F.max("source_layer").alias("_layer"), F.count("*").alias("_rows"))
    seen, was_open = F.col("_rows").isNotNull(), F.col("resolved_run").isNull()
    known = F.col("first_run").isNotNull()
    joined = audit.join(now, list(AUDIT_KEYS), "full_outer")
    goes = known & ~seen & was_open
    comes_back = known & seen & ~was_open

    def pick(name: str, when: Column, value: Column) -> Column:
        return F.when(when, value).otherwise(F.col(name)).alias(name)

    run, moment = F.lit(run_id), instant(at)
    again = seen & (~known | (F.col("last_run") != run) | comes_back)
    return joined.select(
        *AUDIT_KEYS,
        F.coalesce("_layer", "source_layer").alias("source_layer"),
        F.coalesce("_rows", "n_rows").alias("n_rows"),
        pick("first_run", ~known, run),
        pick("first_seen_at", ~known, moment),
        pick("last_run", seen, run),
        pick("last_seen_at", again, moment),
        F.when(seen, F.lit(None)).when(goes, run).otherwise(F.col("resolved_run")).alias("resolved_run"),
        F.when(seen, F.lit(None)).when(goes, moment).otherwise(F.col("resolved_at")).alias("resolved_at"),
        F.when(~known, 1)
        .when(comes_back, F.col("times_opened") + 1)
        .otherwise(F.col("times_opened"))
        .alias("times_opened"),
    )

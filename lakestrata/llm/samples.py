"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % modulus


def is_remainder(doc_id: str, modulus: int, value: int) -> Column:
    """Whether the remainder is ``value``; false for a null id."""
    return F.coalesce(id_remainder(doc_id, modulus) == value, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, chars: int, seed: int = 7
) -> list[tuple[str, object]]:
    """(text, label) of at most ``per_class`` documents of each label.

    Documents are chosen by a hash of their id.  Of a text longer than ``chars``
    a passage of that length is taken, at a place the hash gives; the model
    fitted on it is applied to whole texts.  Ids without document or label, null
    ids and null labels give no example; an id with two labels has the larger.
    """
    order = F.xxhash64(F.col("doc_id"), F.lit(seed))
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias("_label"))
        .withColumn("_order", order)
    )
    # Hashes are spread evenly: below this share of their range lie per_class of a
    # label's ids, and six deviations more, so few rows are left to be numbered.
    enough = per_class + 6 * per_class**0.5 + 20
    sizes = known.groupBy("_label").agg(F.count("*").alias("_size"))
    chosen = (
        known.join(F.broadcast(sizes), "_label")  # one row for each label
        .where(F.pmod("_order", F.lit(2**40)) * F.col("_size") <= enough * float(2**40))
        .withColumn("_order", F.pmod("_order", F.lit(2**40)))
        .withColumn(
            "_place", F.row_number().over(W.partitionBy("_label").orderBy("_order", "doc_id"))
        )
        .where(F.col("_place") <= per_class)
        .select("doc_id", "_label", "_order")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    start = 1 + F.pmod(F.col("_order"), F.greatest(F.lit(1), F.length(text) - chars + 1)).cast("int")
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most per_class rows for each label
        .groupBy("doc_id", "_label", "_order")
        .agg(F.max(F.substr(text, start, F.lit(chars))).alias("_text"))
        .collect()
    )
    return [(r["_text"], r["_label"]) for r in sorted(rows, key=lambda r: (r["_order"], r["doc_id"]))]

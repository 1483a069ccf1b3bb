"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted by source, language and topic.  The counts are raked until
their sums by source, by language and by topic match the targets; raked over
counted tokens of a cell is then the probability of each of its documents, which
are sampled by a hash of id and text.
"""

from __future__ import annotations

import logging
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.pieces import Numbering, slices
from lakestrata.operators.staging import stage

_LOG = logging.getLogger(__name__)

DIMENSIONS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Settings:
    """A target is a share for each value, or a power of the counted tokens.

    Power 1 leaves a dimension as it is, power 0 makes its values equal.  Values
    that a mapping leaves out get nothing.
    """

    targets: Mapping[str, Mapping[str, float] | float] = field(
        default_factory=lambda: {"source": 0.9, "lang": 0.8, "topic": 0.8}
    )
    budget: float = 0.6  # expected tokens of the sample, as a share of all
    topics: int = 8
    rounds: int | None = None  # None: as many as it takes
    tolerance: float = 1e-3  # of any value's share
    seed: int = 3


def tokens_and_topic(text: Column, topics: int) -> Column:
    """Struct of the count of words, and the topic most of its long words belong to.

    A word of four letters or more belongs to the topic its checksum gives; ties
    go to the lower topic, and a text without such words has topic 0.
    """

    @F.pandas_udf("tokens long, topic string")
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        numbering, of_word = Numbering(), np.zeros(0, np.int64)
        for texts in batches:
            tokens, chosen = [], []
            for part in slices(texts, 8_000_000):
                if len(numbering) > 600_000:
                    numbering, of_word = Numbering(), np.zeros(0, np.int64)
                rows = [numbering.numbers(t.split()) for t in part]
                new = [
                    zlib.crc32(w.lower().encode("utf-8", "replace")) % topics
                    if len(w) >= 4
                    else topics
                    for w in numbering.take()
                ]
                of_word = np.concatenate([of_word, np.array(new, np.int64)])
                for row in rows:
                    found = np.bincount(of_word[row], minlength=topics + 1)[:topics]
                    tokens.append(len(row))
                    chosen.append(str(int(found.argmax())))
            yield pd.DataFrame({"tokens": tokens, "topic": chosen})

    return describe(text)


def _key(value: Column) -> Column:
    """Nulls as a value of their own that no text equals."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def count_cells(described: DataFrame) -> DataFrame:
    """source, lang, topic and the tokens of each combination there is."""
    return described.groupBy(*DIMENSIONS).agg(F.sum("tokens").cast("double").alias("tokens"))


def _targets(cells: DataFrame, dimension: str, target) -> DataFrame:
    """Value and wanted share of one dimension."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("sum"))
    if isinstance(target, Mapping):
        given = cells.sparkSession.createDataFrame(
            [(f"={v}" if v is not None else "null", float(w)) for v, w in target.items()],
            f"{dimension} string, wanted double",
        )
        wanted = sums.join(given, dimension, "left").select(
            dimension, F.coalesce("wanted", F.lit(0.0)).alias("wanted")
        )
    else:
        power = F.when(F.col("sum") > 0, F.pow("sum", F.lit(float(target)))).otherwise(0.0)
        wanted = sums.select(dimension, power.alias("wanted"))
    total = wanted.agg(F.sum("wanted").alias("total"))
    return wanted.crossJoin(F.broadcast(total)).select(  # one row
        dimension, F.when(F.col("total") > 0, F.col("wanted") / F.col("total")).otherwise(0.0).alias("share")
    )


def _off(aim: str) -> Column:
    """By how much a sum is off its aim, as a share of that; null where that is nothing."""
    return F.when(F.col(aim) > 0, F.abs(F.col("sum") / F.col(aim) - 1))


def _errors(raked: DataFrame) -> DataFrame:
    """raked with ``error``: the worst of its three sums."""
    found = raked
    for d in DIMENSIONS:
        sums = raked.groupBy(d).agg(F.sum("weight").alias("sum"), F.max(f"aim_{d}").alias("aim"))
        found = found.join(sums.select(d, _off("aim").alias(f"off_{d}")), d)
    offs = [f"off_{d}" for d in DIMENSIONS]
    return found.withColumn("error", F.greatest(*offs)).drop(*offs)


def _progress(raked: DataFrame) -> tuple[float, float]:
    """The worst error of any sum, and the weight moved since ``before``: one pass."""
    margins = [
        F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value"), F.col(f"aim_{d}").alias("aim"))
        for d in DIMENSIONS
    ]
    sums = (
        raked.select(
            F.inline(F.array(*margins)),
            "weight",
            F.abs(F.col("weight") - F.col("before")).alias("moved"),
        )
        .groupBy("dimension", "value")
        .agg(F.sum("weight").alias("sum"), F.max("aim").alias("aim"), F.sum("moved").alias("moved"))
    )
    # Every cell stands in one sum of each dimension.
    moved = F.sum(F.when(F.col("dimension") == DIMENSIONS[0], F.col("moved")))
    worst, total = sums.agg(F.max(_off("aim")), moved).first()
    return worst or 0.0, total or 0.0


def rake(cells: DataFrame, s: Settings) -> DataFrame:
    """cells with ``weight``: tokens scaled until all three sums match their targets.

    The weights sum to the budget, and no cell's weight passes its tokens: what a
    full cell cannot give, the others of its values give in the next rounds.
    Rounds end when all sums are met within ``tolerance``, or, as some targets cannot
    be met together, when a round moves less than a hundredth of it.  ``error`` is the
    most by which a sum of the cell's source, language or topic is off its target, as
    a share of that; null where that is nothing.
    Cells follow the combinations there are, not the documents.  Each step is written,
    so that no plan holds more than one step's join: what is broadcast takes
    memory of the driver, however few rows it has.
    """
    columns = cells.columns
    cells = stage(cells, "mix-cells")
    wanted = s.budget * (cells.agg(F.sum("tokens")).first()[0] or 0.0)
    raked = cells.withColumn("weight", F.col("tokens") * s.budget)
    for d in DIMENSIONS:
        target = _targets(cells, d, s.targets.get(d, 1.0))
        aims = target.select(d, (F.col("share") * wanted).alias(f"aim_{d}"))
        raked = stage(raked.join(aims, d), "mix-aims")
    for done in count(1):
        raked = raked.withColumn("before", F.col("weight"))
        for d in DIMENSIONS:
            sums = raked.groupBy(d).agg(F.sum("weight").alias("sum"))
            factor = F.when(F.col("sum") > 0, F.col(f"aim_{d}") / F.col("sum")).otherwise(0.0)
            scaled = raked.join(sums, d).withColumn(
                "weight", F.least("tokens", F.col("weight") * factor)
            )
            raked = stage(scaled.drop("sum"), "mix-raked")
        worst, moved = _progress(raked)
        settled = moved <= s.tolerance * wanted / 100
        if worst < s.tolerance or settled or done == s.rounds:
            break
    if worst >= s.tolerance:
        _LOG.warning("sums are off their targets by %.3g after %d rounds", worst, done)
    raked = _errors(raked).select(*columns, "weight", "error")
    chance = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    return raked.withColumn("probability", chance)


def _decided(docs: DataFrame, doc: Column, s: Settings, topic: Column | None) -> DataFrame:
    """``doc`` of each document beside its margins, tokens, draw and probability."""
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(s.seed)), F.lit(2**53)) / F.lit(float(2**53))
    found = docs.select(
        doc.alias("doc"),
        tokens_and_topic(F.col("text"), s.topics).alias("found"),
        _key(F.col("source")).alias("source"),
        _key(F.col("lang")).alias("lang"),
        draw.alias("draw"),
        *([] if topic is None else [topic.alias("given")]),
    )
    described = stage(
        found.select(
            "doc",
            "source",
            "lang",
            _key(F.col("found.topic" if topic is None else "given")).alias("topic"),
            F.col("found.tokens").alias("tokens"),
            "draw",
        ),
        "mix-documents",
    )
    raked = stage(rake(count_cells(described), s), "mix-chances")
    chances = raked.select(*DIMENSIONS, "probability", "error")
    joined = described.join(chances, list(DIMENSIONS))
    return joined.withColumn("sampled", F.col("draw") < F.col("probability"))


def mix(docs: DataFrame, s: Settings = Settings(), topic: Column | None = None) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, weight, probability,
    sampled, margin_error.

    ``topic`` may name a column to be used in place of the one worked out.  Null
    sources, languages and topics are values of their own; texts without words
    have no tokens and are never sampled from a cell without any; equal rows share
    one fate.  ``margin_error`` is that of ``rake``.  Other columns are not read.
    """
    return _decided(docs, F.struct("doc_id", "source", "lang"), s, topic).select(
        "doc.*",
        F.expr("CASE WHEN topic <> 'null' THEN substring(topic, 2) END").alias("topic"),
        F.col("tokens").alias("n_tokens"),
        (F.col("probability") / s.budget).alias("weight"),
        "probability",
        "sampled",
        F.col("error").alias("margin_error"),
    )


def sample(docs: DataFrame, s: Settings = Settings(), topic: Column | None = None) -> DataFrame:
    """The sampled documents, with all columns they came with."""
    return _decided(docs, F.struct("*"), s, topic).where("sampled").select("doc.*")

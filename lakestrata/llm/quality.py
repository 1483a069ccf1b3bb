"""Quality: supervised subword embeddings.

Each hashed word and character n-gram has a learned vector; a document is the
average of its features' vectors, and a softmax over two classes reads it.  Of
word pairs only those of equal words are features; they share one vector, so
that repetition shows whatever the word.
Vectors and output are trained in numpy by stochastic gradient descent on a
bounded sample, in a fixed number of steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.ngrams import WordSums, feature_lists
from lakestrata.llm.pieces import slices
from lakestrata.llm.samples import labelled_sample


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (2, 3, 4)
    buckets: int = 2**17
    width: int = 12
    per_class: int = 1500  # documents of each label to learn from
    chars: int = 8000  # of each
    pairs: int = 8  # times the feature of an equal pair counts
    words: int = 200  # of a document in one step
    steps: int = 400
    batch: int = 32
    rate: float = 1.0


@dataclass
class QualityModel:
    vectors: np.ndarray  # bucket x width, then the vector of equal pairs
    output: np.ndarray  # width x 2
    bias: np.ndarray  # 2
    settings: Settings = field(default_factory=Settings)

    def margins(self) -> np.ndarray:
        """What each feature adds to logit 1 minus logit 0, before averaging."""
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0]))[:, None]

    def scores(self, sums: np.ndarray) -> np.ndarray:
        margin = sums[:, 0] / np.maximum(sums[:, 1], 1) + self.bias[1] - self.bias[0]
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, label: str, s: Settings = Settings()) -> QualityModel:
    return fit_sample(labelled_sample(docs, labels, label, s.per_class, s.chars), s)


def with_pairs(
    words: list[str], ids: np.ndarray, lens: np.ndarray, s: Settings
) -> tuple[np.ndarray, np.ndarray]:
    """Feature lists with those of words that equal their predecessor added."""
    same = np.array([False, *(a == b for a, b in zip(words, words[1:]))])
    at = np.repeat(np.cumsum(lens)[same], s.pairs)
    return np.insert(ids, at, s.buckets), lens + s.pairs * same


def fit_sample(sample: list[tuple[str, int]], s: Settings = Settings()) -> QualityModel:
    """Labels are 0 or 1.  Without examples of both, the score is their share."""
    rng = np.random.default_rng(0)
    vectors = rng.uniform(-1 / s.width, 1 / s.width, (s.buckets + 1, s.width))
    output, bias = np.zeros((s.width, 2)), np.zeros(2)
    examples = []
    for text, label in sample:
        if words := text.split():
            ids, lens = with_pairs(words, *feature_lists(words, s.orders, s.buckets, True), s)
            examples.append((ids, np.append(0, np.cumsum(lens)), int(label)))
    counts = np.bincount([y for *_, y in examples], minlength=2)
    if not counts.all():
        bias[:] = np.log(counts + 1.0)
        return QualityModel(vectors * 0, output, bias, s)
    for step in range(s.steps):
        rate = s.rate * (1 - step / s.steps)
        chosen = [examples[k] for k in rng.integers(0, len(examples), s.batch)]
        parts = []
        for ids, upto, _ in chosen:
            first = int(rng.integers(0, max(len(upto) - 1 - s.words, 0) + 1))
            parts.append(ids[upto[first] : upto[min(first + s.words, len(upto) - 1)]])
        lens = np.array([len(p) for p in parts])
        ids = np.concatenate(parts)
        hidden = np.add.reduceat(vectors[ids], np.cumsum(lens) - lens) / lens[:, None]
        logits = hidden @ output + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(s.batch), [y for *_, y in chosen]] -= 1
        p /= s.batch
        back = (p @ output.T) / lens[:, None] * s.batch
        bias -= rate * p.sum(axis=0)
        output -= rate * hidden.T @ p
        np.add.at(vectors, ids, -rate * np.repeat(back, lens, axis=0))
    return QualityModel(vectors, output, bias, s)


def quality(text: Column, model: QualityModel) -> Column:
    """Score of label 1, from 0 to 1, for a whole text; null counts as empty."""
    s, margins = model.settings, model.margins()
    bare = QualityModel(np.zeros((0, s.width)), model.output, model.bias, s)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sums = WordSums(
            margins[:-1], s.orders, whole=True, pair=margins[-1], pair_count=s.pairs, limit=400_000
        )
        for texts in batches:
            parts = [bare.scores(sums.of(part)) for part in slices(texts, 4_000_000)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score(text)


def score_quality(docs: DataFrame, model: QualityModel, least: float = 0.3) -> DataFrame:
    """One row per document: doc_id, score, predicted.

    Null and empty texts have the score of no features; repeated rows and null
    ids are rows of their own; other columns are not read.
    """
    return docs.select("doc_id", quality(F.col("text"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= least).cast("int")
    )

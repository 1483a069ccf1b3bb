"""Language ID: sparse multinomial logistic regression on TF-IDF n-grams.

Features are hashed character n-grams of lower-cased words.  A text's weights
are relative frequencies times inverse document frequencies counted over all
documents it may learn from.  The regression is trained with
follow-the-regularised-leader under an elastic net on a bounded sample, and its
probabilities are tempered on examples it did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.ngrams import WordSums, feature_lists
from lakestrata.llm.pieces import Numbering, Ragged, slices
from lakestrata.llm.samples import is_remainder, labelled_sample

UNDETERMINED = "und"


def has_letter(text: str) -> bool:
    """Signs such as ½, ² and ① are numbers, not letters."""
    return any(map(str.isalpha, text))


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (1, 2, 3)
    buckets: int = 2**16
    per_class: int = 1000  # documents of each language to learn from
    chars: int = 8000  # of each
    passes: int = 3
    scale: float = 10.0
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.01


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # bucket x language, idf included
    bias: np.ndarray
    temperature: float = 1.0
    settings: Settings = field(default_factory=Settings)

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        counts = np.maximum(sums[:, -1:], 1)
        return _softmax((sums[:, :-1] / counts + self.bias) / self.temperature)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(docs: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """(documents that have a bucket's n-gram, documents), over all of ``docs``."""
    orders, buckets = settings.orders, settings.buckets

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbering, features = Numbering(), Ragged(np.int32)
        found, seen = np.zeros(buckets, np.int64), 0
        for batch in batches:
            for part in slices(batch["text"], 4_000_000):
                if len(numbering) > 300_000:
                    numbering, features = Numbering(), Ragged(np.int32)
                rows = [numbering.numbers(list(set(t.lower().split()))) for t in part]
                if fresh := numbering.take():
                    features.extend(*feature_lists(fresh, orders, buckets))
                for row in rows:
                    present = np.zeros(buckets, bool)
                    present[features.gather(row)] = True
                    found += present
                seen += len(part)
        at = np.flatnonzero(found)
        yield pd.DataFrame({"bucket": at, "found": found[at]})
        yield pd.DataFrame({"bucket": [-1], "found": [seen]})

    rows = (
        docs.select("text")
        .mapInPandas(count, "bucket long, found long")
        .groupBy("bucket")
        .agg(F.sum("found").alias("found"))
        .collect()  # at most one row per bucket
    )
    frequencies, total = np.zeros(buckets), 0
    for row in rows:
        if row["bucket"] < 0:
            total = row["found"]
        else:
            frequencies[row["bucket"]] = row["found"]
    return frequencies, total


def fit(docs: DataFrame, settings: Settings = Settings()) -> LanguageModel:
    """Learn from text and lang of ``docs``; rows without either are passed over."""
    docs = docs.select("doc_id", "text", "lang").where("lang IS NOT NULL")
    frequencies, total = document_frequencies(docs, settings)
    idf = np.log((1 + total) / (1 + frequencies))
    sample = labelled_sample(docs, docs, "lang", settings.per_class, settings.chars)
    sample = [(t, l) for t, l in sample if has_letter(t)]
    return fit_sample(sample, idf, settings)


def fit_sample(
    sample: list[tuple[str, str]], idf: np.ndarray, settings: Settings
) -> LanguageModel:
    languages = sorted({label for _, label in sample}) or [UNDETERMINED]
    examples = []
    for text, label in sample:
        words = text.lower().split()
        ids, _ = feature_lists(words, settings.orders, settings.buckets)
        at, counts = np.unique(ids, return_counts=True)
        examples.append(
            (at, settings.scale * counts / max(len(ids), 1) * idf[at], languages.index(label))
        )
    held = examples[::5] if len(examples) >= 50 else []
    learn = [e for k, e in enumerate(examples) if k % 5] if held else examples
    weights, bias = _follow_the_leader(learn, len(languages), settings)
    model = LanguageModel(
        languages, weights * (settings.scale * idf)[:, None], bias, settings=settings
    )
    if held:
        logits = np.array([v @ weights[at] + bias for at, v, _ in held])
        model.temperature = _temperature(logits, np.array([y for _, _, y in held]))
    return model


def _follow_the_leader(
    examples: list, classes: int, s: Settings
) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with per-coordinate rates; the last coordinate is the bias."""
    z = np.zeros((s.buckets + 1, classes))
    n = np.zeros((s.buckets + 1, classes))
    rng = np.random.default_rng(0)

    def weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        rate = (s.beta + np.sqrt(n)) / s.alpha + s.l2
        return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / rate

    for _ in range(s.passes):
        for k in rng.permutation(len(examples)):
            at, values, label = examples[k]
            at = np.append(at, s.buckets)
            values = np.append(values, 1.0)
            w = weights(z[at], n[at], s.l1)
            p = _softmax(values @ w)
            p[label] -= 1
            g = values[:, None] * p
            before = n[at]
            n[at] = before + g * g
            z[at] += g - (np.sqrt(n[at]) - np.sqrt(before)) / s.alpha * w
    w = weights(z, n, s.l1)
    return w[:-1], w[-1]


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss."""
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    at = np.arange(len(labels))
    loss = [-np.log(_softmax(logits / t)[at, labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def language(text: Column, model: LanguageModel) -> Column:
    """Struct (lang_pred, score) for a text column."""
    shared = model

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        s = shared.settings
        sums = WordSums(shared.weights, s.orders, lower=True, limit=400_000)
        names = np.array(shared.languages, object)
        for texts in batches:
            names_out, scores = [], []
            for part in slices(texts, 4_000_000):
                p = shared.probabilities(sums.of(part))
                known = np.array([has_letter(t) for t in part], bool)
                names_out.append(np.where(known, names[p.argmax(axis=1)], UNDETERMINED))
                scores.append(np.where(known, p.max(axis=1), 0.0))
            yield pd.DataFrame(
                {
                    "lang_pred": np.concatenate(names_out) if names_out else [],
                    "score": np.concatenate(scores) if scores else [],
                }
            )

    return predict(text)


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document: doc_id, lang_pred, score.

    Null texts and texts without a letter are ``und`` with score 0.  Repeated
    rows and null ids are rows of their own; other columns are not read.
    """
    found = language(F.col("text"), model).alias("_language")
    return docs.select("doc_id", found).select("doc_id", "_language.*")


def learnable(docs: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """Documents a model may learn from: those with an id that is not held out."""
    return docs.where(F.col("doc_id").isNotNull() & ~is_remainder("doc_id", modulus, held))


def keep_known_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents, with all their columns, whose language is told with ``least`` or more."""
    model = fit(learnable(docs))
    told = language(F.col("text"), model)
    # The user's columns stay in one struct, apart from the one made here.
    return (
        docs.select(F.struct("*").alias("doc"), told.alias("told"))
        .where((F.col("told.lang_pred") != UNDETERMINED) & (F.col("told.score") >= least))
        .select("doc.*")
    )

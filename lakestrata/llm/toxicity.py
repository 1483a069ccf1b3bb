"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word enters as its hashed vector beside the mean vector of its characters'
n-grams.  The network reads windows that overlap and together cover the whole
text; attention pools the states of a window, and the highest window gives the
document's score.  It is trained in numpy on a bounded sample, in a fixed number
of steps, on the window of each document that scores highest at that time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.ngrams import hashed_ngrams
from lakestrata.llm.pieces import Numbering, slices
from lakestrata.llm.samples import labelled_sample

_WORDS = re.compile(r"\w+")


@dataclass(frozen=True)
class Settings:
    window: int = 48  # words
    stride: int = 36
    word_buckets: int = 2**14
    word_width: int = 12
    char_orders: tuple[int, ...] = (1, 2, 3)
    char_buckets: int = 2**12
    char_width: int = 8
    state: int = 8  # in each direction
    attention: int = 8
    per_class: int = 3000  # documents of each label to learn from
    chars: int = 3000  # of each
    steps: int = 300  # fewer where few documents are toxic, lest it learns them by heart
    batch: int = 32
    positives: float = 0.25  # share of toxic documents in a step
    rate: float = 0.02


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class ToxicityModel:
    weights: dict[str, np.ndarray]
    settings: Settings = field(default_factory=Settings)

    def inputs(self, words: list[str]) -> np.ndarray:
        """Each word's part of all gates, for both directions; zeros in a last row."""
        x, _ = self._vectors(words)
        gates = x @ self.weights["enter"] + self.weights["enter_bias"]
        return np.vstack([gates, np.zeros((1, gates.shape[1]))]).astype(np.float32)

    def _vectors(self, words: list[str]) -> tuple[np.ndarray, list]:
        s, w = self.settings, self.weights
        x = np.zeros((len(words), s.word_width + s.char_width))
        word_ids = np.zeros(0, np.int64)
        for _, word_ids in hashed_ngrams(words, (), s.word_buckets, whole=True):
            pass
        x[:, : s.word_width] = w["word"][word_ids]
        chars = list(hashed_ngrams(words, s.char_orders, s.char_buckets))
        counts = np.maximum(sum(np.bincount(o, minlength=len(words)) for o, _ in chars), 1)
        for owner, ids in chars:
            for k in range(s.char_width):
                x[:, s.word_width + k] += np.bincount(owner, w["char"][ids, k], len(words))
        x[:, s.word_width :] /= counts[:, None]
        return x, [word_ids, chars, counts]

    def _run(self, gates: np.ndarray, valid: np.ndarray, recur: np.ndarray, back: bool) -> tuple:
        """States of one direction; ``gates`` is time x window x 3 states."""
        steps, many, _ = gates.shape
        size = recur.shape[0]
        h = np.zeros((many, size), gates.dtype)
        states = np.empty((steps, many, size), gates.dtype)
        kept = []
        for t in range(steps - 1, -1, -1) if back else range(steps):
            inner = h @ recur
            zr = _sigmoid(gates[t, :, : 2 * size] + inner[:, : 2 * size])
            z, r = zr[:, :size], zr[:, size:]
            n = np.tanh(gates[t, :, 2 * size :] + r * inner[:, 2 * size :])
            step = (h - n) * z + n
            new = np.where(valid[t][:, None], step, h)
            kept.append((t, h, z, r, n, inner[:, 2 * size :]))
            states[t] = h = new
        return states, kept

    def logits(self, table: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """``windows``: rows of word numbers; -1, the table's last row, pads them."""
        return np.concatenate(
            [self._forward(table, windows[k : k + 4096])[0] for k in range(0, len(windows), 4096)]
            or [np.zeros(0)]
        )

    def _forward(self, table: np.ndarray, windows: np.ndarray) -> tuple:
        w, size = self.weights, self.settings.state
        gates = table[windows.T]
        valid = windows.T >= 0
        kind = table.dtype
        fore, kept_fore = self._run(gates[:, :, : 3 * size], valid, w["fore"].astype(kind), False)
        back, kept_back = self._run(gates[:, :, 3 * size :], valid, w["back"].astype(kind), True)
        states = np.concatenate([fore, back], axis=2)
        hidden = np.tanh(states @ w["attend"].astype(kind))
        weight = hidden @ w["attend_to"].astype(kind)
        weight = np.where(valid, weight, -1e9)
        weight = np.exp(weight - weight.max(axis=0)) * valid
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbs->bs", weight, states)
        logit = pooled @ w["out"] + w["out_bias"][0]
        return logit, (gates, valid, states, hidden, weight, pooled, kept_fore, kept_back)

    def _gradients(self, words: list[str], windows: np.ndarray, labels: np.ndarray) -> dict:
        s, w, size = self.settings, self.weights, self.settings.state
        x, (word_ids, chars, counts) = self._vectors(words)
        table = np.vstack([x @ w["enter"] + w["enter_bias"], np.zeros((1, 6 * size))])
        logit, kept = self._forward(table, windows)
        gates, valid, states, hidden, weight, pooled, kept_fore, kept_back = kept
        d = (_sigmoid(logit) - labels) / len(labels)
        g = {"out": pooled.T @ d, "out_bias": np.array([d.sum()])}
        d_pooled = d[:, None] * w["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("bs,tbs->tb", d_pooled, states)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["attend_to"] = np.einsum("tbk,tb->k", hidden, d_score)
        d_hidden = d_score[:, :, None] * w["attend_to"] * (1 - hidden**2)
        g["attend"] = np.einsum("tbs,tbk->sk", states, d_hidden)
        d_states = d_states + d_hidden @ w["attend"].T
        d_gates = np.zeros_like(gates)
        for name, kept_way, part, at in (
            ("fore", kept_fore, d_states[:, :, :size], slice(0, 3 * size)),
            ("back", kept_back, d_states[:, :, size:], slice(3 * size, 6 * size)),
        ):
            recur = w[name]
            d_recur = np.zeros_like(recur)
            d_h = np.zeros_like(pooled[:, :size])
            for t, h, z, r, n, inner in reversed(kept_way):
                total = d_h + part[t]
                d_step = np.where(valid[t][:, None], total, 0)
                d_n = d_step * (1 - z) * (1 - n**2)
                d_z = d_step * (h - n) * z * (1 - z)
                d_r = d_n * inner * r * (1 - r)
                d_gates[t, :, at] = np.concatenate([d_z, d_r, d_n], axis=1)
                d_inner = np.concatenate([d_z, d_r, d_n * r], axis=1)
                d_recur += h.T @ d_inner
                d_h = np.where(valid[t][:, None], d_step * z, total) + d_inner @ recur.T
            g[name] = d_recur
        d_table = np.zeros_like(table)
        np.add.at(d_table, windows.T[valid], d_gates[valid])
        d_table = d_table[:-1]
        g["enter"], g["enter_bias"] = x.T @ d_table, d_table.sum(axis=0)
        d_x = d_table @ w["enter"].T
        g["word"] = np.zeros_like(w["word"])
        np.add.at(g["word"], word_ids, d_x[:, : s.word_width])
        g["char"] = np.zeros_like(w["char"])
        for owner, ids in chars:
            np.add.at(g["char"], ids, (d_x[:, s.word_width :] / counts[:, None])[owner])
        return g


def windows_of(numbers: np.ndarray, s: Settings) -> np.ndarray:
    """Windows over a text's words; the last ends with the text, -1 pads a short one."""
    if len(numbers) <= s.window:
        padded = np.full((1, s.window), -1, np.int64)
        padded[0, : len(numbers)] = numbers
        return padded
    starts = np.append(
        np.arange(0, len(numbers) - s.window, s.stride), len(numbers) - s.window
    )
    return numbers[starts[:, None] + np.arange(s.window)]


def _initial(s: Settings, rng: np.random.Generator) -> dict[str, np.ndarray]:
    width = s.word_width + s.char_width
    return {
        "word": rng.normal(0, 0.05, (s.word_buckets, s.word_width)),
        "char": rng.normal(0, 0.05, (s.char_buckets, s.char_width)),
        "enter": rng.normal(0, width**-0.5, (width, 6 * s.state)),
        "enter_bias": np.zeros(6 * s.state),
        "fore": rng.normal(0, s.state**-0.5, (s.state, 3 * s.state)),
        "back": rng.normal(0, s.state**-0.5, (s.state, 3 * s.state)),
        "attend": rng.normal(0, 0.3, (2 * s.state, s.attention)),
        "attend_to": rng.normal(0, 0.3, s.attention),
        "out": rng.normal(0, 0.3, 2 * s.state),
        "out_bias": np.zeros(1),
    }


def fit(docs: DataFrame, labels: DataFrame, label: str, s: Settings = Settings()) -> ToxicityModel:
    return fit_sample(labelled_sample(docs, labels, label, s.per_class, s.chars), s)


def fit_sample(sample: list[tuple[str, int]], s: Settings = Settings()) -> ToxicityModel:
    """Labels are 0 or 1.  Without examples of both, every score is their share."""
    rng = np.random.default_rng(0)
    model = ToxicityModel(_initial(s, rng), s)
    texts = [(_WORDS.findall(t.lower()), int(y)) for t, y in sample]
    by_label = [[t for t, y in texts if y == k and t] for k in (0, 1)]
    if not (by_label[0] and by_label[1]):
        model.weights = {k: v * 0 for k, v in model.weights.items()}
        counts = [1 + sum(y == k for _, y in texts) for k in (0, 1)]
        model.weights["out_bias"][0] = np.log(counts[1] / counts[0])
        return model
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    toxic = max(1, round(s.batch * s.positives))
    labels = np.repeat([1.0, 0.0], [toxic, s.batch - toxic])
    steps = min(s.steps, 60 + len(by_label[1]) // 2)
    for step in range(1, steps + 1):
        chosen = [by_label[int(y)][rng.integers(len(by_label[int(y)]))] for y in labels]
        numbering = Numbering()
        cut = [windows_of(numbering.numbers(words), s) for words in chosen]
        logit = model.logits(model.inputs(list(numbering)), np.concatenate(cut))
        upto = np.append(0, np.cumsum([len(c) for c in cut]))
        best = np.array([c[logit[a:b].argmax()] for c, a, b in zip(cut, upto, upto[1:])])
        g = model._gradients(list(numbering), best, labels)
        rate = s.rate * min(1, 2 * (1 - step / (steps + 1)))
        for name, value in g.items():
            first[name] += 0.1 * (value - first[name])
            second[name] += 0.01 * (value**2 - second[name])
            mean = first[name] / (1 - 0.9**step)
            spread = second[name] / (1 - 0.99**step)
            model.weights[name] -= rate * mean / (np.sqrt(spread) + 1e-6)
    return model


def toxicity(text: Column, model: ToxicityModel) -> Column:
    """Score of label 1, from 0 to 1, over all windows of a text; null counts as empty."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            parts = [scorer.scores(part) for part in slices(texts, 4_000_000)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score(text)


class Scorer:
    """Scores whole texts; each distinct word's part of the gates is worked out once."""

    def __init__(self, model: ToxicityModel, limit: int = 300_000) -> None:
        self.model, self.limit = model, limit
        self._reset()

    def _reset(self) -> None:
        self.numbering = Numbering()
        self.table = self.model.inputs([])

    def scores(self, texts: list[str]) -> np.ndarray:
        if len(self.numbering) > self.limit:
            self._reset()
        cut = [
            windows_of(self.numbering.numbers(_WORDS.findall(t.lower())), self.model.settings)
            for t in texts
        ]
        if fresh := self.numbering.take():
            self.table = np.vstack([self.table[:-1], self.model.inputs(fresh)])
        logit = self.model.logits(self.table, np.concatenate(cut))
        counts = np.array([len(c) for c in cut])
        return _sigmoid(np.maximum.reduceat(logit, np.cumsum(counts) - counts))


def score_toxicity(docs: DataFrame, model: ToxicityModel, least: float = 0.5) -> DataFrame:
    """One row per document: doc_id, score, predicted.

    Null and empty texts have the score of a window without words; repeated rows
    and null ids are rows of their own; other columns are not read.
    """
    return docs.select("doc_id", toxicity(F.col("text"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= least).cast("int")
    )

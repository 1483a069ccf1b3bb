"""Hashed character n-grams of words, and linear models over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from lakestrata.llm.pieces import Numbering

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def hashed_ngrams(
    words: list[str], orders: tuple[int, ...], buckets: int, whole: bool = False
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: (word of each n-gram, bucket of each n-gram).

    N-grams run over ``<word>``.  ``whole`` adds one feature for the full word.
    """
    marked = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lens)
    owner = np.repeat(np.arange(len(words)), lens)
    last = np.repeat(ends, lens)
    place = np.arange(len(codes))
    for n in orders:
        count = max(len(codes) - n + 1, 0)
        h = np.full(count, n, np.uint64)
        for k in range(n):
            h = (h ^ codes[k : k + count]) * _STEP
            h ^= h >> np.uint64(29)
        inside = place[:count] + n <= last[:count]
        h = (h[inside] * _MIX) >> np.uint64(20)
        yield owner[:count][inside], (h % np.uint64(buckets)).astype(np.int64)
    if whole and len(words):
        # A word's feature: the sum of its characters' hashes, each mixed with its place.
        inner = (codes + np.uint64(1)) * _STEP * ((place - (last - np.repeat(lens, lens))).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        inner ^= inner >> np.uint64(31)
        h = (np.add.reduceat(inner * _MIX, ends - lens) * _STEP) >> np.uint64(20)
        yield np.arange(len(words)), (h % np.uint64(buckets)).astype(np.int64)


def word_sums(
    words: list[str], table: np.ndarray, orders: tuple[int, ...], whole: bool = False
) -> np.ndarray:
    """Per word: sums of its features' rows of ``table``, then its feature count."""
    sums = np.zeros((len(words), table.shape[1] + 1))
    for owner, ids in hashed_ngrams(words, orders, len(table), whole):
        for column in range(table.shape[1]):
            sums[:, column] += np.bincount(owner, table[ids, column], len(words))
        sums[:, -1] += np.bincount(owner, minlength=len(words))
    return sums


def feature_lists(
    words: list[str], orders: tuple[int, ...], buckets: int, whole: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids word by word, ids per word)."""
    parts = list(hashed_ngrams(words, orders, buckets, whole))
    owner = np.concatenate([o for o, _ in parts]) if parts else np.zeros(0, np.int64)
    ids = np.concatenate([i for _, i in parts]) if parts else np.zeros(0, np.int64)
    by_word = np.argsort(owner, kind="stable")
    return ids[by_word], np.bincount(owner, minlength=len(words))


class WordSums:
    """Sums of a linear model's rows over all features of whole texts.

    A model that averages its features is linear in them, so each distinct word
    is worked out once; a text's sum is the sum over its words.  ``pair`` is the
    row that each word equal to its predecessor adds, ``pair_count`` times.
    """

    def __init__(
        self,
        table: np.ndarray,
        orders: tuple[int, ...],
        whole: bool = False,
        lower: bool = False,
        pair: np.ndarray | None = None,
        pair_count: int = 0,
        limit: int = 600_000,
    ) -> None:
        self.pair = np.append(0 if pair is None else pair * pair_count, pair_count)
        self.table, self.orders, self.whole, self.lower = table, orders, whole, lower
        self.limit = limit
        self._reset()

    def _reset(self) -> None:
        self.numbering = Numbering()
        self.sums = np.zeros((0, self.table.shape[1] + 1), np.float32)

    def of(self, texts: list[str]) -> np.ndarray:
        """One row per text; zeros for a text without words."""
        if len(self.numbering) > self.limit:
            self._reset()
        rows = [self.numbering.numbers((t.lower() if self.lower else t).split()) for t in texts]
        if fresh := self.numbering.take():
            new = word_sums(fresh, self.table, self.orders, self.whole)
            self.sums = np.concatenate([self.sums, new.astype(np.float32)])
        out = np.zeros((len(texts), self.sums.shape[1]))
        for at, row in enumerate(rows):
            if len(row):
                out[at] = self.sums[row].sum(axis=0, dtype=np.float64)
                if self.pair[-1]:
                    out[at] += self.pair * np.count_nonzero(row[1:] == row[:-1])
        return out

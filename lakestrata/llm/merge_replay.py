"""Byte-level BPE by corpus-level merge replay, and its inverse.

The distinct pre-tokens of a task's documents form one corpus.  An inverted
index leads from a token pair to the positions where it stands; merges are
applied in rank order, each to all its positions at once, and only the pairs
with touched neighbours are looked up again.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.pieces import TokenCache, give_back, slices

_NONE = np.int32(2**31 - 1)
_CHARS = 8_000_000  # of the texts that are encoded and given back at a time


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


class MergeTable:
    """The rank file as arrays: token of each byte, rank of each mergeable pair."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.width = len(self.tokens) + 1
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = sorted(
            (left * self.width + right, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None
            and (right := ranks.get(token[cut:])) is not None
        )
        self.keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs] or [_NONE], np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, ``_NONE`` where there is none."""
        wanted = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.pair_ranks[at], _NONE)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, ids per word)."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        size = int(lens.sum())
        if not size:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        ends = np.cumsum(lens)
        filled = lens > 0
        token = np.append(
            self.of_byte[np.frombuffer(b"".join(words), np.uint8)], np.int32(self.width - 1)
        )
        following = np.arange(1, size + 2, dtype=np.int32)
        following[ends[filled] - 1] = size
        before = np.append(np.arange(-1, size - 1, dtype=np.int32), np.int32(size))
        before[(ends - lens)[filled]] = size
        pair = np.full(size + 1, _NONE, np.int32)
        first = np.flatnonzero(following[:size] < size)
        pair[first] = self.rank_of(token[first], token[following[first]])
        gone = np.zeros(size, bool)
        odd: list[np.ndarray] = []

        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def enter(at: np.ndarray) -> None:
            at = at[pair[at] != _NONE]
            if not len(at):
                return
            at = at[np.argsort(pair[at], kind="stable")]
            of = pair[at]
            cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
            for rank, part in zip(of[np.append(0, cuts)].tolist(), np.split(at, cuts)):
                if rank in index:
                    index[rank].append(part)
                else:
                    index[rank] = [part]
                    heapq.heappush(queue, rank)

        enter(first)
        while queue:
            rank = heapq.heappop(queue)
            at = np.concatenate(index.pop(rank))
            at = at[pair[at] == rank]
            if len(at) > 1:
                at.sort()
                at = at[np.append(True, at[1:] != at[:-1])]
                # Of overlapping pairs, as in a run of one letter, every other one merges.
                joined = np.append(False, following[at[:-1]] == at[1:])
                if joined.any():
                    place = np.arange(len(at))
                    begin = np.maximum.accumulate(np.where(joined, 0, place))
                    at = at[(place - begin) % 2 == 0]
            second = following[at]
            after = following[second]
            token[at] = rank
            following[at] = after
            before[after] = at
            gone[second] = True
            pair[second] = _NONE
            pair[at] = _NONE
            touched = np.concatenate([at[after < size], (p := before[at])[p < size]])
            pair[touched] = now = self.rank_of(token[touched], token[following[touched]])
            if len(early := touched[now < rank]):
                odd.append(early)
            enter(touched)

        kept = np.append(0, np.cumsum(~gone))
        ids, counts = token[:size][~gone], kept[ends] - kept[ends - lens]
        if odd:
            ids, counts = self._redo(words, ids, counts, ends, np.concatenate(odd))
        return ids, counts

    def _redo(self, words, ids, counts, ends, positions) -> tuple[np.ndarray, np.ndarray]:
        """Encode words anew in which a merge made way for one of lower rank.

        There the order between equal pairs of one word matters.
        """
        again = set(np.searchsorted(ends, positions, side="right").tolist())
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for word in again:
            parts[word] = np.array(self.merge_word(words[word]), np.int32)
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))

    def merge_word(self, word: bytes) -> list[int]:
        """One word, lowest rank first, leftmost first."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            found = [self.ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
            if (best := min(found)) == _NONE:
                break
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


class ReplayEncoder:
    """Texts to token ids with one rank file and one splitting pattern."""

    def __init__(self, table: MergeTable, pattern: str) -> None:
        self.table = table
        self._split = regex.compile(pattern).findall
        self.forget()

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        numbers: dict[str, int] = {}
        rows = [[numbers.setdefault(w, len(numbers)) for w in self._split(p)] for p in pieces]
        ids, counts = self.table.replay([w.encode("utf-8", "replace") for w in numbers])
        starts = np.cumsum(counts) - counts
        words = np.fromiter((n for row in rows for n in row), np.int64)
        per_piece = np.fromiter(map(len, rows), np.int64, len(rows))
        lens = counts[words]
        stops = np.cumsum(lens)
        flat = ids[np.repeat(starts[words] - (stops - lens), lens) + np.arange(lens.sum())]
        upto = np.append(0, stops)
        piece_ends = np.cumsum(per_piece)
        return flat, upto[piece_ends] - upto[piece_ends - per_piece]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self._cache.encoded(texts)

    def forget(self) -> None:
        """Drop all pieces, and keep new ones from now on."""
        self._cache = TokenCache(self._pieces, limit=600_000)


@lru_cache(maxsize=2)
def _table(path: str) -> MergeTable:
    """One per Python worker."""
    return MergeTable(read_ranks(path))


@contextmanager
def _encoder(path: str, pattern: str) -> Iterator[ReplayEncoder]:
    """An encoder for the length of a task, whose pieces go with it.

    Workers live on: what they kept, the next stage would lack.
    """
    encoder = ReplayEncoder(_table(path), pattern)
    try:
        yield encoder
    finally:
        encoder.forget()
        give_back()


def bpe_ids(text: Column, path: str, pattern: str) -> Column:
    """Token ids of a text column as ARRAY<INT>; null counts as empty.

    ``path`` must lead to the rank file on every executor.
    """

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with _encoder(path, pattern) as encoder:
            for texts in batches:
                for part in slices(texts, _CHARS):
                    ids = [i.astype(np.int32) for i in encoder.encode(part)]
                    yield pd.Series(ids, dtype=object)

    return encode(text)


def bpe_text(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of a column of token ids; null counts as no ids."""

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = _table(path)
        for rows in batches:
            yield pd.Series(
                [table.decode(np.asarray([] if r is None else r, np.int64)) for r in rows],
                dtype=object,
            )

    return decode(ids)


def round_trip(text: Column, path: str, pattern: str, with_ids: bool = False) -> Column:
    """Encode and decode in one pass: struct of token count, two digests, and ``ids``."""
    fields = ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    fields += ["ids array<int>"] * with_ids
    names = [f.split()[0] for f in fields]

    @F.pandas_udf(", ".join(fields))
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with _encoder(path, pattern) as encoder:
            for texts in batches:
                for part in slices(texts, _CHARS):
                    rows = []
                    for ids in encoder.encode(part):
                        decoded = encoder.table.decode(ids)
                        rows.append(
                            (
                                len(ids),
                                hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                                hashlib.sha256(decoded).hexdigest(),
                                *([ids.astype(np.int32)] if with_ids else []),
                            )
                        )
                    yield pd.DataFrame(rows, columns=names)

    return digest(text)


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no tokens and the digests of no bytes; repeated
    rows and null doc_ids are rows of their own; other columns are not read.
    """
    done = round_trip(F.col("text"), path, pattern).alias("_bpe")
    return docs.select("doc_id", done).select("doc_id", "_bpe.*")


def decodable(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Documents with all columns they came with, as decoded from their token ids.

    A null text stays null.
    """
    ids = bpe_ids(F.col("text"), path, pattern)
    text = F.when(F.col("text").isNotNull(), bpe_text(ids, path, pattern).cast("string"))
    return docs.withColumn("text", text)

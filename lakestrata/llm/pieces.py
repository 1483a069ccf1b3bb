"""Numbering of the distinct pieces of text that a task has seen.

Tasks do the costly work (hashing, splitting, merging) once per distinct piece
and handle a document as an array of piece numbers.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

# A space that neither starts nor ends a run of white space, or is the run's end
# in front of a text's end: pre-tokens may cross a cut made there.
_CROSSED = re.compile(r"\s (?:\s|\Z)")
# The spaces that no pre-token crosses, whatever stands elsewhere in the text.
_SAFE = re.compile(r"(?<!\s) | (?=\S)")


class Numbering(dict):
    """Numbers keys as they come up; ``fresh`` lists those since the last ``take``."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key):
        number = self[key] = len(self)
        self.fresh.append(key)
        return number

    def numbers(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def take(self) -> list:
        fresh, self.fresh = self.fresh, []
        return fresh


class Ragged:
    """Rows of varying length in one flat array, extended as pieces come up."""

    def __init__(self, dtype) -> None:
        self.flat = np.zeros(0, dtype)
        self.starts = np.zeros(0, np.int64)
        self.lens = np.zeros(0, np.int64)

    def extend(self, flat: np.ndarray, lens: np.ndarray) -> None:
        lens = np.asarray(lens, np.int64)
        starts = len(self.flat) + np.cumsum(lens) - lens
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])
        self.starts = np.concatenate([self.starts, starts])
        self.lens = np.concatenate([self.lens, lens])

    def without_last(self, rows: int) -> Ragged:
        """The rows but for so many at the end."""
        kept = len(self.lens) - rows
        shorter = Ragged(self.flat.dtype)
        shorter.extend(self.flat[: self.lens[:kept].sum()], self.lens[:kept])
        return shorter

    def gather(self, rows: np.ndarray) -> np.ndarray:
        """The chosen rows, one after the other."""
        lens = self.lens[rows]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[rows] - (ends - lens), lens) + np.arange(total)]


class TokenCache:
    """Token ids of texts by way of their distinct pieces.

    A text is cut in front of its spaces, but for those inside a run of white
    space, which a pre-token may cross.  ``encode`` maps pieces to (flat ids, ids
    per piece).  Pieces of more than ``longest`` characters are forgotten after
    the call that brings them.  Past ``limit`` pieces, or ``room`` characters and
    ids held, the cache starts anew, which bounds its memory.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        limit: int = 1_200_000,
        room: int = 32_000_000,
        longest: int = 200,
    ) -> None:
        self.encode, self.limit, self.room, self.longest = encode, limit, room, longest
        self._reset()

    def _reset(self) -> None:
        self.numbering, self.ids = Numbering(), Ragged(np.uint32)
        self.held = 0

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.numbering) > self.limit or self.held > self.room:
            self._reset()
        rows = self._rows(texts)
        fresh = self.numbering.take()
        if fresh:
            # A one-tuple is a piece that starts its text; others follow a space.
            self.ids.extend(*self.encode([p[0] if type(p) is tuple else " " + p for p in fresh]))
        found = [self.ids.gather(row) for row in rows]
        self._keep(fresh)
        return found

    def _rows(self, texts: list[str]) -> list[np.ndarray]:
        """Piece numbers of each text.

        Texts that may be cut at every space are cut and their pieces told apart
        all together, so that the numbering is asked once per distinct piece.
        """
        crossed = [_CROSSED.search(text) is not None for text in texts]
        plain = [text for text, odd in zip(texts, crossed) if not odd]
        lists = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        ends = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.dictionary_encode()
        codes = coded.indices.to_numpy()
        heads = ends[:-1]
        behind = np.ones(len(codes), bool)
        behind[heads] = False
        used = np.zeros(len(coded.dictionary), bool)
        used[codes[behind]] = True
        number = np.zeros(len(used), np.int64)
        pieces = coded.dictionary.filter(pa.array(used)).to_numpy(zero_copy_only=False)
        number[used] = self.numbering.numbers(pieces.tolist())
        numbers = number[codes]
        first = lists.values.take(pa.array(heads)).to_pylist()
        numbers[heads] = self.numbering.numbers([(head,) for head in first])
        cut = iter(np.split(numbers, ends[1:-1]))
        rows = []
        for text, odd in zip(texts, crossed):
            if odd:
                head, *tail = _SAFE.split(text)
                rows.append(self.numbering.numbers([(head,), *tail]))
            else:
                rows.append(next(cut))
        return rows

    def _keep(self, fresh: list) -> None:
        """Hold the new pieces for later texts, but for the long ones."""
        sizes = np.fromiter(map(len, fresh), np.int64, len(fresh))
        for k in [k for k, piece in enumerate(fresh) if type(piece) is tuple]:
            sizes[k] = len(fresh[k][0])
        short = sizes <= self.longest
        rows = np.arange(len(self.numbering) - len(fresh), len(self.numbering))[short]
        lens = self.ids.lens[rows]
        self.held += int(sizes[short].sum() + lens.sum())
        if not short.all():
            flat = self.ids.gather(rows)
            self.ids = self.ids.without_last(len(fresh))
            self.ids.extend(flat, lens)
            for piece in fresh:
                del self.numbering[piece]
            self.numbering.numbers([p for p, kept in zip(fresh, short) if kept])
            self.numbering.take()


def give_back() -> None:
    """Return freed memory of this Python worker to the system, where libc can."""
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(texts: pd.Series, chars: int = 32_000_000) -> Iterator[list[str]]:
    """A batch's texts (null: empty) in lists of about ``chars`` characters."""
    part: list[str] = []
    size = 0
    for text in texts:
        text = text if isinstance(text, str) else ""
        part.append(text)
        size += len(text) + 64
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part

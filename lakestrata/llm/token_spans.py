"""Alignment of two tokenizers by the spans of their tokens.

The first tokenizer (a byte-level vocabulary of the tokenizers library) gives
character offsets, the second (a sentencepiece model) the byte spans of its
immutable proto, which the installed version returns as ``proto``.  Spans are
coarse: several tokens inside one multibyte character share its span, and tokens
of a byte fallback have an empty one.  Where a span is not as wide as its token's
decoded bytes, these bytes refine it.  Offsets at which tokens of both end cut
the text into groups.

Texts are cut in front of every space that stands between two other characters;
no token of either vocabulary crosses such a cut, so tokens, groups and links of
a text are those of its distinct pieces, and a task works each out once.

How many documents of the corpus hold a pair of ids linked is counted per block
of documents first.  A block's pairs are numbered; its documents refer to these
numbers, and get the corpus counts back through their block.  Neither pairs nor
documents of the corpus meet in one task.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.pieces import Numbering, Ragged
from lakestrata.operators.staging import stage

# A space that no token of either tokenizer crosses, and a text in which all are.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile(r"(?<!\S) | (?!\S)")
# Pieces that keep their tokens when others stand around them.
_JOINABLE = re.compile(r" \S(?:.*\S)?", re.DOTALL)

_LINE = 8_000  # characters of pieces that are put into one line
_CALL = 500_000  # characters of lines that go to a tokenizer in one call
_WIDE = 4_096  # links of a group from which its repeated ids are counted first


def refined_ends(starts: np.ndarray, ends: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Byte ends of one line's tokens from their coarse spans and decoded widths.

    A span as wide as its token's bytes stands.  Others share a character; they
    end so many bytes after the last sound end as their tokens have bytes.
    """
    sound = ends - starts == widths
    if sound.all():
        return ends
    place = np.maximum.accumulate(np.where(sound, np.arange(len(ends)), -1))
    upto = np.cumsum(widths)
    base = np.where(place >= 0, ends[place] - upto[place], 0)
    return np.where(sound, ends, base + upto)


class FirstTokenizer:
    """A byte-level vocabulary of the tokenizers library; special strings are text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        of_letter = _byte_letters()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            known = all(letter in of_letter for letter in token)
            self.bytes[number] = (
                bytes(of_letter[letter] for letter in token) if known else token.encode()
            )
        self.widths = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))

    def spans(self, lines: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, byte starts, byte ends) of each line."""
        for line, found in zip(
            lines, self.tokenizer.encode_batch(lines, add_special_tokens=False)
        ):
            offsets = _rows_of(found.offsets, 2)
            if not line.isascii():
                points = np.frombuffer(line.encode("utf-32-le"), np.uint32)
                size = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
                offsets = np.append(0, np.cumsum(size))[offsets]
            yield np.array(found.ids, np.int64), offsets[:, 0], offsets[:, 1]


_PROTO = attrgetter("id", "begin", "end")


def _rows_of(tuples: Iterable[tuple[int, ...]], width: int) -> np.ndarray:
    return np.fromiter(chain.from_iterable(tuples), np.int64).reshape(-1, width)


def _byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for.

    Printable characters of Latin-1 stand for themselves, the other bytes, in
    order, for the code points from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class SecondTokenizer:
    """A sentencepiece model that puts a space in front of a text."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        count = self.model.get_piece_size()
        self.bytes = [
            bytes([int(piece[3:5], 16)])
            if self.model.is_byte(number)
            else piece.replace("▁", " ").encode()
            for number, piece in ((n, self.model.id_to_piece(n)) for n in range(count))
        ]
        crossing = [b for b in self.bytes if b" " in b.lstrip(b" ")]
        if crossing:
            raise ValueError(f"tokens cross words: {crossing[:3]}")
        self.widths = np.fromiter(map(len, self.bytes), np.int64, count)

    def spans(self, lines: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, byte starts, byte ends) of each line, whose first space the model adds."""
        texts = [line[1:] for line in lines]
        for found in self.model.encode(texts, return_type="proto", num_threads=1):
            cells = _rows_of(map(_PROTO, found.pieces), 3)
            starts, ends = cells[:, 1] + 1, cells[:, 2] + 1
            starts[:1] = 0
            yield cells[:, 0], starts, ends


class Aligner:
    """Tokens, groups and links of texts by way of their distinct pieces.

    Past ``limit`` pieces, or ``room`` characters of them, all are forgotten before
    the next texts, which bounds the memory held.
    """

    def __init__(
        self,
        first: FirstTokenizer,
        second: SecondTokenizer,
        limit: int = 400_000,
        room: int = 12_000_000,
    ) -> None:
        self.first, self.second, self.limit, self.room = first, second, limit, room
        self.base = len(second.widths)
        # Text of an id inside a group and as the last of its side.
        self.texts = [
            [np.array([f"{n}{mark}" for n in range(len(side.widths))], object) for mark in marks]
            for side, marks in ((first, ",|"), (second, ",;"))
        ]
        self._reset()

    def _reset(self) -> None:
        self.numbering = Numbering()
        self.held = 0
        self.groups: list[str] = []  # of a piece, as text
        # Of a piece: tokens of both, groups, links, and whether bytes are the text's.
        self.sums = np.zeros((0, 5), np.int64)
        self.pairs, self.times = Ragged(np.int64), Ragged(np.int64)

    def rows(self, texts: list[str]) -> list[np.ndarray]:
        """Piece numbers of each text, which hold until the next call; none for an empty one."""
        if len(self.numbering) > self.limit or self.held > self.room:
            self._reset()
        rows = []
        for text in texts:
            if not text:
                rows.append(np.zeros(0, np.int64))
                continue
            cut = _CUT.split(text) if _OTHER_SPACE.search(text) else text.split(" ")
            rows.append(self.numbering.numbers(cut))
        fresh = self.numbering.take()
        if fresh:
            self._learn([" " + piece for piece in fresh])
            self.held += sum(map(len, fresh))
        return rows

    def _learn(self, pieces: list[str]) -> None:
        lines, size = [], 0
        for piece in pieces:
            joinable = _JOINABLE.fullmatch(piece) is not None
            if not joinable or not size or size > _LINE:
                lines.append([piece])
                size = len(piece) if joinable else 0
            else:
                lines[-1].append(piece)
                size += len(piece)
        found = list(self._aligned(lines))
        self.groups += chain.from_iterable(f[0] for f in found)
        self.sums = np.concatenate([self.sums, *(f[1] for f in found)])
        lens = np.concatenate([f[4] for f in found])
        self.pairs.extend(np.concatenate([f[2] for f in found]), lens)
        self.times.extend(np.concatenate([f[3] for f in found]), lens)

    def _aligned(self, lines: list[list[str]]) -> Iterator[tuple]:
        """For each line of pieces what ``_pieces`` finds."""
        for some in _calls(lines):
            joined = ["".join(line) for line in some]
            spans = zip(joined, self.first.spans(joined), self.second.spans(joined))
            for line, (text, a, b) in zip(some, spans):
                raw = text.encode()
                if all(
                    b"".join(map(side.bytes.__getitem__, ids.tolist())) == raw
                    for side, (ids, _, _) in ((self.first, a), (self.second, b))
                ):
                    sizes = np.fromiter((len(p.encode()) for p in line), np.int64, len(line))
                    yield self._pieces(a, b, np.cumsum(sizes))
                elif len(line) > 1:  # one of the pieces: each on its own
                    yield from self._aligned([[piece] for piece in line])
                else:
                    none = np.zeros(0, np.int64)
                    yield [""], np.zeros((1, 5), np.int64), none, none, np.zeros(1, np.int64)

    def _pieces(self, a: tuple, b: tuple, piece_ends: np.ndarray) -> tuple:
        """Of the pieces of a line: groups as text, sums, pairs, their times, pairs in each.

        ``a`` and ``b`` are ids, coarse starts and coarse ends of the line's tokens.
        """
        ends_a, ends_b = (
            refined_ends(starts, ends, side.widths[ids])
            for side, (ids, starts, ends) in ((self.first, a), (self.second, b))
        )
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        upto_a = np.searchsorted(ends_a, cuts, side="right")
        upto_b = np.searchsorted(ends_b, cuts, side="right")
        n_a, n_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        pieces = np.arange(len(piece_ends))
        piece_of = np.searchsorted(piece_ends, cuts)
        upto = np.searchsorted(piece_of, pieces, side="right")
        first = np.append(0, upto[:-1])

        def per_piece(of_groups: np.ndarray) -> np.ndarray:
            total = np.append(0, np.cumsum(of_groups))
            return total[upto] - total[first]

        sums = [per_piece(n_a), per_piece(n_b), upto - first, per_piece(n_a * n_b)]
        # Each group's ids of the first side, then those of the second.
        texts = np.empty(len(a[0]) + len(b[0]), object)
        for ids, n, last, before, (inside, end) in (
            (a[0], n_a, upto_a - 1, upto_b - n_b, self.texts[0]),
            (b[0], n_b, upto_b - 1, upto_a, self.texts[1]),
        ):
            place = np.arange(len(ids)) + np.repeat(before, n)
            texts[place] = inside[ids]
            texts[place[last]] = end[ids[last]]
        texts, ends = texts.tolist(), (sums[0] + sums[1]).cumsum().tolist()
        groups = ["".join(texts[i:j]) for i, j in zip([0, *ends], ends)]
        pair, times, of = self._links(
            a[0], b[0], upto_a - n_a, upto_b - n_b, n_a, n_b, piece_of
        )
        lens = np.bincount(of, minlength=len(pieces))
        return groups, np.stack([*sums, np.ones_like(pieces)], axis=1), pair, times, lens

    def _links(self, a, b, from_a, from_b, n_a, n_b, piece_of):
        """Distinct (piece, id pair) with the number of links, by piece."""
        links = n_a * n_b
        usual = links <= _WIDE
        group = np.repeat(np.flatnonzero(usual), links[usual])
        inside = np.arange(len(group)) - np.repeat(
            np.cumsum(links[usual]) - links[usual], links[usual]
        )
        keys = [
            a[from_a[group] + inside // n_b[group]] * self.base
            + b[from_b[group] + inside % n_b[group]]
        ]
        counts, pieces = [np.ones(len(group), np.int64)], [piece_of[group]]
        for wide in np.flatnonzero(~usual).tolist():
            ids_a, times_a = np.unique(
                a[from_a[wide] : from_a[wide] + n_a[wide]], return_counts=True
            )
            ids_b, times_b = np.unique(
                b[from_b[wide] : from_b[wide] + n_b[wide]], return_counts=True
            )
            keys.append((ids_a[:, None] * self.base + ids_b).ravel())
            counts.append((times_a[:, None] * times_b).ravel())
            pieces.append(np.full(len(keys[-1]), piece_of[wide]))
        key, count, piece = map(np.concatenate, (keys, counts, pieces))
        order = np.lexsort((key, piece))
        key, count, piece = key[order], count[order], piece[order]
        new = np.flatnonzero(
            np.append(True, (key[1:] != key[:-1]) | (piece[1:] != piece[:-1]))[: len(key)]
        )
        return key[new], np.add.reduceat(count, new) if len(new) else count, piece[new]

    def sound(self, row: np.ndarray) -> bool:
        return bool(len(row)) and bool(self.sums[row, 4].all())

    def totals(self, row: np.ndarray) -> np.ndarray:
        """Tokens of both, groups and links of a text."""
        return self.sums[row, :4].sum(axis=0)

    def text_of_groups(self, row: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of both sides, group by group."""
        return "".join(map(self.groups.__getitem__, row.tolist()))[:-1]

    def linked(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of a text in order, and the links of each."""
        piece, copies = np.unique(row, return_counts=True)
        pairs = self.pairs.gather(piece)
        links = self.times.gather(piece) * np.repeat(copies, self.pairs.lens[piece])
        order = np.argsort(pairs, kind="stable")
        pairs, links = pairs[order], links[order]
        new = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)])
        return pairs[new], np.add.reduceat(links, new) if len(new) else links


def _calls(lines: list[list[str]]) -> Iterator[list[list[str]]]:
    """The lines in lists of about ``_CALL`` characters."""
    some, size = [], 0
    for line in lines:
        some.append(line)
        size += sum(map(len, line))
        if size >= _CALL:
            yield some
            some, size = [], 0
    if some:
        yield some


@lru_cache(maxsize=1)
def _tokenizers(first: str, second: str) -> tuple[FirstTokenizer, SecondTokenizer]:
    return FirstTokenizer(first), SecondTokenizer(second)


def align(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Spans of all groups: doc_id and, for each group, both lists of ids with the
    byte range in a space and the text.

    Texts that are null or empty, and those whose bytes one of the tokenizers does
    not keep, have no groups.  Repeated rows and null ids each give their own row.
    """

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokenizers(first, second)
        aligner = Aligner(a, b)
        for batch in batches:
            for ids, texts in _some(batch, 4_000_000):
                groups = []
                for row in aligner.rows(texts):
                    groups.append([])
                    if not aligner.sound(row):
                        continue
                    at = 0
                    for group in aligner.text_of_groups(row).split(";"):
                        left, right = (list(map(int, s.split(","))) for s in group.split("|"))
                        end = at + int(a.widths[left].sum())
                        groups[-1].append({"a": left, "b": right, "start": at, "end": end})
                        at = end
                kind = pa.list_(
                    pa.struct(
                        [
                            ("a", pa.list_(pa.int32())),
                            ("b", pa.list_(pa.int32())),
                            ("start", pa.int64()),
                            ("end", pa.int64()),
                        ]
                    )
                )
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(groups, kind)], ["doc_id", "groups"]
                )

    return _narrow(docs).mapInArrow(
        spans,
        "doc_id long, groups array<struct<a: array<int>, b: array<int>, start: long, end: long>>",
    )


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def _some(batch: pa.RecordBatch, chars: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts (null: empty) of a batch, about ``chars`` characters at a time."""
    ids, texts = batch.column(0), batch.column(1)
    first, size = 0, 0
    for at, length in enumerate(map(len, (t.as_py() or "" for t in texts))):
        size += length + 64
        if size >= chars or at + 1 == len(texts):
            yield (
                ids.slice(first, at + 1 - first),
                [t or "" for t in texts.slice(first, at + 1 - first).to_pylist()],
            )
            first, size = at + 1, 0


_BLOCK_ROWS = (
    "block long, doc_id long, is_block boolean, n_a long, n_b long, n_groups long, "
    "n_links long, groups_sha256 string, pairs array<long>, numbers array<int>, times array<int>"
)


def _ragged(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int64), *rows])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))


def blocks(docs: DataFrame, first: str, second: str, chars: int = 24_000_000) -> DataFrame:
    """Digests of all documents, and the linked pairs of each block of them.

    A block is what a task reads up to ``chars`` characters; a longer text is a
    block of its own.  A block's own row lists its distinct pairs with the number
    of its documents that hold each; a document's row refers to them by place.
    """

    def close(block: int, rows: list[tuple]) -> pa.RecordBatch:
        none = np.zeros(0, np.int64)
        held = np.concatenate([none, *(r[3] for r in rows)])
        pairs, numbers = np.unique(held, return_inverse=True)
        in_docs = np.bincount(numbers, minlength=len(pairs))
        cuts = np.cumsum([len(r[3]) for r in rows])[:-1]
        sums = np.array([r[1] for r in rows], np.int64).reshape(-1, 4)
        sums = np.concatenate([sums, np.zeros((1, 4), np.int64)])
        count = len(rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(count + 1, block, np.int64)),
                pa.array([*(r[0] for r in rows), None], pa.int64()),
                pa.array([False] * count + [True]),
                *(pa.array(sums[:, k]) for k in range(4)),
                pa.array([*(r[2] for r in rows), ""], pa.string()),
                _ragged([none] * count + [pairs], pa.int64()),
                _ragged([*np.split(numbers, cuts), none], pa.int32()),
                _ragged([*(r[4] for r in rows), in_docs], pa.int32()),
            ],
            names=[c.split()[0] for c in _BLOCK_ROWS.split(", ")],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*_tokenizers(first, second))
        block, size, rows = TaskContext.get().partitionId() << 24, 0, []
        nothing = np.zeros(0, np.int64)
        for batch in batches:
            for ids, texts in _some(batch, 4_000_000):
                for doc_id, text, row in zip(ids.to_pylist(), texts, aligner.rows(texts)):
                    if aligner.sound(row):
                        digest = hashlib.sha256(aligner.text_of_groups(row).encode()).hexdigest()
                        rows.append((doc_id, aligner.totals(row), digest, *aligner.linked(row)))
                    else:
                        rows.append((doc_id, np.zeros(4, np.int64), "", nothing, nothing))
                    size += len(text) + 64
                    if size >= chars:
                        yield close(block, rows)
                        block, size, rows = block + 1, 0, []
        if rows:
            yield close(block, rows)

    return stage(_narrow(docs).mapInArrow(work, _BLOCK_ROWS), "aligned")


def pair_counts(block_rows: DataFrame, width: int) -> DataFrame:
    """(of_block, number, count, best): the corpus count of each pair of a block, and
    whether no other pair of its first id has a higher one.

    ``width`` is the number of ids of the second tokenizer.
    """
    held = block_rows.where("is_block").selectExpr(
        "block", "posexplode(arrays_zip(pairs, times)) AS (number, cell)"
    ).selectExpr("block", "number", "cell.pairs AS pair", "cell.times AS docs")
    counts = stage(held.groupBy("pair").agg(F.sum("docs").alias("count")), "pair-counts")
    first_id = F.expr(f"pair div {width}")
    highest = counts.groupBy(first_id.alias("first_id")).agg(F.max("count").alias("highest"))
    judged = counts.withColumn("first_id", first_id).join(highest, "first_id")
    return held.join(judged, "pair").selectExpr(
        "block AS of_block", "number", "count", "count = highest AS best"
    )


_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
    "count_sum long, groups_sha256 string"
)


def alignment_counts(
    docs: DataFrame, first: str, second: str, chars: int = 24_000_000
) -> DataFrame:
    """Per document: tokens of both, groups and links, the links whose pair has the
    highest corpus count of its first id (ties included), the sum of the counts
    over links, and a digest of the groups.

    A pair's count is the number of documents that hold it linked.  Texts that are
    null or empty, and those whose bytes one of the tokenizers does not keep, have
    zeros and an empty digest.  Repeated rows count as documents of their own; null
    ids stay.  Further columns are left out; an empty table gives an empty result.
    """
    width = len(SecondTokenizer(second).widths)
    rows = blocks(docs, first, second, chars)
    counts = pair_counts(rows, width)

    def back(documents: pa.Table, judged: pa.Table) -> pa.Table:
        count = np.zeros(judged.num_rows, np.int64)
        best = np.zeros(judged.num_rows, np.int64)
        number = judged.column("number").to_numpy()
        count[number] = judged.column("count").to_numpy()
        best[number] = judged.column("best").to_numpy(zero_copy_only=False)
        held = documents.column("numbers").combine_chunks()
        at = held.flatten().to_numpy()
        times = documents.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
        ends = np.cumsum(held.value_lengths().to_numpy())

        def per_document(values: np.ndarray) -> pa.Array:
            total = np.append(0, np.cumsum(values * times))
            return pa.array(np.diff(total[ends], prepend=0))

        kept = documents.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        kept = kept.append_column("n_best", per_document(best[at]))
        kept = kept.append_column("count_sum", per_document(count[at]))
        return kept.append_column("groups_sha256", documents.column("groups_sha256"))

    documents = rows.where("NOT is_block").drop("is_block", "pairs")
    return (
        documents.groupBy("block")
        .cogroup(counts.groupBy("of_block"))
        .applyInArrow(back, _RESULT)
    )

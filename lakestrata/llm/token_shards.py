"""Token ids in wavelet-matrix files, one for each shard of documents.

A shard's file holds one bit plane for each bit of an id, cut into blocks that are
compressed one by one.  In front of them stand the documents, where each block
lies, and the ones of its plane before it.  Access to a token, the count of an id
and the place of its k-th occurrence open the blocks they touch, a few per plane;
only reading all ids opens every block.  Shards follow the order of doc_id
(a BIGINT) and are written and read by Spark.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, compress
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakestrata.llm.pieces import TokenCache, slices
from lakestrata.session import shared_folder

_MAGIC = b"WVLT"
_BLOCK = 4096  # bytes of a plane that are compressed together and have a count of ones
_BITS = 8 * _BLOCK
_PLAIN = re.compile(r" \S(?:.*\S)?", re.DOTALL)
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)

_LINE = 60  # pieces that are encoded as one line: the library slows down with longer ones

_STRIDE = 2**16  # ids that are moved together, so that their places stay in the processor's cache

SHARD_SCHEMA = "part int, number int, n_docs long, n_tokens long, file binary"


def _places(ones: np.ndarray, zeros: int) -> Iterator[tuple[int, np.ndarray, slice]]:
    """Where ids lie above a plane and below it: first place of a stride, places from there
    on, and the run of places that they take below, first for zeros and then for ones."""
    low, high = 0, zeros
    for at in range(0, len(ones), _STRIDE):
        stride = ones[at : at + _STRIDE]
        at_zeros, at_ones = np.flatnonzero(~stride), np.flatnonzero(stride)
        yield at, at_zeros, slice(low, low + len(at_zeros))
        yield at, at_ones, slice(high, high + len(at_ones))
        low, high = low + len(at_zeros), high + len(at_ones)


class WaveletMatrix:
    """Ids below ``2 ** bits``; the highest bit's plane comes first.

    ``block`` gives the bytes of a plane's block; ``zeros`` counts the zeros of each
    plane, ``before`` the ones in front of each block and, last, of the whole plane.
    """

    def __init__(
        self,
        size: int,
        zeros: np.ndarray,
        before: np.ndarray,
        block: Callable[[int, int], np.ndarray],
    ) -> None:
        self.size, self.zeros, self.before, self.block = size, zeros, before, block
        self.bits, self.blocks = len(zeros), before.shape[1] - 1

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        width = -(-max(len(ids), 1) // _BITS) * _BLOCK
        planes = np.zeros((bits, width), np.uint8)
        zeros = np.zeros(bits, np.int64)
        current = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        for level in range(bits):
            ones = (current & current.dtype.type(1 << (bits - 1 - level))) != 0
            packed = np.packbits(ones)
            planes[level, : len(packed)] = packed
            zeros[level] = len(ones) - np.count_nonzero(ones)
            if level < bits - 1:
                below = np.empty_like(current)
                for at, places, run in _places(ones, int(zeros[level])):
                    current[at : at + _STRIDE].take(places, out=below[run], mode="clip")
                current = below
        blocks = planes.reshape(bits, -1, _BLOCK)
        ones = np.bitwise_count(blocks).sum(axis=2, dtype=np.int64)
        before = np.concatenate([np.zeros((bits, 1), np.int64), np.cumsum(ones, axis=1)], axis=1)
        return cls(len(ids), zeros, before, lambda level, number: blocks[level, number])

    def _look(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits of a plane at the given places (past its end: 0), and ones before them."""
        number, within = np.divmod(at, _BITS)
        bits, rank = np.zeros(len(at), np.int64), self.before[level][number]
        for touched in np.unique(number[number < self.blocks]):
            here = number == touched
            block = self.block(level, int(touched))
            byte, bit = within[here] >> 3, within[here] & 7
            ahead = np.cumsum(_ONES[block], dtype=np.int64) - _ONES[block]
            value = block[byte].astype(np.int64)
            rank[here] += ahead[byte] + _ONES[value & (0xFF00 >> bit) & 0xFF]
            bits[here] = value >> (7 - bit) & 1
        return bits, rank

    def _down(self, level: int, at: np.ndarray, rank: np.ndarray, ones) -> np.ndarray:
        return np.where(ones, self.zeros[level] + rank, at - rank)

    def access(self, at: np.ndarray) -> np.ndarray:
        """Ids at the given places."""
        at = np.asarray(at, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.size):
            raise IndexError("place outside the shard")
        ids = np.zeros(len(at), np.uint32)
        for level in range(self.bits):
            bit, rank = self._look(level, at)
            ids = (ids << np.uint32(1)) | bit.astype(np.uint32)
            at = self._down(level, at, rank, bit == 1)
        return ids

    def all_ids(self) -> np.ndarray:
        """Every id, from the last plane up: each undoes the parting of the one above."""
        ids = np.zeros(self.size, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            plane = np.concatenate([self.block(level, k) for k in range(self.blocks)])
            ones = np.unpackbits(plane, count=self.size).view(bool)
            ids[self.zeros[level] :] |= ids.dtype.type(1 << (self.bits - 1 - level))
            above = np.empty_like(ids)
            for at, places, run in _places(ones, int(self.zeros[level])):
                above[at : at + _STRIDE][places] = ids[run]
            ids = above
        return ids

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int]:
        ends = np.array([start, stop], np.int64)
        for level in range(self.bits):
            _, rank = self._look(level, ends)
            ends = self._down(level, ends, rank, bool(token >> (self.bits - 1 - level) & 1))
        return int(ends[0]), int(ends[1])

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of an id from ``start`` up to ``stop``."""
        if not 0 <= token < 1 << self.bits:
            return 0
        first, last = self._range(token, start, self.size if stop is None else stop)
        return last - first

    def occurrence(self, token: int, number: int) -> int:
        """Place of the ``number``-th occurrence of an id, counted from 0."""
        if not 0 <= number < self.count(token):
            raise IndexError("no such occurrence")
        at = self._range(token, 0, self.size)[0] + number
        for level in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - level) & 1
            at = self._select(level, one, at - (int(self.zeros[level]) if one else 0))
        return at

    def _select(self, level: int, bit: int, number: int) -> int:
        """Place of a plane's ``number``-th one or zero."""
        ones = self.before[level]
        counts = ones if bit else np.arange(len(ones)) * _BITS - ones
        block = int(np.searchsorted(counts, number, side="right")) - 1
        bits = np.unpackbits(self.block(level, block))
        return block * _BITS + int(np.flatnonzero(bits == bit)[number - counts[block]])


def pack_shard(doc_ids: list[int | None], lens: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    """One shard's file: a header, the documents and the blocks' places and counts, the blocks."""
    matrix = WaveletMatrix.build(ids, bits)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    blocks = [
        squeeze(matrix.block(level, number).tobytes())
        for level in range(bits)
        for number in range(matrix.blocks)
    ]
    front = squeeze(
        b"".join(
            (
                np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                np.asarray(lens, "<i8").tobytes(),
                matrix.before.astype("<i8").tobytes(),
                np.cumsum([0, *map(len, blocks)]).astype("<i8").tobytes(),
            )
        )
    )
    head = {
        "size": matrix.size,
        "bits": bits,
        "blocks": matrix.blocks,
        "docs": len(doc_ids),
        "front": len(front),
        "zeros": matrix.zeros.tolist(),
        "unnamed": [k for k, d in enumerate(doc_ids) if d is None],
    }
    header = json.dumps(head).encode()
    return b"".join((_MAGIC, struct.pack("<I", len(header)), header, front, *blocks))


class Shard:
    """A shard's file.  ``opened`` counts the blocks that were decompressed so far."""

    def __init__(self, file: bytes) -> None:
        if file[:4] != _MAGIC:
            raise ValueError("not a token shard")
        (length,) = struct.unpack_from("<I", file, 4)
        head = json.loads(file[8 : 8 + length])
        unpack = zstandard.ZstdDecompressor()
        body = 8 + length + head["front"]
        front = np.frombuffer(unpack.decompress(file[8 + length : body]), "<i8")
        docs, bits, blocks = head["docs"], head["bits"], head["blocks"]
        unnamed = set(head["unnamed"])
        self.doc_ids = [None if k in unnamed else d for k, d in enumerate(front[:docs].tolist())]
        self.lens = front[docs : 2 * docs]
        counts = 2 * docs + bits * (blocks + 1)
        before = front[2 * docs : counts].reshape(bits, blocks + 1)
        places = body + front[counts:]
        self.opened = 0

        held: dict[int, tuple[int, np.ndarray]] = {}  # the last block of each plane

        def block(level: int, number: int) -> np.ndarray:
            if level not in held or held[level][0] != number:
                self.opened += 1
                at = level * blocks + number
                found = unpack.decompress(file[places[at] : places[at + 1]])
                held[level] = number, np.frombuffer(found, np.uint8)
            return held[level][1]

        self.tokens = WaveletMatrix(head["size"], np.array(head["zeros"], np.int64), before, block)


class LibraryEncoder:
    """Texts to ids with a tokenizer file, each distinct piece encoded once."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.bits = max(1, (self.tokenizer.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        tokens = self.tokenizer.get_vocab(with_added_tokens=True)
        # In a byte-level vocabulary a token has one character for each byte.
        self._bytes = np.zeros(max(tokens.values()) + 1, np.int64)
        for token, number in tokens.items():
            self._bytes[number] = len(token)
        self._cache = TokenCache(self._pieces)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and ids per text."""
        ids = [
            e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, lens.sum()), lens

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A space between two characters that are none always starts a pre-token, so
        pieces without white space at their ends are encoded as lines of many; bytes
        tell where each one's ids end."""
        plain = np.fromiter(map(bool, map(_PLAIN.fullmatch, pieces)), bool, len(pieces))
        joined = list(compress(pieces, plain))
        lens = np.zeros(len(pieces), np.int64)
        rest, lens[~plain] = self._ids(list(compress(pieces, ~plain)))
        lines = ["".join(joined[at : at + _LINE]) for at in range(0, len(joined), _LINE)]
        ids, _ = self._ids(lines)
        ends = np.cumsum(pc.binary_length(pa.array(joined, pa.large_string())).to_numpy())
        upto = np.searchsorted(np.cumsum(self._bytes[ids]), ends, side="right")
        lens[plain] = np.diff(upto, prepend=0)
        flat = np.empty(len(ids) + len(rest), np.uint32)
        of_plain = np.repeat(plain, lens)
        flat[of_plain], flat[~of_plain] = ids, rest
        return flat, lens

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self._cache.encoded(texts)


@lru_cache(maxsize=1)
def _encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def write_shards(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str, shard_tokens: int = 2**21
) -> None:
    """Encode all documents in ascending doc_id order into files under ``folder``.

    A shard ends with the document that brings it to ``shard_tokens``.  Null texts
    are empty; null ids come first; repeated ids are ordered by their text.
    """

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer)
        part, number = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        rows: list[np.ndarray] = []
        size = 0

        def close() -> pd.DataFrame:
            lens = np.fromiter(map(len, rows), np.int64, len(rows))
            file = pack_shard(doc_ids, lens, np.concatenate(rows), encoder.bits)
            return pd.DataFrame(
                {
                    "part": [part],
                    "number": [number],
                    "n_docs": [len(rows)],
                    "n_tokens": [int(lens.sum())],
                    "file": [file],
                }
            )

        for batch in batches:
            names = iter(batch["doc_id"])
            for texts in slices(batch["text"], 8_000_000):
                for ids in encoder.encode(texts):
                    name = next(names)
                    doc_ids.append(None if pd.isna(name) else int(name))
                    rows.append(np.append(ids, np.uint32(end_id)))
                    size += len(ids) + 1
                    if size >= shard_tokens:
                        yield close()
                        number, doc_ids, rows, size = number + 1, [], [], 0
        if rows:
            yield close()

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    (
        # Ids as text keep nulls apart from numbers on the way to pandas.
        ordered.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
        .mapInPandas(shards, SHARD_SCHEMA)
        .write.option("maxRecordsPerFile", 1)
        .option("compression", "none")
        .parquet(folder)
    )


def _check_ends(shard: Shard, ids: np.ndarray, ends: np.ndarray) -> None:
    """The documents' last ids by access, and the count of one of them by rank."""
    last = shard.tokens.access(ends - 1)
    if (last != ids[ends - 1]).any() or (
        shard.tokens.count(int(last[-1])) != np.count_nonzero(ids == last[-1])
    ):
        raise ValueError("planes and counts of a token shard do not fit together")


def read_documents(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, number, file in zip(batch["part"], batch["number"], batch["file"]):
                shard = Shard(file)
                ids = shard.tokens.all_ids().astype("<u4")
                ends = np.cumsum(shard.lens)
                _check_ends(shard, ids, ends)
                crcs = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends, shard.lens)]
                yield pd.DataFrame(
                    {
                        "part": part,
                        "number": number,
                        "doc_id": pd.array(shard.doc_ids, dtype="Int64"),
                        "within": ends - shard.lens,
                        "n_tokens": shard.lens,
                        "ids_crc32": crcs,
                    }
                )

    files = spark.read.schema(SHARD_SCHEMA).parquet(folder)
    documents = files.select("part", "number", "file").mapInPandas(
        unpack,
        "part int, number int, doc_id long, within long, n_tokens long, ids_crc32 long",
    )
    return documents.join(shard_starts(files), ["part", "number"]).select(
        "doc_id", (F.col("starts") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def shard_starts(files: DataFrame) -> DataFrame:
    """Ids in front of each shard: inside its part, and in the parts before."""
    ahead = W.rowsBetween(W.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    sizes = files.select("part", "number", "n_tokens")
    inside = sizes.withColumn(
        "inside",
        F.coalesce(
            F.sum("n_tokens").over(ahead.partitionBy("part").orderBy("number")), none
        ),
    )
    # One row for each task that wrote.
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    parts = parts.select(
        "part", F.coalesce(F.sum("tokens").over(ahead.orderBy("part")), none).alias("earlier")
    )
    return inside.join(parts, "part").select(
        "part", "number", (F.col("inside") + F.col("earlier")).alias("starts")
    )


def token_file_digests(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write shards of all documents, read them back: one row per document."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/token-shards/{uuid4().hex}"
    write_shards(docs, tokenizer, end_id, folder)
    return read_documents(spark, folder)

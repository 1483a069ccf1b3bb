"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring of 64-bit hashes.  A key belongs to the
next point clockwise; where that point's shard is full, to the next one whose
shard is not.  Which rows stay and which go on is settled by counts alone: keys
between two points share their way round the ring, so the points' counts (their
number is a parameter) say how many rows of each arc every shard takes, and a
row's rank in its arc says which of them it is.  Rows never meet in one task.

Any order of columns and any further columns pass through; the names of the
result win over columns of the same name.  A null id is one key as any other.
Rows of one id share an arc; whole arcs of copies are spread like others once a
shard is full.  Empty tables give an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakestrata.operators.staging import stage

_SEGMENTS = "arc long, first long, upto long, shard int, first_slot long, steps int"


@dataclass(frozen=True)
class Ring:
    """``points`` virtual nodes for each of ``shards`` shards.

    A shard's points depend on its number alone, so a ring of one more shard has
    all the points of the smaller one.
    """

    shards: int
    points: int = 128

    def arcs(self) -> tuple[np.ndarray, np.ndarray]:
        """(ring position, shard) of all points in ring order."""
        places = [
            (int.from_bytes(_digest(f"{shard}:{point}"), "little", signed=True), shard)
            for shard in range(self.shards)
            for point in range(self.points)
        ]
        places.sort()
        return (
            np.array([place for place, _ in places], np.int64),
            np.array([shard for _, shard in places], np.int64),
        )


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode(), digest_size=8).digest()


def capacities(total: int, shards: int, slack: float = 0.0) -> np.ndarray:
    """Rows each shard takes at most.

    Without slack all shards end full, so their counts are at most one apart.
    With slack a shard takes that share above the mean, and fewer keys move when
    the ring changes.
    """
    if slack > 0:
        return np.full(shards, int(np.ceil((1 + slack) * total / shards)), np.int64)
    return total // shards + (np.arange(shards) < total % shards).astype(np.int64)


def spill(counts: np.ndarray, owners: np.ndarray, room: np.ndarray) -> list[tuple]:
    """(arc, first rank, rank after the last, shard, first slot, steps) of all rows.

    Round by round every arc's remaining rows ask the shard they have come to; it
    takes them in ring order up to its room.  The rest goes on clockwise to the
    next point whose shard has room.  Each round but the last fills a shard, and a
    shard splits one arc at most, so there are no more segments than points and
    shards together.
    """
    free, taken = room.astype(np.int64).copy(), np.zeros(len(room), np.int64)
    if counts.sum() > free.sum():
        raise ValueError("the shards have no room for all rows")
    waiting = [(arc, arc, 0, 0) for arc in np.flatnonzero(counts).tolist()]
    segments = []
    while waiting:
        rest = []
        for arc, at, first, steps in waiting:
            shard = int(owners[at])
            some = min(int(counts[arc]) - first, int(free[shard]))
            if some:
                segments.append((arc, first, first + some, shard, int(taken[shard]), steps))
                free[shard] -= some
                taken[shard] += some
            if first + some < counts[arc]:
                rest.append((arc, at, first + some, steps))
        onward = _next_with_room(free[owners] > 0) if rest else None
        waiting = [
            (arc, int(onward[at]), first, steps + int(onward[at] - at) % len(owners))
            for arc, at, first, steps in rest
        ]
    return segments


def _next_with_room(has_room: np.ndarray) -> np.ndarray:
    """For each point the next one, itself included, whose shard has room."""
    size = len(has_room)
    twice = np.where(np.tile(has_room, 2), np.arange(2 * size), 2 * size)
    return np.minimum.accumulate(twice[::-1])[::-1][:size] % size


def placed(docs: DataFrame, ring: Ring, key: str = "doc_id") -> DataFrame:
    """Each row's arc, and its place among the rows of that arc in its task.

    Written once: a rank stays what it is whatever is read again later.
    """
    positions, _ = ring.arcs()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(len(positions), np.int64)
        for batch in batches:
            hashes = batch.column(batch.schema.get_field_index("_hash")).to_numpy()
            arc = np.searchsorted(positions, hashes) % len(positions)
            order = np.argsort(arc, kind="stable")
            starts = np.flatnonzero(np.diff(arc[order], prepend=-1))
            rank = np.empty(len(arc), np.int64)
            rank[order] = np.arange(len(arc)) - np.repeat(
                starts, np.diff(starts, append=len(arc))
            )
            rank += seen[arc]
            seen += np.bincount(arc, minlength=len(seen))
            columns = [*batch.columns[:-1], pa.array(arc), pa.array(rank)]
            names = [*batch.schema.names[:-1], "_arc", "_place"]
            columns.append(pa.array(np.full(len(arc), part, np.int64)))
            yield pa.RecordBatch.from_arrays(columns, [*names, "_part"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)
    hashed = docs.withColumn("_hash", F.xxhash64(F.col(key).cast("string")))
    return stage(
        hashed.mapInArrow(place, f"{schema}, _arc long, _place long, _part long"), "ring"
    )


def assign(docs: DataFrame, ring: Ring, key: str = "doc_id", slack: float = 0.0) -> DataFrame:
    """``docs`` with ``shard``, ``slot`` (gapless from 0 in a shard), the shard its
    key meets first on the ring (``home_shard``) and the points it went on (``steps``).

    Pass the key and what else is needed for the choice; long columns are better
    joined back by the key afterwards.
    """
    names = [c for c in docs.columns if c not in ("shard", "slot", "home_shard", "steps")]
    rows = placed(docs.select(*names), ring, key)
    _, owners = ring.arcs()
    counts = rows.groupBy("_arc", "_part").agg(F.count("*").alias("_rows"))
    before = W.partitionBy("_arc").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = stage(
        counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))),
        "ring-counts",
    )
    totals = np.zeros(len(owners), np.int64)
    # One row for each point of the ring.
    for arc, rows_of_arc in counts.groupBy("_arc").agg(F.sum("_rows")).collect():
        totals[arc] = rows_of_arc
    room = capacities(int(totals.sum()), ring.shards, slack)
    segments = [
        (*segment, int(owners[segment[0]])) for segment in spill(totals, owners, room)
    ]
    bounded = docs.sparkSession.createDataFrame(segments, f"{_SEGMENTS}, home_shard int")
    rank = F.col("_before") + F.col("_place")
    ranked = (
        rows.join(counts.drop("_rows"), ["_arc", "_part"])
        .withColumn("_rank", rank)
        .select(*names, "_arc", "_rank")
    )
    prefixed = bounded.select(*[F.col(c).alias(f"_to_{c}") for c in bounded.columns])
    return ranked.join(
        F.broadcast(prefixed),  # no more rows than points and shards together
        (F.col("_arc") == F.col("_to_arc"))
        & (F.col("_rank") >= F.col("_to_first"))
        & (F.col("_rank") < F.col("_to_upto")),
    ).select(
        *names,
        F.col("_to_shard").alias("shard"),
        (F.col("_to_first_slot") + F.col("_rank") - F.col("_to_first")).alias("slot"),
        F.col("_to_home_shard").alias("home_shard"),
        F.col("_to_steps").alias("steps"),
    )


def shard_documents(docs: DataFrame, shards: int = 40, points: int = 128) -> DataFrame:
    """Every document with its shard under the law ``rows``: counts at most one apart.

    ``size`` is the text's UTF-8 bytes and 16 more, ``text_crc32`` its checksum; a
    null text counts as empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    found = assign(narrow, Ring(shards, points))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "home_shard",
        "steps",
    )

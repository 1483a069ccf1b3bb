"""Trie of conversation prefixes by splitters and their skeleton.

A conversation is a path of turns, each turn 16 bytes of its digest, so that the
byte order of paths is the order of the trie.  Splitters from a bounded sample
cut the ordered (path, id) into shards.  A node whose members lie in several
shards is a prefix of a splitter between them: these nodes are the skeleton, which
every task knows.  A sorted shard finishes all other nodes in one pass with a
stack; of skeleton nodes it gives partial aggregates, which are reduced by node
and then summed up along the skeleton.

Copies of one path are told apart by their ids, so a path that very many
conversations share is cut like any other.  A task holds a path of its rows at a
time, 20 bytes for each turn.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.staging import stage

_TURN = 16  # bytes of a turn in a path
_CHUNK = 65_536  # bytes of ids that a shard hands on at a time

_ROWS = (
    "kind string, conv_id long, depth long, parent_conv_id long, parent binary, node binary, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, words long, "
    "ends_sha256 string, shard long, chunk long, ends binary"
)
_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)


def turn_digest(role: Column, text: Column) -> Column:
    """32 hexadecimal digits that tell turns apart, whatever stands in the texts."""
    whole = F.concat(F.length(role).cast("string"), F.lit(" "), role, text)
    return F.substring(F.sha2(whole, 256), 1, 2 * _TURN)


def own_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, base, turns): each conversation's turns in order, as digest and words.

    Turns are ordered by ``turn``, null first, and by digest where it is the same;
    repeated rows are turns of their own.  Null roles and texts are empty.  Rows
    without a conv_id belong to no conversation and have no part in the result.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    conv_id = F.col("conv_id").cast("long")
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        conv_id.alias("conv_id"),
        (conv_id - conv_id % 20).alias("base"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            turn_digest(role, text).alias("digest"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
        ).alias("cell"),
    )
    # By base, which the rebuilding joins on: one shuffle serves both.
    return (
        turns.repartition("base")
        .groupBy("base", "conv_id")
        .agg(F.sort_array(F.collect_list("cell")).alias("turns"))
    )


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, words) of every conversation, its head taken from its base.

    Conversation c has the first h original turns of c - c % 20 and its own turns
    after its first h, h being crc32 of its decimal id modulo 4.
    """
    own = own_turns(conversations)
    heads = own.where("conv_id = base").select("base", F.slice("turns", 1, 3).alias("head"))
    taken = F.crc32(F.col("conv_id").cast("string")) % 4
    turns = F.concat(
        F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("taken")),
        F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns"), F.lit(1))),
    )
    return (
        own.join(heads, "base", "left")
        .withColumn("taken", taken.cast("int"))
        .select("conv_id", turns.alias("turns"))
        .select(
            "conv_id",
            F.unhex(F.array_join("turns.digest", "")).alias("path"),
            F.col("turns.words").alias("words"),
        )
    )


def splitters(paths: DataFrame, shards: int, per_shard: int = 20) -> list[tuple[bytes, int]]:
    """At most ``shards`` - 1 cuts of the ordered (path, conv_id).

    Taken from the ``per_shard`` conversations for each shard whose ids have the
    least hashes.  They only balance the shards.  A cut is as short as tells its
    neighbours in the sample apart.
    """
    order = F.xxhash64("conv_id")
    sample = paths.select("path", "conv_id").orderBy(order, "conv_id").limit(shards * per_shard)
    rows = sorted((bytes(path), conv_id) for path, conv_id in sample.collect())
    cuts = []
    for k in range(1, shards):
        at = k * len(rows) // shards
        if not 0 < at < len(rows):
            continue
        before, after = rows[at - 1][0], rows[at][0]
        if before == after:
            cut = rows[at]
        else:
            cut = (after[: (_shared(before, after) + 1) * _TURN], -(2**63))
        if not cuts or cut > cuts[-1]:
            cuts.append(cut)
    return cuts


def _shared(a: bytes, b: bytes) -> int:
    """Turns two paths have in common at their start."""
    limit = min(len(a), len(b)) // _TURN
    if a[: limit * _TURN] == b[: limit * _TURN]:
        return limit
    low, high = 0, limit  # the first ``low`` turns are equal, the first ``high`` are not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * _TURN : middle * _TURN] == b[low * _TURN : middle * _TURN]:
            low = middle
        else:
            high = middle
    return low


def _child(node: bytes, turn: bytes) -> bytes:
    """A node's key: a digest of its parent's key and its own turn; the root's is empty."""
    return hashlib.blake2b(node + turn, digest_size=_TURN).digest()


def skeleton(cuts: list[tuple[bytes, int]]) -> dict[bytes, bytes | None]:
    """Parents of the root and of all prefixes of the splitter paths, by key."""
    parents: dict[bytes, bytes | None] = {b"": None}
    for path, _ in cuts:
        node = b""
        for at in range(0, len(path), _TURN):
            above, node = node, _child(node, path[at : at + _TURN])
            parents[node] = above
    return parents


@dataclass(slots=True)
class _Open:
    """A node on the way from the root to the present row."""

    node: bytes | None  # the key, of skeleton nodes only
    words: int
    conv_id: int
    n_convs: int = 0
    n_children: int = 0
    n_leaves: int = 0
    saved: int = 0
    hashed: object = None
    ends: list[bytes] = field(default_factory=list)
    ends_size: int = 0
    chunk: int = 0
    finished: list[dict] = field(default_factory=list)


class _ShardPass:
    """One pass over a shard in order: an open node for each turn of the present path."""

    def __init__(self, shard: int, skeleton_nodes: dict[bytes, bytes | None]) -> None:
        self.shard, self.skeleton = shard, skeleton_nodes
        self.path, self.open, self.out = b"", [], []

    def add(self, conv_id: int, path: bytes, words: list[int]) -> None:
        if not self.open:
            self.open.append(_Open(b"", 0, conv_id))
        shared = _shared(self.path, path)
        while len(self.open) > shared + 1:
            self._close()
        for depth in range(shared + 1, len(path) // _TURN + 1):
            node = None
            if self.open[-1].node is not None:
                turn = path[(depth - 1) * _TURN : depth * _TURN]
                node = _child(self.open[-1].node, turn)
            known = node if node in self.skeleton else None
            self.open.append(_Open(known, words[depth - 1], conv_id))
        self.path = path
        # An open node's members are counted where it closes: those of its children
        # and those that end in it.
        self._end(self.open[-1], conv_id)

    def _end(self, last: _Open, conv_id: int) -> None:
        last.n_convs += 1
        last.conv_id = min(last.conv_id, conv_id)
        text = str(conv_id).encode()
        if last.node is None:
            if last.hashed is None:
                last.hashed = hashlib.sha256(text)
            else:
                last.hashed.update(b"," + text)
            return
        last.ends.append(text)
        last.ends_size += len(text)
        if last.ends_size >= _CHUNK:
            self._hand_on(last)

    def _hand_on(self, node: _Open) -> None:
        if node.ends:
            self.out.append(
                {
                    "kind": "ends",
                    "node": node.node,
                    "shard": self.shard,
                    "chunk": node.chunk,
                    "ends": b",".join(node.ends),
                }
            )
            node.ends, node.ends_size, node.chunk = [], 0, node.chunk + 1

    def _close(self) -> None:
        node, depth = self.open.pop(), len(self.open)
        parent = self.open[-1] if self.open else None
        if parent is not None:
            parent.n_convs += node.n_convs
            parent.conv_id = min(parent.conv_id, node.conv_id)
        if node.node is not None:
            self._hand_on(node)
            self.out.append(
                {
                    "kind": "part",
                    "node": node.node,
                    "conv_id": node.conv_id,
                    "depth": depth,
                    "n_convs": node.n_convs,
                    "n_children": node.n_children,
                    "n_leaves": node.n_leaves,
                    "saved_tokens": node.saved,
                    "words": node.words,
                }
            )
            return
        if not node.n_children:
            node.n_leaves = 1
        node.saved += (node.n_convs - 1) * node.words
        parent.n_children += 1
        parent.n_leaves += node.n_leaves
        parent.saved += node.saved
        ends = node.hashed if node.hashed is not None else hashlib.sha256()
        done = {
            "kind": "node",
            "conv_id": node.conv_id,
            "depth": depth,
            "n_convs": node.n_convs,
            "n_children": node.n_children,
            "n_leaves": node.n_leaves,
            "saved_tokens": node.saved,
            "ends_sha256": ends.hexdigest(),
        }
        for child in node.finished:
            child["parent_conv_id"] = node.conv_id
        self.out += node.finished
        if parent.node is None:
            parent.finished.append(done)  # until the parent's smallest member is known
        else:
            done["parent"] = parent.node
            self.out.append(done)

    def finish(self) -> None:
        while self.open:
            self._close()

    def take(self) -> list[dict]:
        out, self.out = self.out, []
        return out


def _in_shards(paths: DataFrame, cuts: list[tuple[bytes, int]], shards: int) -> DataFrame:
    """The paths with their shard, in order within it."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())
            shard = pa.array([bisect.bisect_right(cuts, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, shard], [*batch.schema.names, "shard"]
            )

    schema = "conv_id long, path binary, words array<int>, shard int"
    return (
        paths.mapInArrow(find, schema)
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", "path", "conv_id")
    )


def shard_nodes(
    paths: DataFrame,
    cuts: list[tuple[bytes, int]],
    nodes: dict[bytes, bytes | None],
    shards: int,
) -> DataFrame:
    """Finished nodes, parts of skeleton nodes and their ends, of all shards; written once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema(_arrow_fields())
        current: _ShardPass | None = None
        for batch in batches:
            for conv_id, path, words, shard in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or current.shard != shard:
                    if current is not None:
                        current.finish()
                        yield _batch(current.take(), kinds)
                    current = _ShardPass(shard, nodes)
                current.add(conv_id, path, words)
                if len(current.out) >= 10_000:
                    yield _batch(current.take(), kinds)
        if current is not None:
            current.finish()
            yield _batch(current.take(), kinds)

    return stage(_in_shards(paths, cuts, shards).mapInArrow(work, _ROWS), "trie")


def _arrow_fields() -> list[tuple[str, pa.DataType]]:
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return [(name, types[kind]) for name, kind in map(str.split, _ROWS.split(", "))]


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _ends(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256) of skeleton nodes in which conversations end.

    Shards are in order, and so are the ids of one path; the chunks of a node
    stream through one hash, whose memory does not grow with them.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, hashed = None, hashlib.sha256()
        names = ["node", "ends_sha256"]

        def done() -> pa.RecordBatch:
            cells = [pa.array([node], pa.binary()), pa.array([hashed.hexdigest()])]
            return pa.RecordBatch.from_arrays(cells, names)

        for batch in batches:
            for following, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if following != node:
                    if node is not None:
                        yield done()
                    node, hashed = following, hashlib.sha256(ends)
                else:
                    hashed.update(b",")
                    hashed.update(ends)
        if node is not None:
            yield done()

    return (
        rows.where("kind = 'ends'")
        .select("node", "shard", "chunk", "ends")
        .repartition("node")
        .sortWithinPartitions("node", "shard", "chunk")
        .select("node", "ends")
        .mapInArrow(digest, "node binary, ends_sha256 string")
    )


def skeleton_nodes(rows: DataFrame, parents: dict[bytes, bytes | None]) -> DataFrame:
    """The skeleton's nodes, from their reduced parts, with their keys.

    There are no more of them than turns in the splitters: they are summed up
    along the skeleton by the driver.
    """
    parts = (
        rows.where("kind = 'part'")
        .groupBy("node")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            *[
                F.sum(name).alias(name)
                for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")
            ],
            F.max("words").alias("words"),
        )
        .join(_ends(rows), "node", "left")
    )
    nodes = {bytes(row["node"]): row.asDict() for row in parts.collect()}
    for key, node in sorted(nodes.items(), key=lambda item: -item[1]["depth"]):
        if not node["n_children"]:
            node["n_leaves"] = 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["words"]
        node["ends_sha256"] = node["ends_sha256"] or hashlib.sha256().hexdigest()
        node["parent_conv_id"] = None
        if key:
            parent = nodes[parents[key]]
            node["parent_conv_id"] = parent["conv_id"]
            parent["n_children"] += 1
            parent["n_leaves"] += node["n_leaves"]
            parent["saved_tokens"] += node["saved_tokens"]
    names = [column.split()[0] for column in _NODE.split(", ")]
    done = [(key, *(node[name] for name in names)) for key, node in nodes.items()]
    return rows.sparkSession.createDataFrame(done, f"node binary, {_NODE}")


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """All nodes of the trie of (conv_id, path, words), one row per conversation.

    A node is named by its smallest member and its depth.  ``shards`` is the number
    of shuffle partitions unless given.
    """
    shards = shards or int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    written = stage(paths, "paths")
    cuts = splitters(written, shards)
    parents = skeleton(cuts)
    rows = shard_nodes(written, cuts, parents, shards)
    top = skeleton_nodes(rows, parents)
    names = [column.split()[0] for column in _NODE.split(", ")]
    below = rows.where("kind = 'node'")
    inner = below.where("parent IS NULL").select(*names)
    above = top.select(F.col("node").alias("parent"), F.col("conv_id").alias("_parent_conv_id"))
    under_top = (
        below.drop("parent_conv_id")
        .join(F.broadcast(above), "parent")  # no more rows than turns in the splitters
        .withColumnRenamed("_parent_conv_id", "parent_conv_id")
        .select(*names)
    )
    return top.select(*names).unionByName(inner).unionByName(under_top)


def conversation_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """The trie of all rebuilt conversations, turnless ones included.

    Nulls, ties and repeated rows are treated as ``own_turns`` says; further columns
    are ignored; an empty table has no members and so no node, not even a root.
    """
    return prefix_trie(rebuilt_paths(conversations), shards)

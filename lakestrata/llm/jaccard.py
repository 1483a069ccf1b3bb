"""N-gram Jaccard join with a token-group matrix.

Documents with one set of shingles are one class; a class has one node.  Similar
nodes are put into groups, and the matrix row of a group is the union of its
members' tokens, written once.  A query node that may have a partner in a group is
held against that row; only groups of whose tokens the query has enough are opened,
and its members are compared with the queries that qualified.

Which rows a node is held against follows from signatures that lose no link.  With
similarity ``t``, the sets of two partners, the smaller of ``n`` tokens, differ by
``d = floor(n (1 - t) / t)`` tokens at most.  Hashes are cut into intervals; one
token that differs changes one interval.  Of the first ``d + 1 + e`` intervals that
hold tokens of either, ``1 + e`` are thus equal, and each stands among the first as
many that hold tokens of its own set.  A signature is the digest of an interval's
tokens, several of them in most, so a word or passage that very many documents
share gives no signature of its own.  The number of intervals is a power of two
that follows from the size; sets between two powers use both.  A set with too few
filled intervals has its first tokens as signatures besides.  Sets of which no
different one can be a partner have none.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakestrata.llm.bitmaps import MARKS, with_mark
from lakestrata.llm.components import components
from lakestrata.llm.pieces import Numbering, slices
from lakestrata.operators.staging import stage, staged

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)


# Signatures hold the power of their number of intervals in their last bits.
_POWER = 63
_TOKENS = 63  # in place of a power: the signature is a token


@dataclass(frozen=True)
class Settings:
    words: int = 5  # of a shingle
    percent: int = 80  # of the union that the intersection has at least
    slack: float = 0.5  # signatures beyond the tokens that may differ, as a share of them
    group_nodes: int = 128  # expected size of a group
    group_tokens: int = 200_000
    tile_nodes: int = 1_024  # of the groups that one task holds, expected
    tile_tokens: int = 400_000

    def need(self, n):
        """Tokens of ``n`` that a partner has at least; integers or arrays."""
        return -(-n * self.percent // 100)

    def differ(self, n):
        """Tokens by which a set of ``n`` and a partner as large or larger differ at most."""
        return n * (100 - self.percent) // self.percent

    def beyond(self, n):
        """Equal signatures that two partners have beyond one, the smaller of ``n``."""
        return max(0, min(int(self.differ(n) * self.slack), self.need(n) - 1))

    def signatures(self, n):
        return self.differ(n) + 1 + self.beyond(n)

    def power(self, n):
        """Intervals as a power of two: a quarter more than signatures, or up to twice that."""
        return int(np.ceil(np.log2(1.25 * self.signatures(n))))


class Shingler:
    """Texts to sorted arrays of shingle hashes."""

    def __init__(self, words: int, limit: int = 600_000) -> None:
        self.words, self.limit = words, limit
        self._reset()

    def _reset(self) -> None:
        self.numbering, self.hashes = Numbering(), np.zeros(0, np.uint64)

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """Words end at ASCII white space; only A-Z are put in lower case."""
        if len(self.numbering) > self.limit:
            self._reset()
        rows = [
            self.numbering.numbers(t.encode("utf-8", "surrogatepass").lower().split())
            for t in texts
        ]
        if fresh := self.numbering.take():
            new = np.fromiter(map(xxhash.xxh3_64_intdigest, fresh), np.uint64, len(fresh))
            self.hashes = np.concatenate([self.hashes, new])
        return [self._shingles(self.hashes[row]) for row in rows]

    def _shingles(self, words: np.ndarray) -> np.ndarray:
        if not len(words):
            return words
        length = min(self.words, len(words))
        count = len(words) - length + 1
        h = np.full(count, length, np.uint64)
        for k in range(length):
            h = (h ^ words[k : k + count]) * _A
            h ^= h >> np.uint64(32)
        h *= _B
        h ^= h >> np.uint64(29)
        return np.unique(h)


def node_of(shingles: np.ndarray) -> int:
    """64-bit digest of a set, as Spark's signed LONG."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def signatures_of(shingles: np.ndarray, s: Settings) -> np.ndarray:
    """Signatures of a sorted set, see the module; none where no partner can differ."""
    n = len(shingles)
    if s.differ(n) == 0:
        return np.zeros(0, np.uint64)
    most = s.signatures(n)
    mixed = (shingles ^ (shingles >> np.uint64(31))) * _A
    mixed ^= mixed >> np.uint64(33)
    clear = ~np.uint64(_POWER)
    found, few = [], False
    for power in range(s.power(s.need(n)), s.power(n) + 1):
        interval = shingles >> np.uint64(64 - power)
        starts = np.flatnonzero(np.append(True, interval[1:] != interval[:-1]))
        few |= len(starts) < most
        digest = np.add.reduceat(mixed, starts)[:most] * _B
        digest ^= digest >> np.uint64(32)
        found.append((digest & clear) | np.uint64(power))
    if few:
        found.append((mixed[:most] & clear) | np.uint64(_TOKENS))
    return np.concatenate(found)


def _text_key() -> Column:
    """Tells rows of one doc_id apart."""
    return F.xxhash64("text")


def _number_of(*names: str) -> Column:
    """A row's place in a bitmap."""
    return F.xxhash64(*names).bitwiseAND(F.lit(MARKS - 1))


# Nodes whose signatures a task knows to be given, at most.
_SEEN = 1_000_000


def _parts(parts: int) -> list[str]:
    """Columns that signatures are dealt over by their digests."""
    return ["signatures"] if parts == 1 else [f"signatures_{k}" for k in range(parts)]


def described(docs: DataFrame, s: Settings, parts: int = 1) -> DataFrame:
    """doc_id, text_key, n, node and signatures of each row; node is null for an empty set.

    The first row of a node in a task has the signatures; copies of it there have none.
    Over several ``parts``, each can be read without the others.
    """
    columns = _parts(parts)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, seen = Shingler(s.words), set()
        none = np.zeros(0, np.int64)
        for batch in batches:
            names, keys = iter(batch["doc_id"]), iter(batch["text_key"])
            for texts in slices(batch["text"], 8_000_000):
                sets = shingler.sets(texts)
                lens = np.array([len(x) for x in sets], np.int64)
                nodes = [node_of(x) if len(x) else None for x in sets]
                if len(seen) > _SEEN:
                    seen.clear()
                signatures = {name: [] for name in columns}
                for node, x in zip(nodes, sets):
                    found = none if node in seen else signatures_of(x, s).astype(np.int64)
                    seen.add(node)
                    rest = (found >> 6) % parts
                    for k, name in enumerate(columns):
                        signatures[name].append(found[rest == k])
                yield pd.DataFrame(
                    {
                        "doc_id": [next(names) for _ in sets],
                        "text_key": [next(keys) for _ in sets],
                        "n": lens,
                        "node": pd.array(nodes, "Int64"),
                    }
                    | signatures
                )

    # Ids as text keep nulls apart from numbers on the way to pandas.
    name = F.col("doc_id").cast("string").alias("doc_id")
    rows = docs.select(name, _text_key().alias("text_key"), "text")
    found = rows.mapInPandas(
        describe,
        "doc_id string, text_key long, n long, node long, "
        + ", ".join(f"{name} array<long>" for name in columns),
    )
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def shared_signatures(rows: DataFrame, column: str = "signatures") -> DataFrame:
    """signature, node and nodes for the signatures of a column that several nodes have.

    Signatures travel once: they are counted where they lie for that.
    """
    given = rows.select("node", F.explode(column).alias("signature"))
    of_one = W.partitionBy("signature")
    shared = given.select(
        "*",
        F.count("*").over(of_one).alias("nodes"),
        F.min("node").over(of_one).alias("_least"),
        F.max("node").over(of_one).alias("_most"),
    ).where("_least < _most")
    # Copies in several tasks have given their signatures more than once.
    return shared.groupBy("signature", "node").agg(F.max("nodes").alias("nodes"))


def by_signatures(
    rows: DataFrame, sizes: DataFrame, s: Settings, shared: DataFrame | None = None
) -> DataFrame:
    """The rows of ``sizes`` whose node can have a partner, with probes.

    Probes are the signatures that other nodes have too, each with the number of its
    rows; of one power there have to be as many as two partners share.  ``shared``
    holds the shared signatures of ``rows`` where they are known already.
    """
    once = shared_signatures(rows) if shared is None else shared
    held = once.groupBy(
        "node", F.col("signature").bitwiseAND(F.lit(_POWER)).alias("power")
    ).agg(F.collect_list(F.struct("nodes", "signature")).alias("held"))
    partner = F.ceil(F.col("n") * s.percent / 100)
    differ = F.floor(partner * (100 - s.percent) / s.percent)
    beyond = F.least(F.floor(differ * s.slack), F.ceil(partner * s.percent / 100) - 1)
    return (
        held.join(sizes, "node")
        .where(F.size("held") > F.greatest(F.lit(0), beyond))
        .groupBy(*sizes.columns)
        .agg(F.flatten(F.collect_list("held")).alias("probes"))
    )


def grouped(probes: DataFrame, s: Settings) -> DataFrame:
    """probes with the group of each node.

    Home is the probe that most nodes have, so that nodes alike meet; a home with
    many nodes is cut into groups of bounded size.
    """
    most = F.array_max("probes")["signature"]
    home = probes.withColumn("home", most)
    sizes = home.groupBy("home").agg(F.count("*").alias("members"), F.sum("n").alias("tokens"))
    cuts = F.greatest(
        F.lit(1),
        F.ceil(F.col("members") / s.group_nodes),
        F.ceil(F.col("tokens") / s.group_tokens),
    )
    return home.join(sizes.select("home", cuts.alias("cuts")), "home").select(
        *probes.columns,
        F.xxhash64("home", F.pmod(F.xxhash64("node"), "cuts")).alias("group"),
    )


def near_groups(groups: DataFrame) -> DataFrame:
    """first, second and common: two groups and the probes that both hold.

    ``first`` comes before ``second``, so that two nodes of different groups meet
    once.  A group holds a probe once, however many of its nodes have it.
    """
    held = groups.select(F.explode("probes.signature").alias("signature"), "group").distinct()
    first = held.withColumnRenamed("group", "first")
    second = held.withColumnRenamed("group", "second")
    return (
        first.join(second, "signature")
        .where("first < second")
        .groupBy("first", "second")
        .agg(F.collect_list("signature").alias("common"))
    )


def touching(groups: DataFrame) -> DataFrame:
    """node, first and second: the node's group and a later one that has a probe of the node."""
    own = groups.select("node", F.col("group").alias("first"), F.col("probes.signature").alias("own"))
    return (
        near_groups(groups)
        .join(own, "first")
        .where(F.arrays_overlap("common", "own"))
        .select("node", "first", "second")
    )


def unions(members: DataFrame) -> DataFrame:
    """The matrix: one row per group, with all tokens of its members in order."""
    tokens = F.array_distinct(F.flatten(F.collect_list("tokens")))
    return members.groupBy("group").agg(F.array_sort(tokens).alias("tokens"))


def tiled(touched: DataFrame, groups: DataFrame, s: Settings) -> DataFrame:
    """group, tie and slice of the groups in ``touched``.

    Groups that touch each other, be it by way of others, have one tie.  A task holds
    two slices of a tie, so that what many groups ask for goes to few tasks and not to
    one for each pair.  A tie of many nodes is cut so that groups with one largest
    neighbour stay together.  ``groups`` gives node, group and n.
    """
    pairs = touched.select(F.col("first").alias("a"), F.col("second").alias("b")).distinct()
    ties = components(pairs).select(F.col("node").alias("group"), F.col("root").alias("tie"))
    sizes = groups.groupBy("group").agg(F.count("*").alias("nodes"), F.sum("n").alias("tokens"))
    slices = F.greatest(
        F.lit(1),
        F.ceil(F.sum("nodes") / s.tile_nodes),
        F.ceil(F.sum("tokens") / s.tile_tokens),
    )
    size = F.struct("nodes", "group")
    beside = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    largest = (
        beside.join(sizes, F.col("b") == F.col("group"))
        .groupBy("a")
        .agg(F.max(size).alias("_largest"))
    )
    sized = ties.join(sizes, "group").join(largest, F.col("a") == F.col("group"))
    hubs = sized.withColumn("hub", F.greatest(size, "_largest")["group"])
    of_hub = hubs.groupBy("hub").agg(slices.alias("_own"))
    of_tie = sized.groupBy("tie").agg(slices.alias("_cuts"))
    part = F.xxhash64("hub", F.pmod(F.xxhash64("group"), "_own"))
    return (
        hubs.join(of_hub, "hub")
        .join(of_tie, "tie")
        .select("group", "tie", F.pmod(part, "_cuts").alias("slice"))
    )


_TILE = ["tie", "low", "high"]
_ROW = {c: f"_{c}" for c in _TILE}  # the side that is asked has names of its own


def _in_tiles(touched: DataFrame, tiles: DataFrame) -> DataFrame:
    """node, first and second with the tile that holds both groups."""
    one = tiles.select(F.col("group").alias("first"), "tie", F.col("slice").alias("_one"))
    other = tiles.select(F.col("group").alias("second"), F.col("slice").alias("_other"))
    return touched.join(one, "first").join(other, "second").select(
        "tie",
        F.least("_one", "_other").alias("low"),
        F.greatest("_one", "_other").alias("high"),
        "node",
        "first",
        "second",
    )


def qualifying(
    touched: DataFrame,
    members: DataFrame,
    matrix: DataFrame,
    s: Settings,
    tiles: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``touched`` whose node has enough tokens of the second group's union.

    A task holds the matrix rows and the queries of a tile, each of them once.
    """

    def bound(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        unions = {
            group: np.asarray(tokens, np.int64)
            for group, tokens in zip(rows["group"], rows["tokens"])
        }
        found = []
        for node, first, seconds, tokens in zip(
            queries["node"], queries["first"], queries["seconds"], queries["tokens"]
        ):
            for second in seconds:
                union = unions.get(second)
                if union is None:
                    continue
                place = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
                if np.count_nonzero(union[place] == tokens) >= s.need(len(tokens)):
                    found.append((node, first, second))
        return pd.DataFrame(found, columns=["node", "first", "second"]).astype("int64")

    if tiles is None:
        tiles = tiled(touched, members.withColumn("n", F.size("tokens")), s)
    placed = _in_tiles(touched, tiles)
    queries = placed.groupBy(*_TILE, "node", "first").agg(F.collect_list("second").alias("seconds"))
    queries = queries.join(members.select("node", "tokens"), "node")
    rows = placed.select(*_TILE, F.col("second").alias("group")).distinct().join(matrix, "group")
    return (
        queries.groupBy(*_TILE)
        .cogroup(rows.withColumnsRenamed(_ROW).groupBy(*_ROW.values()))
        .applyInPandas(bound, "node long, first long, second long")
    )


def token_sets(docs: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """node and all its tokens, worked out again from the texts of ``classes``."""

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(s.words)
        for batch in batches:
            for texts in slices(batch["text"], 8_000_000):
                sets = [x for x in shingler.sets(texts) if len(x)]
                yield pd.DataFrame(
                    {
                        "node": [node_of(x) for x in sets],
                        "tokens": [x.astype(np.int64) for x in sets],
                    }
                )

    # Texts are sent on only where a bitmap says that they may be wanted.
    wanted = classes.select("first_id")
    texts = docs.select("doc_id", "text")
    numbers = wanted.select(_number_of("first_id").alias("number"))
    chosen = with_mark(texts, _number_of("doc_id"), numbers, "_wanted").where("_wanted")
    chosen = chosen.join(wanted, F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    return chosen.select("text").mapInPandas(tokens, "node long, tokens array<long>")


def links(queries: list, group: list, same: bool, s: Settings) -> Iterator[tuple[int, int]]:
    """Index pairs of queries and members that link."""
    sizes = np.array([len(x) for x in group])
    every = np.concatenate(group)
    by_token = np.argsort(every, kind="stable")
    every = every[by_token]
    owners = np.repeat(np.arange(len(group)), sizes)[by_token]
    starts = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    union = every[starts]
    runs = np.diff(np.append(starts, len(every)))
    for at, query in enumerate(queries):
        place = np.minimum(np.searchsorted(union, query), len(union) - 1)
        place = place[union[place] == query]
        if not len(place):
            continue
        run = runs[place]
        ends = np.cumsum(run)
        spread = np.repeat(starts[place] - (ends - run), run) + np.arange(ends[-1])
        common = np.bincount(owners[spread], minlength=len(group))
        union_size = len(query) + sizes - common
        for other in np.flatnonzero(100 * common >= s.percent * union_size):
            if not same or other > at:
                yield at, int(other)


def verified(
    qualified: DataFrame, members: DataFrame, tiles: DataFrame, s: Settings
) -> DataFrame:
    """node, root and links from each tile.

    A group is opened for itself, in the one tile of its own slice, and for the queries
    of others that qualified.  root ties the nodes linked in that tile together; links
    counts the documents of the nodes linked with this one.
    """

    def verify(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        at: dict[int, int] = {}
        sets, weights = [], []
        for rows in (held, asked):
            for node, documents, tokens in zip(rows["node"], rows["documents"], rows["tokens"]):
                if node not in at:
                    at[node] = len(sets)
                    sets.append(np.asarray(tokens, np.int64))
                    weights.append(documents)
        opened: dict[int, list[int]] = {}
        for group, node in zip(held["group"], held["node"]):
            opened.setdefault(group, []).append(at[node])
        asking: dict[int, list[int]] = {}
        for node, seconds in zip(asked["node"], asked["seconds"]):
            for second in seconds:
                asking.setdefault(second, []).append(at[node])
        nodes = list(at)
        root = list(range(len(nodes)))
        count = [0] * len(nodes)

        def top(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        def tie(one: list[int], other: list[int], same: bool) -> None:
            for a, b in links([sets[k] for k in one], [sets[k] for k in other], same, s):
                a, b = one[a], other[b]
                count[a] += weights[b]
                count[b] += weights[a]
                root[top(a)] = top(b)

        own = set(held["group"][held["own"]])
        for group, other in opened.items():
            if group in own:
                tie(other, other, True)
            if group in asking:
                tie(asking[group], other, False)
        linked = [k for k in range(len(nodes)) if count[k]]
        return pd.DataFrame(
            {
                "node": [nodes[k] for k in linked],
                "root": [nodes[top(k)] for k in linked],
                "links": [count[k] for k in linked],
            }
        ).astype("int64")

    placed = _in_tiles(qualified, tiles)
    # A group of one has nothing to compare inside.
    several = members.groupBy("group").agg(F.count("*").alias("_n")).where("_n > 1")
    alone = several.join(tiles, "group", "left").select(
        F.coalesce("tie", "group").alias("tie"),
        F.coalesce("slice", F.lit(0)).alias("low"),
        F.coalesce("slice", F.lit(0)).alias("high"),
        "group",
        F.lit(True).alias("own"),
    )
    asked_of = placed.select(*_TILE, F.col("second").alias("group"), F.lit(False).alias("own"))
    opened = alone.unionByName(asked_of).groupBy(*_TILE, "group").agg(F.max("own").alias("own"))
    held = opened.join(members, "group")
    asked = placed.groupBy(*_TILE, "node").agg(F.collect_list("second").alias("seconds"))
    asked = asked.join(members.drop("group"), "node")
    return (
        asked.groupBy(*_TILE)
        .cogroup(held.withColumnsRenamed(_ROW).groupBy(*_ROW.values()))
        .applyInPandas(verify, "node long, root long, links long")
    )


def jaccard_components(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links.

    Documents link when the intersection of their shingle sets has ``percent`` of
    the union or more; component_id is the smallest doc_id reachable.  A document
    with fewer words than a shingle has one shingle of all of them; null and empty
    texts have none, link with nothing and are their own component.  Copies link
    with each other.  A repeated doc_id is a copy like any other; a null doc_id
    takes part, and is null as a component only where nobody in it has an id.
    Other columns are not read.  Shingles and sets are told apart by 64-bit
    digests.
    """
    return _joined(docs, s).select("doc_id", "n_shingles", "component_id", "n_links")


# A class of copies is dealt over this many tasks.
_SALTS = 32
# Signatures meet in as many passes, so that the disk holds those of one at a time.
_PASSES = 4


def _joined(docs: DataFrame, s: Settings) -> DataFrame:
    """The same with text_key and root, the node that names the component.

    Signatures, token sets and what is made of them stay for the length of a step.
    """
    salt = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(_SALTS)).cast("int")
    with ExitStack() as brief:
        with ExitStack() as wide:
            given = wide.enter_context(staged(described(docs, s, _PASSES), "jaccard-signatures"))
            parts = _parts(_PASSES)
            rows = stage(given.drop(*parts).withColumn("salt", salt), "jaccard-rows")
            shared = [
                brief.enter_context(staged(shared_signatures(given, part), "jaccard-shared"))
                for part in parts
            ]
        sizes = (
            rows.where("node IS NOT NULL")
            .groupBy("node")
            .agg(
                F.min("n").cast("int").alias("n"),
                F.count("*").alias("documents"),
                F.min("doc_id").alias("least"),
                F.expr("bit_or(shiftleft(1L, salt))").alias("salts"),
            )
        )
        every = reduce(DataFrame.unionByName, shared)
        probes = by_signatures(rows, sizes.drop("salts"), s, every)
        groups = brief.enter_context(staged(grouped(probes, s), "jaccard-groups"))
        linked = _linked(docs, groups, sizes, s, brief)
        per_node = stage(sizes.drop("n").join(linked, "node", "left"), "jaccard-components")
    # As many rows of a class as its documents have salts.
    has = F.filter(
        F.sequence(F.lit(0), F.lit(_SALTS - 1)),
        lambda k: F.expr("salts").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), k)) != 0,
    )
    dealt = per_node.withColumn("salt", F.explode(has)).drop("salts")
    copies = F.coalesce(F.col("documents") - 1, F.lit(0))
    with_node = rows.join(dealt, ["node", "salt"]).select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "least").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + copies).cast("long").alias("n_links"),
        F.coalesce("root", "node").alias("root"),
    )
    # Rows without a set meet nothing; in the join they would all hash alike.
    without = rows.where("node IS NULL").select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        F.col("doc_id").alias("component_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(None).cast("long").alias("root"),
    )
    return with_node.unionByName(without)


def _linked(
    docs: DataFrame, groups: DataFrame, sizes: DataFrame, s: Settings, brief: ExitStack
) -> DataFrame:
    """node, root, component and links of the nodes that link with another."""

    def written(df: DataFrame, label: str) -> DataFrame:
        return brief.enter_context(staged(df, label))

    sets = token_sets(docs, groups.select(F.col("least").alias("first_id")), s)
    # Repeated rows work a node's tokens out more than once.
    own = W.partitionBy("node").orderBy("node")
    sets = sets.withColumn("_n", F.row_number().over(own)).where("_n = 1").drop("_n")
    members = written(
        groups.select("node", "group", "documents").join(sets, "node"), "jaccard-tokens"
    )
    touched = written(touching(groups), "jaccard-touched")
    tiles = written(tiled(touched, groups, s), "jaccard-tiles")
    with ExitStack() as rows:
        second = touched.select(F.col("second").alias("group")).distinct()
        asked = members.join(second, "group", "left_semi")
        matrix = rows.enter_context(staged(unions(asked), "jaccard-matrix"))
        qualified = written(qualifying(touched, members, matrix, s, tiles), "jaccard-qualified")
    found = written(verified(qualified, members, tiles, s), "jaccard-links")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    tied = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    whole = tied.join(sizes, "node").groupBy("root").agg(F.min("least").alias("component"))
    return tied.join(whole, "root").join(counted, "node").select("node", "root", "component", "links")


def keep_representatives(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One document of each component, with all columns of ``docs``.

    That with the smallest doc_id stays (a null id only where there is no other);
    of rows that repeat id and text, one.  Documents without words all stay.
    """
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    worded = _joined(docs, s).where("root IS NOT NULL")
    found = stage(worded.select("root", row.alias("row")), "jaccard-found")
    times = found.groupBy("root", "row").agg(F.count("*").alias("times"))
    heads = stage(
        times.groupBy("root")
        .agg(F.min(F.struct("row", "times")).alias("head"))
        .select(
            F.col("head.row.doc_id").alias("_id"),
            F.col("head.row.text_key").alias("_key"),
            F.col("head.times").alias("_times"),
        ),
        "jaccard-heads",
    )
    once = heads.where("_times = 1")
    repeated = stage(heads.where("_times > 1"), "jaccard-repeated")
    named = found.select(F.col("row.doc_id").alias("doc_id"), F.col("row.text_key").alias("key"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    gone = stage(named.join(once, same, "left_anti"), "jaccard-gone")
    # The user's columns stay in one struct, apart from those made here.
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    packed = docs.select(
        F.struct("*").alias("doc"), "doc_id", _text_key().alias("key"), wordless.alias("wordless")
    )
    # Bitmaps settle most rows where they are read; texts are sent on for the others only.
    place, at = _number_of("doc_id", "key"), _number_of("_id", "_key").alias("number")
    told = with_mark(packed, place, gone.select(place.alias("number")), "_gone")
    told = with_mark(told, place, heads.select(at), "_head")
    stay = told.where("wordless OR NOT _gone").select("doc")
    perhaps = told.where("_gone AND _head AND NOT wordless")
    again = perhaps.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "key"])
    kept = stay.unionByName(perhaps.join(once, same, "left_semi").select("doc"))
    kept = kept.unionByName(again.select("doc"))
    return kept.select("doc.*")

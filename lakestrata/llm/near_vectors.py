"""Near-duplicate vectors by collision counting over one-dimensional projections.

Unit vectors are projected on many random lines.  On each line the vectors are
sorted, and a window centred on a query holds those that collide with it there.
A pair is verified by its cosine when it collides on enough lines; how many is
set so that a pair just at the threshold is found with the wanted recall.

The first lines also cut a label's vectors into cells at quantiles.  A query goes
to the cells its windows reach, and cells too large for a task are dealt as
blocks of members and queries.  Equal vectors are one node.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb, erf, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.components import components
from lakestrata.operators.staging import stage

_FRACTIONS = 64  # cuts of a line that quantiles are kept for


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.98
    lines: int = 24
    reach: float = 2.0  # half a window, in standard deviations of a pair at the threshold
    recall: float = 0.995  # of such a pair, on the count of lines
    cell_lines: int = 3
    cell_reach: float = 3.2
    cell_nodes: int = 512
    block_nodes: int = 2048
    seed: int = 11

    @property
    def distance(self) -> float:
        return sqrt(2 - 2 * self.cosine)

    @property
    def least(self) -> int:
        """The highest count that a pair at the threshold reaches with ``recall``."""
        p = erf(self.reach / sqrt(2))
        tail = 0.0
        for count in range(self.lines, 0, -1):
            tail += comb(self.lines, count) * p**count * (1 - p) ** (self.lines - count)
            if tail >= self.recall:
                return count
        return 0

    def directions(self, width: int) -> np.ndarray:
        return np.random.default_rng([self.seed, width]).normal(size=(width, self.lines))


def comparable(embedding: Column) -> Column:
    """Whether a vector has only finite components and one that is not zero."""
    finite = F.forall(
        embedding,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _units(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_width(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    if len(batch):
        yield from (part for _, part in batch.groupby("width", sort=False))


def _quantiles(nodes: DataFrame, s: Settings) -> DataFrame:
    """For each label and width: its nodes, and cuts of each cell line."""

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _by_width(batch):
                width = int(part["width"].iloc[0])
                at = _units(part["embedding"]) @ s.directions(width)[:, : s.cell_lines]
                out = part[["label", "width"]].copy()
                for k in range(s.cell_lines):
                    out[f"at{k}"] = at[:, k]
                yield out

    columns = ", ".join(f"at{k} double" for k in range(s.cell_lines))
    kind = dict(nodes.dtypes)["label"]
    projected = nodes.select("label", "width", "embedding").mapInPandas(
        project, f"label {kind}, width int, {columns}"
    )
    fractions = [k / _FRACTIONS for k in range(1, _FRACTIONS)]
    cuts = F.array(*(F.percentile_approx(f"at{k}", fractions, 2000) for k in range(s.cell_lines)))
    return projected.groupBy("label", "width").agg(F.count("*").alias("many"), cuts.alias("cuts"))


def _placed(nodes: DataFrame, s: Settings) -> DataFrame:
    """Nodes with unit vector, projections, home cell and the cells to be asked."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        halo = s.cell_reach * s.distance
        for batch in batches:
            for part in _by_width(batch):
                width = int(part["width"].iloc[0])
                units = _units(part["embedding"])
                at = units @ s.directions(width)
                homes, asked = [], []
                for row, many, cuts in zip(at, part["many"], part["cuts"]):
                    slices = min(
                        _FRACTIONS, max(1, round((many / s.cell_nodes) ** (1 / s.cell_lines)))
                    )
                    cells, home = [0], 0
                    for k in range(s.cell_lines):
                        steps = np.arange(1, slices) * _FRACTIONS // slices - 1
                        edges = np.asarray(cuts[k])[steps]
                        low, own, high = np.searchsorted(
                            edges, [row[k] - halo, row[k], row[k] + halo], side="right"
                        )
                        home = home * slices + int(own)
                        cells = [c * slices + x for c in cells for x in range(low, high + 1)]
                    homes.append(home)
                    asked.append(cells)
                yield pd.DataFrame(
                    {
                        "node": part["node"].to_numpy(),
                        "label": part["label"].to_numpy(),
                        "width": width,
                        "vectors": part["vectors"].to_numpy(),
                        "unit": [u.tobytes() for u in units],
                        "at": [a.tobytes() for a in at],
                        "home": homes,
                        "asked": asked,
                    }
                )

    kind = dict(nodes.dtypes)["label"]
    quantiles = stage(_quantiles(nodes, s), "vector-quantiles")
    return nodes.join(quantiles, ["label", "width"]).mapInPandas(
        place,
        f"node long, label {kind}, width int, vectors long, unit binary, at binary, "
        "home int, asked array<int>",
    )


def collisions(queries: np.ndarray, members: np.ndarray, s: Settings) -> tuple:
    """Index pairs (query, member) that collide on ``s.least`` lines or more."""
    half = s.reach * s.distance
    spare = s.lines - s.least
    early = min(s.lines, 2 * spare + 2)
    count = np.zeros((len(queries), len(members)), np.int8)
    for line in range(early):
        order = np.argsort(members[:, line], kind="stable")
        on_line = members[order, line]
        first = np.searchsorted(on_line, queries[:, line] - half, side="left")
        last = np.searchsorted(on_line, queries[:, line] + half, side="right")
        rank = np.empty(len(members), np.int32)
        rank[order] = np.arange(len(members), dtype=np.int32)
        count += (rank >= first[:, None].astype(np.int32)) & (rank < last[:, None].astype(np.int32))
    # A pair may miss ``spare`` lines in all; those that missed more are out.
    query, member = np.nonzero(count >= early - spare)
    total = count[query, member].astype(np.int64)
    for line in range(early, s.lines):
        total += np.abs(queries[query, line] - members[member, line]) <= half
    found = total >= s.least
    return query[found], member[found]


def _verified(placed: DataFrame, s: Settings) -> DataFrame:
    """node, root and links from each block of a cell."""

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        asks = rows["asks"].to_numpy()
        node = rows["node"].to_numpy()
        weight = rows["vectors"].to_numpy()
        one, other = np.flatnonzero(asks), np.flatnonzero(~asks)
        root: dict[int, int] = {}
        count: dict[int, int] = {}

        def top(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        if len(one) and len(other):
            units = np.stack([np.frombuffer(u) for u in rows["unit"]])
            at = np.stack([np.frombuffer(a) for a in rows["at"]])
            a, b = collisions(at[one], at[other], s)
            a, b = one[a], other[b]
            ordered = node[a] < node[b]  # either may be the query; one of the two counts
            a, b = a[ordered], b[ordered]
            near = np.concatenate(
                [
                    np.einsum("ij,ij->i", units[a[k : k + 65536]], units[b[k : k + 65536]])
                    for k in range(0, len(a), 65536)
                ]
                or [np.zeros(0)]
            )
            linked = near >= s.cosine
            pairs = (v[linked].tolist() for v in (node[a], node[b], weight[a], weight[b]))
            for x, y, wx, wy in zip(*pairs):
                root.setdefault(x, x)
                root.setdefault(y, y)
                root[top(x)] = top(y)
                count[x] = count.get(x, 0) + wy
                count[y] = count.get(y, 0) + wx
        return pd.DataFrame(
            {"node": list(root), "root": [top(k) for k in root], "links": [count[k] for k in root]}
        ).astype("int64")

    cell = ["label", "width", "cell"]
    members = placed.withColumnRenamed("home", "cell").drop("asked")
    queries = placed.withColumn("cell", F.explode("asked")).drop("home", "asked")
    blocks = (
        members.groupBy(*cell)
        .agg(F.ceil(F.count("*") / s.block_nodes).cast("int").alias("member_blocks"))
        .join(
            queries.groupBy(*cell).agg(
                F.ceil(F.count("*") / s.block_nodes).cast("int").alias("query_blocks")
            ),
            cell,
        )
    )
    blocks = stage(blocks, "vector-blocks")

    def dealt(rows: DataFrame, own: str, every: str, asks: bool) -> DataFrame:
        rows = rows.join(blocks, cell)
        rows = rows.withColumn(own, F.pmod(F.xxhash64("node"), F.col(f"{own}s")).cast("int"))
        rows = rows.withColumn(every, F.explode(F.sequence(F.lit(0), F.col(f"{every}s") - 1)))
        return rows.select(
            *cell, "member_block", "query_block", F.lit(asks).alias("asks"), "node", "vectors",
            "unit", "at",
        )

    return (
        dealt(members, "member_block", "query_block", False)
        .unionByName(dealt(queries, "query_block", "member_block", True))
        .groupBy(*cell, "member_block", "query_block")
        .applyInPandas(verify, "node long, root long, links long")
    )


def vector_components(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors of one label and width link from the cosine ``s.cosine`` on.  A vector
    that is null, zero or has a null or non-finite component, or whose label is
    null, links with nothing and is its own component.  Equal vectors link with
    each other whatever their ids; a null vec_id takes part, and is null as a
    component only where nobody in it has an id.  Other columns are not read.
    """
    usable = F.col("label").isNotNull() & comparable(F.col("embedding"))
    rows = vectors.select("vec_id", "label", "embedding").withColumn(
        "node", F.when(usable, F.xxhash64("label", "embedding"))
    )
    nodes = stage(
        rows.where("node IS NOT NULL")
        .groupBy("node", "label", "embedding")
        .agg(F.count("*").alias("vectors"), F.min("vec_id").alias("least"))
        .withColumn("width", F.size("embedding")),
        "vector-nodes",
    )
    placed = stage(_placed(nodes, s), "vectors-placed")
    found = stage(_verified(placed, s), "vector-links")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    tied = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    sizes = nodes.select("node", "vectors", "least")
    whole = tied.join(sizes, "node").groupBy("root").agg(F.min("least").alias("component"))
    linked = tied.join(whole, "root").join(counted, "node").select("node", "component", "links")
    per_node = stage(sizes.join(linked, "node", "left"), "vector-components")
    component = F.coalesce("component", "least", "vec_id")
    return rows.select("vec_id", "node").join(per_node, "node", "left").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("vectors") - 1, F.lit(0)))
        .cast("long")
        .alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )

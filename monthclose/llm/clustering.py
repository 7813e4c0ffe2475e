"""Centroid clustering in whole numbers, with a vantage-point tree over the centroids.

Each round broadcasts a tree over the current centroids; every task assigns its vectors and adds up each centroid's
components and vectors; the sums, one row per centroid and task, meet at the driver in exact decimals and become the
next centroids. No vector is ever shuffled.

An inner node of the tree holds a vantage point, which is a centroid, and for each of its two subtrees the least and
greatest distance from the vantage point to a centroid in it. A vector goes through the tree best first: of the nodes
it has yet to open it opens the one that could hold the nearest centroid, until no node left could hold one as near as
the best found. Nodes that could hold one just as near are opened too, since of equally near centroids the smaller
number counts. Each vector keeps its own order and bounds; numpy takes a step of all vectors of a batch at once.
Distances that decide are sums of squares of whole numbers, exact however large; roots serve the bounds alone.

Vectors that are null, of another length than ``width``, or hold null or non-finite components take no part. Vectors
alike are clustered each for itself; equal hashes of starts are ordered by the vector, null ids come last. With fewer
vectors than centroids, each vector is a start. An empty table gives no rows. Squared distances or sums beyond 64 bits
raise OverflowError. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.llm.common import whole_numbers

WIDTH, SCALE, CENTROIDS, ROUNDS, SEED = 64, 256, 40, 5, 2
#: Centroids of a leaf, and vectors that go through the tree together.
LEAF, BLOCK = 4, 4096
#: Components below it in size have squared distances that fit 64 bits at up to 64 components.
_SAFE = 1 << 27
_MARGIN = 1e-9


def usable(df: DataFrame, width: int = WIDTH, vector: str = "embedding") -> DataFrame:
    """(vec_id, embedding) of the vectors that take part."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    right = F.coalesce((F.size(x) == width) & finite, F.lit(False))
    return df.where(right).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding"))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of whole numbers."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) >= _SAFE or a.shape[-1] > 64:
        a, b = a.astype(object), b.astype(object)
    return ((a - b) ** 2).sum(axis=-1)


@dataclass(frozen=True)
class VantageTree:
    """Nodes in arrays; node 0 is the root. ``kids`` of a leaf are -1; its centroids are ``members``.

    ``low`` and ``high`` are the least and greatest distance from the parent's vantage point to the node's centroids."""

    centroids: np.ndarray
    vantage: np.ndarray
    kids: np.ndarray
    low: np.ndarray
    high: np.ndarray
    members: np.ndarray

    @staticmethod
    def over(centroids: np.ndarray) -> VantageTree:
        vantage, kids, low, high, members = [], [], [], [], []

        def grow(rows: np.ndarray, near: float, far: float) -> int:
            node = len(vantage)
            vantage.append(-1)
            kids.append((-1, -1))
            low.append(near)
            high.append(far)
            members.append(rows)
            if len(rows) <= LEAF:
                return node
            # The centroid furthest from the group's mean sees the others at the most various distances.
            middle = centroids[rows].astype(float).mean(axis=0)
            chosen = int(((centroids[rows] - middle) ** 2).sum(axis=1).argmax())
            rest = np.delete(rows, chosen)
            distance = np.sqrt(squared(centroids[rest], centroids[rows[chosen]]).astype(float))
            inner = np.argsort(distance, kind="stable")
            half = len(rest) // 2
            vantage[node], members[node] = int(rows[chosen]), rows[:0]
            parts = (inner[:half], inner[half:])
            kids[node] = tuple(grow(rest[p], float(distance[p].min()), float(distance[p].max())) for p in parts)
            return node

        grow(np.arange(len(centroids)), 0.0, np.inf)
        wide = np.full((len(vantage), LEAF), -1)
        for node, rows in enumerate(members):
            wide[node, : len(rows)] = rows
        return VantageTree(centroids, np.array(vantage), np.array(kids), np.array(low), np.array(high), wide)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and exact squared distance of each vector's nearest centroid."""
        n = len(vectors)
        best = np.full(n, len(self.centroids))
        least = np.empty(n, object if squared(vectors, self.centroids[:1]).dtype == object else np.int64)
        least[:] = np.iinfo(np.int64).max if least.dtype != object else 1 << 200
        # What a vector's nodes may hold at the nearest; infinite for nodes it has not reached or has opened.
        bound = np.full((n, len(self.vantage)), np.inf)
        bound[:, 0] = 0.0
        asking = np.arange(n)
        while len(asking):
            node = bound[asking].argmin(axis=1)
            radius = np.sqrt(least[asking].astype(float)) * (1 + _MARGIN)
            opens = bound[asking, node] <= radius  # inclusive: one as near may have a smaller number
            asking, node = asking[opens], node[opens]
            reached = bound[asking, node]
            bound[asking, node] = np.inf
            inner = self.vantage[node] >= 0
            for column in range(LEAF):
                there = ~inner & (self.members[node, column] >= 0)
                self._meet(vectors, asking[there], self.members[node[there], column], best, least)
            at, among = asking[inner], node[inner]
            away = np.sqrt(self._meet(vectors, at, self.vantage[among], best, least).astype(float))
            for side in (0, 1):
                kid = self.kids[among, side]
                gap = np.maximum(away - self.high[kid], self.low[kid] - away)
                gap -= _MARGIN * (away + self.high[kid])
                bound[at, kid] = np.maximum(np.maximum(gap, reached[inner]), 0.0)
        return best, least

    def _meet(self, vectors, at, centroid, best, least) -> np.ndarray:
        distance = squared(vectors[at], self.centroids[centroid]).astype(least.dtype)
        nearer = (distance < least[at]) | ((distance == least[at]) & (centroid < best[at]))
        best[at[nearer]], least[at[nearer]] = centroid[nearer], distance[nearer]
        return distance


def starts(vectors: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors (at most) whose ids have the smallest hashes."""
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(by_hash.asc_nulls_last(), "embedding").limit(k).toArrow()
    if not rows.num_rows:
        return np.empty((0, WIDTH), np.int64)
    return whole_numbers(rows.column("embedding").combine_chunks(), SCALE)


def _blocks(batches: Iterator[pa.RecordBatch], tree: VantageTree):
    for whole in batches:
        for a in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(a, BLOCK)
            vectors = whole_numbers(batch.column("embedding"), SCALE)
            yield batch, vectors, *tree.nearest(vectors)


def _in_long(values: np.ndarray) -> pa.Array:
    if values.dtype == object and len(values) and max(values) > np.iinfo(np.int64).max:
        raise OverflowError("a squared distance does not fit 64 bits")
    return pa.array(values.astype(np.int64))


def _summed(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Per centroid of a task, in one list: how many vectors, their distances and their components added up. Sums go
    out before they can leave 64 bits."""
    tree = shared.value
    k, width = tree.centroids.shape
    total = np.zeros((k, 2 + width), np.int64)

    def out() -> pa.RecordBatch:
        used = np.flatnonzero(total[:, 0])
        edges = pa.array(np.arange(len(used) + 1) * (2 + width), pa.int32())
        sums = pa.ListArray.from_arrays(edges, pa.array(total[used].reshape(-1)))
        return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), sums], names=["cluster", "sums"])

    room = 0.0
    for _, vectors, cluster, distance in _blocks(batches, tree):
        new = float(max(np.abs(vectors).max(initial=0), max(distance, default=0))) * len(vectors)
        if new >= 2.0**62:
            raise OverflowError("a sum of distances or components does not fit 64 bits")
        if room + new >= 2.0**62:
            yield out()
            total[:], room = 0, 0.0
        room += new
        np.add.at(total, cluster, np.column_stack([np.ones(len(vectors), np.int64), distance.astype(np.int64), vectors]))
    yield out()


def _assigned(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    for batch, _, cluster, distance in _blocks(batches, shared.value):
        arrays = [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), _in_long(distance)]
        yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "cluster", "distance"])


def cluster_sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """Of each centroid with vectors: how many, their squared distances and their components added up, exactly."""
    shared = vectors.sparkSession.sparkContext.broadcast(VantageTree.over(centroids))
    parts = vectors.mapInArrow(lambda b: _summed(b, shared), "cluster int, sums array<long>")
    added = parts.select("cluster", F.posexplode("sums").alias("place", "x")).groupBy("cluster", "place")
    found: dict[int, list[int]] = {}
    for row in added.agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():
        found.setdefault(row.cluster, [0] * (2 + centroids.shape[1]))[row.place] = int(row.x)
    shared.unpersist()
    return {number: (n, spread, sums) for number, (n, spread, *sums) in found.items()}


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and the centroid (array of long) of every vector of
    ``vectors`` (as :func:`usable` gives them), which is read once per round and once more for the result."""
    centroids = starts(vectors, k, seed)
    final: dict[int, tuple[int, int, list[int]]] = {}
    if len(centroids):
        for _ in range(rounds):
            for number, (n, _, sums) in cluster_sums(vectors, centroids).items():
                centroids[number] = [s // n for s in sums]
        final = cluster_sums(vectors, centroids)
    inertia = sum(spread for _, spread, _ in final.values())
    if inertia >= 1 << 63:
        raise OverflowError("the inertia does not fit 64 bits")
    shared = vectors.sparkSession.sparkContext.broadcast(VantageTree.over(centroids))
    rows = vectors.mapInArrow(lambda b: _assigned(b, shared), "vec_id long, cluster int, distance long")
    named = vectors.sparkSession.createDataFrame(
        [(c, spread, inertia, [int(x) for x in centroids[c]]) for c, (_, spread, _) in sorted(final.items())],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    return rows.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", *named.columns[1:])


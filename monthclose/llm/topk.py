"""Exact top-k inner products by a dual-tree search over cover trees.

Components become whole numbers, floor(1024 * x). Candidates are dealt into blocks by a hash, queries likewise; a
task holds one block of queries as a cover tree and meets its lane of candidate blocks one after the other, each as
a cover tree of its own. A pair of nodes is left unseen if even the best inner product their covering radii allow
lies below the worst k-th score of the queries in the group; close pairs go first, so that bound rises early and
lasts from block to block. Each lane's best k per query are merged at the end.

Vectors that are null, empty or hold null or non-finite components take no part; vectors of different length are
never compared. Scores are exact at any size: doubles where a bound proves them so, else wider whole numbers. What does
not fit the 64 bits of a result raises an error, as does a component that fits no 64-bit whole number. A candidate with the query's own id is the query itself. Queries that repeat in id and vector are
asked once. A null id is no query; as a candidate it sorts behind all ids on equal scores. Fewer than k candidates
give all. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthclose.llm.common import numbers, raw_bytes, runs, settle
from monthclose.llm.hard_negatives import products

SCALE, K = 1024, 10
QUERY_BLOCK, CANDIDATE_BLOCK, LANE_BLOCKS = 512, 4_096, 8
LEAF = 64
_NO_ID = np.iinfo(np.int64).max
_NO_SCORE = -_NO_ID


def whole_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part, components as whole numbers."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    too_large = F.raise_error(F.lit("a vector's component does not fit a 64-bit whole number")).cast("long")
    fits = lambda y: F.abs(y) < 2.0**62
    scaled = F.transform(
        F.transform(x, lambda c: c.cast("double") * SCALE), lambda y: F.when(fits(y), F.floor(y)).otherwise(too_large)
    )
    return df.where(x.isNotNull() & (F.size(x) > 0)).where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"))


@dataclass
class Node:
    """A ball around ``center`` that covers the points ``rows``; leaves have no children."""

    center: np.ndarray
    norm: float
    radius: float
    rows: np.ndarray
    children: list[Node]


def cover_tree(points: np.ndarray, rows: np.ndarray | None = None) -> Node:
    """Covers the points by balls of half the radius, and each of those likewise, down to ``LEAF`` points.

    Centres of a level are points further than half the radius from each other. Where points lie so far apart that
    every ball would hold only a few, the node stays a leaf."""
    rows = np.arange(len(points)) if rows is None else rows
    mine = points[rows]
    center = mine[0]
    distance = np.sqrt(((mine - center) ** 2).sum(axis=1))
    radius = float(distance.max())
    node = Node(center, float(np.sqrt(center @ center)), radius, rows, [])
    if len(rows) <= LEAF or radius == 0:
        return node
    left, parts, most = np.arange(len(rows)), [], max(2, len(rows) // 8)
    while len(left):
        if len(parts) == most:
            # No room for halving: divide by the nearest of a few spread centres instead.
            chosen = mine[np.linspace(0, len(rows) - 1, max(2, min(8, len(rows) // LEAF))).astype(int)]
            near = (mine @ chosen.T * -2 + (chosen**2).sum(axis=1)).argmin(axis=1)
            parts = [np.flatnonzero(near == i) for i in range(len(chosen))]
            parts = [p for p in parts if len(p)]
            break
        pivot = mine[left[0]]
        close = np.sqrt(((mine[left] - pivot) ** 2).sum(axis=1)) <= radius / 2
        parts.append(left[close])
        left = left[~close]
    if len(parts) > 1:
        node.children = [cover_tree(points, rows[p]) for p in parts]
    return node


class Search:
    """Best k candidates of a block of queries, over any number of candidate blocks."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int = K):
        self.ids, self.vectors, self.k = ids, vectors.astype(np.int64), k
        self.tree = cover_tree(vectors.astype(np.float64))
        self.score = np.full((len(ids), k), _NO_SCORE)
        self.found = np.full((len(ids), k), _NO_ID)
        self.there = np.zeros((len(ids), k), bool)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order].astype(np.int64)
        self._descend(self.tree, cover_tree(vectors.astype(np.float64)), ids, vectors)

    @staticmethod
    def _bound(q: Node, r: Node) -> float:
        return float(q.center @ r.center) + q.radius * r.norm + r.radius * q.norm + q.radius * r.radius

    def _descend(self, q: Node, r: Node, ids: np.ndarray, vectors: np.ndarray) -> None:
        # Scores are exact, the bound is made of rounded doubles, hence the margin.
        margin = 1e-3 + 1e-9 * (q.norm + q.radius) * (r.norm + r.radius)
        if self._bound(q, r) < float(self.score[q.rows, -1].min()) - margin:
            return
        if not q.children and not r.children:
            self._compare(q.rows, r.rows, ids, vectors)
            return
        if r.children and (not q.children or r.radius >= q.radius):
            pairs = [(q, child) for child in r.children]
        else:
            pairs = [(child, r) for child in q.children]
        for a, b in sorted(pairs, key=lambda p: -self._bound(*p)):
            self._descend(a, b, ids, vectors)

    def _compare(self, asking: np.ndarray, among: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        scores = products(self.vectors[asking], vectors[among])
        other = self.ids[asking][:, None] != ids[among][None, :]
        scores[~other] = _NO_SCORE
        open_rows = np.flatnonzero(((scores >= self.score[asking, -1:]) & other).any(axis=1))
        if not len(open_rows):
            return
        rows, scores = asking[open_rows], scores[open_rows]
        every = np.concatenate([self.score[rows], scores], axis=1)
        named = np.concatenate([self.found[rows], np.broadcast_to(ids[among], scores.shape)], axis=1)
        real = np.concatenate([self.there[rows], other[open_rows]], axis=1)
        by_id = np.argsort(named, axis=1, kind="stable")
        every, named, real = (np.take_along_axis(x, by_id, axis=1) for x in (every, named, real))
        best = np.argsort(-every, axis=1, kind="stable")[:, : self.k]
        self.score[rows], self.found[rows], self.there[rows] = (
            np.take_along_axis(x, best, axis=1) for x in (every, named, real)
        )


def _searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Sorted by (dim, qb, lane, cb): queries (cb = -1) first, then the lane's blocks of candidates."""
    here, search, asking, block, number = None, None, [], [], -1

    def load(parts: list[pa.RecordBatch], dim: int) -> tuple[np.ndarray, np.ndarray]:
        ids = np.concatenate([numbers(p.column("vec_id").fill_null(_NO_ID)) for p in parts])
        v = np.concatenate([np.ascontiguousarray(raw_bytes(p.column("v"), 8 * dim)).view(">i8") for p in parts])
        return ids, v.astype(np.int64)

    def close() -> None:
        nonlocal block, search, asking
        if asking and search is None:
            search, asking = Search(*load(asking, here[0]), k), []
        if block and search is not None:
            search.meet(*load(block, here[0]))
        block = []

    def result() -> Iterator[pa.RecordBatch]:
        if search is None:
            return
        row, place = np.nonzero(search.there)
        found = search.found[row, place]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(search.ids[row]),
                pa.array(found, mask=found == _NO_ID),
                pa.array(search.score[row, place]),
            ],
            names=["query_id", "vec_id", "score"],
        )

    for (dim, qb, lane, cb), rows in runs(batches, ("dim", "qb", "lane", "cb")):
        if (dim, qb, lane) != here:
            close()
            yield from result()
            here, search, asking, number = (dim, qb, lane), None, [], -1
        if cb != number:
            close()
            number = cb
        (asking if cb < 0 else block).append(rows)
    close()
    yield from result()


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of ``vectors`` for each row of ``queries`` (vec_id, v)."""
    packed = F.expr("aggregate(v, cast('' AS binary), (a, x) -> concat(a, unhex(lpad(hex(x), 16, '0'))))")
    every = settle(vectors.select("vec_id", F.size("v").alias("dim"), packed.alias("v")))
    asked = settle(queries.where("vec_id IS NOT NULL").select("vec_id", F.size("v").alias("dim"), packed.alias("v")).distinct())
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    blocks = max(1, -(-every.count() // CANDIDATE_BLOCK))
    lanes = max(1, -(-blocks // LANE_BLOCKS))
    numbered = every.withColumn("cb", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    candidates = numbered.select(
        "dim",
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"),
        (F.col("cb") % lanes).alias("lane"),
        "cb",
        "vec_id",
        "v",
    )
    asking = asked.select(
        "dim",
        F.pmod(F.xxhash64("vec_id", "v", F.lit(8)), F.lit(query_blocks)).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"),
        F.lit(-1).alias("cb"),
        "vec_id",
        "v",
    )
    dealt = asking.unionByName(candidates).repartition("dim", "qb", "lane").sortWithinPartitions("dim", "qb", "lane", "cb")
    best = dealt.mapInArrow(lambda batches: _searched(batches, k), "query_id long, vec_id long, score long")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

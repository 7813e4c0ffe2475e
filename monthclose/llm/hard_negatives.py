"""Hard negatives by exact window search in a GNAT-style tree.

A node of the tree has several split points. A vector belongs to the nearest of them; for each split point and each
subtree the node stores the least and greatest distance from the point to the subtree's vectors. A search for scores
in a window is one for distances in an annulus around the query: vectors are given one more component that brings all
to one length, and then a larger inner product is a smaller distance. A subtree is left unseen if, seen from any of
the split points, no distance stored for it can lie in the annulus. The window's lower edge rises to the worst of the
best scores found so far. Leaves compare whole numbers exactly.

On the cluster the tree has two parts. The top is grown over a bounded sample (``SAMPLE`` rows of smallest hash), its
ranges come from one pass over all vectors, and it is broadcast; each of its leaves is a cell. Vectors are shuffled
once per search by cell, a cell with many vectors in lanes of at most ``LANE`` rows, and each task grows the lower part
over its lane. Queries are sent only to cells the top cannot eliminate, with a lower edge that the sample already
proves. Searching twice, first for each anchor's positives among the rows of its label, then within each positive's
window among the rows of other labels, gives the negatives.

Rows whose label or vector is null, whose vector is empty or holds null or non-finite components take no part; vectors
of different length are never compared. A row with the anchor's id is the anchor itself. Anchors that repeat in id,
label and vector are asked once; other repeated rows count as often as they come, as positives too. A null id is no
anchor; as a candidate it comes last among equal scores. Scores beyond 64 bits raise OverflowError. An empty table, or
one without anchors, gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthclose.llm.common import numbers, runs, settle, whole_numbers

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: Split points of a node, vectors of a leaf, rows of the sample, sample rows of a cell, rows of a lane.
FAN_OUT, LEAF, SAMPLE, CELL_SAMPLE, LANE = 12, 96, 4096, 64, 32_768
#: Queries that go down a tree together.
BLOCK = 512
_NO_ID = np.iinfo(np.int64).max
_LOWEST, _HIGHEST = -(1 << 62), 1 << 62
_MARGIN = 4e-6


def usable(df: DataFrame, label: Column | str = "label", vector: str = "embedding") -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part."""
    x, label = F.col(vector), F.col(label) if isinstance(label, str) else label
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    right = label.isNotNull() & F.coalesce((F.size(x) > 0) & finite, F.lit(False))
    return df.where(right).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("embedding")
    )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers: by doubles where these prove exact, else in wider numbers."""
    bound = float(np.sqrt((a.astype(float) ** 2).sum(axis=1).max(initial=0) * (b.astype(float) ** 2).sum(axis=1).max(initial=0)))
    largest = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if bound * 1.01 < 2.0**53 and largest < 2**53:
        # No partial sum exceeds the sum of the terms' sizes, which the lengths bound.
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if bound * 1.01 < 2.0**61:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    if exact.size and max(abs(exact.max()), abs(exact.min())) >= _HIGHEST:
        raise OverflowError("an inner product does not fit 64 bits")
    return exact.astype(np.int64)


@dataclass
class Node:
    """``near[i, j]`` and ``far[i, j]``: from split point i to the vectors of subtree j. Leaves have no points."""

    rows: np.ndarray
    cell: int = -1
    points: np.ndarray | None = None
    near: np.ndarray | None = None
    far: np.ndarray | None = None
    kids: list[Node] = field(default_factory=list)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def spread_points(points: np.ndarray, n: int) -> np.ndarray:
    """Rows far from each other: each the one furthest from those chosen before; fewer where vectors are alike."""
    chosen = [0]
    away = distances(points, points[:1])[:, 0]
    while len(chosen) < n and away.max() > 1e-6:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, distances(points, points[chosen[-1:]])[:, 0])
    return np.array(chosen)


def gnat(points: np.ndarray, leaf: int, rows: np.ndarray | None = None) -> Node:
    """A tree over ``points`` with at most ``leaf`` rows in a leaf, unless more are alike."""
    rows = np.arange(len(points)) if rows is None else rows
    if len(rows) <= leaf:
        return Node(rows)
    mine = points[rows]
    # Split points come from an even sweep of the rows, so that choosing them stays cheap.
    swept = mine[np.linspace(0, len(rows) - 1, min(len(rows), 24 * FAN_OUT)).astype(int)]
    split = swept[spread_points(swept, FAN_OUT)]
    away = distances(mine, split)
    owner = away.argmin(axis=1)
    parts = [np.flatnonzero(owner == j) for j in range(len(split))]
    kept = [j for j, p in enumerate(parts) if len(p)]
    if len(kept) < 2:
        return Node(rows)
    near = np.array([away[parts[j]].min(axis=0) for j in kept]).T[kept]
    far = np.array([away[parts[j]].max(axis=0) for j in kept]).T[kept]
    return Node(rows, -1, split[kept], near, far, [gnat(points, leaf, rows[parts[j]]) for j in kept])


def alive(node: Node, seen: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
    """Which subtrees (columns) may hold vectors at a distance between ``inner`` and ``outer`` from each query (rows),
    as the distances ``seen`` from the queries to the split points tell."""
    least = np.maximum(seen[:, :, None] - node.far[None], node.near[None] - seen[:, :, None])
    most = seen[:, :, None] + node.far[None]
    return ((least <= outer[:, None, None]) & (most >= inner[:, None, None])).all(axis=1)


class Space:
    """Vectors brought to one length, ``np.sqrt(longest)``, by one more component, which queries have as 0."""

    def __init__(self, longest: float):
        self.longest = longest

    def stored(self, vectors: np.ndarray) -> np.ndarray:
        v = vectors.astype(float)
        rest = np.sqrt(np.maximum(self.longest - (v**2).sum(axis=1), 0.0))
        return np.concatenate([v, rest[:, None]], axis=1)

    @staticmethod
    def asked(vectors: np.ndarray) -> np.ndarray:
        return np.concatenate([vectors.astype(float), np.zeros((len(vectors), 1))], axis=1)

    def annulus(self, vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of the scores from ``low`` to ``high``, widened by more than rounding can take away anywhere: a
        squared distance is off by a few dozen units in the last place of the squared lengths at most."""
        whole = (vectors.astype(float) ** 2).sum(axis=1) + self.longest
        slack = _MARGIN * np.sqrt(whole) + 1e-6
        inner, outer = (np.sqrt(np.maximum(whole - 2.0 * score.astype(float), 0.0)) for score in (high, low))
        return inner * (1 - 1e-9) - slack, outer * (1 + 1e-9) + slack


@dataclass
class Queries:
    """Vectors, each with its own id and label, the scores it asks for, and whether its own label or others count."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool

    def counts(self, ids: np.ndarray, labels: np.ndarray, score: np.ndarray, rows=slice(None), low=None) -> np.ndarray:
        """Whether a vector (column) counts for a query (row of ``rows``) by label, id and score."""
        low = self.low if low is None else low
        alike = self.labels[rows][:, None] == labels[None, :]
        ok = (alike if self.same else ~alike) & (self.ids[rows][:, None] != ids[None, :])
        return ok & (score >= low[rows][:, None]) & (score <= self.high[rows][:, None])


class Search:
    """The best ``k`` of each query's window, over any number of trees."""

    def __init__(self, queries: Queries, space: Space, k: int):
        self.q, self.space, self.k, n = queries, space, k, len(queries.ids)
        self.asked = space.asked(queries.vectors)
        self.score = np.full((n, k), _LOWEST)
        self.found = np.full((n, k), _NO_ID)
        self.inner, _ = space.annulus(queries.vectors, queries.low, queries.high)
        self.edge = queries.low.copy()
        self.visited = 0

    def descend(self, node: Node, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, asking: np.ndarray) -> None:
        self.visited += 1
        if not node.kids:
            self.compare(node.rows, ids, labels, vectors, asking)
            return
        seen = distances(self.asked[asking], node.points)
        # The nearest subtrees first: they raise the lower edge for the others.
        for j in seen.mean(axis=0).argsort(kind="stable"):
            _, outer = self.space.annulus(self.q.vectors[asking], self.edge[asking], self.edge[asking])
            part = Node(node.rows, -1, node.points, node.near[:, j : j + 1], node.far[:, j : j + 1])
            rows = asking[alive(part, seen, self.inner[asking], outer)[:, 0]]
            if len(rows):
                self.descend(node.kids[j], ids, labels, vectors, rows)

    def compare(self, rows, ids, labels, vectors, asking) -> None:
        score = products(self.q.vectors[asking], vectors[rows])
        ok = self.q.counts(ids[rows], labels[rows], score, asking, self.edge)
        hit = np.flatnonzero(ok.any(axis=1))
        if not len(hit):
            return
        to, score = asking[hit], np.where(ok[hit], score[hit], _LOWEST)
        score = np.concatenate([self.score[to], score], axis=1)
        named = np.concatenate([self.found[to], np.broadcast_to(ids[rows], (len(to), len(rows)))], axis=1)
        best = np.lexsort((named, -score), axis=1)[:, : self.k]
        self.score[to], self.found[to] = np.take_along_axis(score, best, 1), np.take_along_axis(named, best, 1)
        self.edge[to] = np.maximum(self.q.low[to], self.score[to, -1])


@dataclass
class Top:
    """The broadcast part: per length of vectors a tree whose leaves are cells, and how many lanes a cell has."""

    trees: dict[int, Node]
    sample: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # ids, labels, vectors
    longest: dict[int, float]
    lanes: dict[tuple[int, int], int] = field(default_factory=dict)

    def inner_nodes(self, dim: int) -> list[Node]:
        out, left = [], [self.trees[dim]] if dim in self.trees else []
        while left:
            node = left.pop()
            if node.kids:
                out.append(node)
                left += node.kids
        return out

    def walk(self, dim: int, stored: np.ndarray, each=None) -> np.ndarray:
        """The cell of every vector; ``each(node, away, owner)`` sees the split points' distances on the way."""
        cell = np.zeros(len(stored), np.int64)

        def down(node: Node, rows: np.ndarray) -> None:
            if not node.kids:
                cell[rows] = max(node.cell, 0)
                return
            away = distances(stored[rows], node.points)
            owner = away.argmin(axis=1)
            if each:
                each(node, away, owner)
            for j, kid in enumerate(node.kids):
                mine = rows[owner == j]
                if len(mine):
                    down(kid, mine)

        if dim in self.trees and len(stored):
            down(self.trees[dim], np.arange(len(stored)))
        return cell

    def cells(self, dim: int, q: Queries) -> Iterator[tuple[int, np.ndarray]]:
        """Cells that may hold scores of the windows, with the queries to send there."""
        space = Space(self.longest[dim])
        inner, outer = space.annulus(q.vectors, q.low, q.high)
        asked = space.asked(q.vectors)

        def down(node: Node, rows: np.ndarray):
            if not node.kids:
                yield max(node.cell, 0), rows
                return
            open_ = alive(node, distances(asked[rows], node.points), inner[rows], outer[rows])
            for j, kid in enumerate(node.kids):
                if open_[:, j].any():
                    yield from down(kid, rows[open_[:, j]])

        yield from down(self.trees.get(dim) or Node(np.arange(0)), np.arange(len(q.ids)))

    def raised(self, dim: int, q: Queries, k: int) -> np.ndarray:
        """The lower edges the sample proves: its k-th best score in the window, if it has so many."""
        if dim not in self.sample:
            return q.low
        ids, labels, vectors = self.sample[dim]
        score = np.where(q.counts(ids, labels, scores := products(q.vectors, vectors)), scores, _LOWEST)
        if len(ids) < k:
            return q.low
        return np.maximum(q.low, np.partition(score, -k, axis=1)[:, -k])


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = numbers(batch.column("dim"))
    for dim in np.unique(dims).tolist():
        yield dim, batch if (dims == dim).all() else batch.filter(pa.array(dims == dim))


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return whole_numbers(batch.column("embedding"), SCALE)


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return numbers(batch.column("vec_id").fill_null(_NO_ID))


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longest: dict[int, float] = {}
    for whole in batches:
        for dim, batch in _by_dim(whole):
            square = (_vectors(batch).astype(float) ** 2).sum(axis=1).max()
            longest[dim] = max(longest.get(dim, 0.0), float(square))
    arrays = [pa.array(list(longest), pa.int32()), pa.array(list(longest.values()), pa.float64())]
    yield pa.RecordBatch.from_arrays(arrays, names=["dim", "longest"])


def _ranges(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Least and greatest distances per node, split point and subtree of a task's vectors, and vectors per cell (as
    node -1, in ``n``)."""
    top: Top = shared.value
    held: dict[tuple[int, int], list] = {}
    count: dict[tuple[int, int], int] = {}
    for whole in batches:
        for dim, batch in _by_dim(whole):
            place = {id(node): i for i, node in enumerate(top.inner_nodes(dim))}

            def each(node: Node, away: np.ndarray, owner: np.ndarray, dim=dim, place=place) -> None:
                m = len(node.kids)
                near, far = held.setdefault((dim, place[id(node)]), [np.full((m, m), np.inf), np.full((m, m), -np.inf)])
                for j in np.unique(owner):
                    near[:, j] = np.minimum(near[:, j], away[owner == j].min(axis=0))
                    far[:, j] = np.maximum(far[:, j], away[owner == j].max(axis=0))

            cells = top.walk(dim, Space(top.longest[dim]).stored(_vectors(batch)), each)
            for cell, n in zip(*np.unique(cells, return_counts=True), strict=True):
                count[dim, int(cell)] = count.get((dim, int(cell)), 0) + int(n)
    rows = [(d, -1, c, 0, 0.0, 0.0, n) for (d, c), n in count.items()]
    for (d, node), (near, far) in held.items():
        rows += [(d, node, int(i), int(j), float(near[i, j]), float(far[i, j]), 0) for i, j in np.argwhere(far >= 0)]
    names = ["dim", "node", "i", "j", "near", "far", "n"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(arrays, names=names)


def grow_top(vectors: DataFrame, sample: int = SAMPLE, cell_sample: int = CELL_SAMPLE, lane: int = LANE) -> Top:
    """The top of the tree: split points from the sample, ranges and lanes from all vectors. To the driver go one row
    per length of vectors, the sample, one row per pair of split points of a node and one per cell."""
    longest = vectors.mapInArrow(_lengths, "dim int, longest double").groupBy("dim").agg(F.max("longest").alias("longest"))
    top = Top({}, {}, {row.dim: row.longest for row in longest.collect()})
    by_hash = F.xxhash64("vec_id", "label", "embedding")
    drawn = vectors.orderBy(by_hash, F.asc_nulls_last("vec_id"), "label", "embedding").limit(sample).toArrow()
    for batch in drawn.combine_chunks().to_batches():
        for dim, rows in _by_dim(batch):
            v = _vectors(rows)
            top.sample[dim] = (_ids(rows), numbers(rows.column("label")), v)
            top.trees[dim] = gnat(Space(top.longest[dim]).stored(v), cell_sample)
            for number, node in enumerate(_leaves(top.trees[dim])):
                node.cell = number
    spark = vectors.sparkSession.sparkContext
    shared = spark.broadcast(top)
    parts = vectors.mapInArrow(
        lambda b: _ranges(b, shared), "dim int, node int, i int, j int, near double, far double, n long"
    )
    merged = parts.groupBy("dim", "node", "i", "j").agg(F.min("near").alias("near"), F.max("far").alias("far"), F.sum("n").alias("n"))
    rows = merged.collect()
    shared.unpersist()
    nodes = {dim: top.inner_nodes(dim) for dim in top.trees}
    for dim in nodes:
        for node in nodes[dim]:
            # A subtree without vectors is never alive: nothing is between infinity and minus infinity.
            node.near, node.far = np.full(node.near.shape, np.inf), np.full(node.far.shape, -np.inf)
    for r in rows:
        if r.node < 0:
            top.lanes[r.dim, r.i] = -(-r.n // lane)
        else:
            nodes[r.dim][r.node].near[r.i, r.j], nodes[r.dim][r.node].far[r.i, r.j] = r.near, r.far
    return top


def _leaves(node: Node) -> Iterator[Node]:
    if not node.kids:
        yield node
    for kid in node.kids:
        yield from _leaves(kid)


_DEALT = {"dim": "int", "cell": "int", "lane": "int", "kind": "int", "part": "int", "asking": "long", "vec_id": "long"}
_DEALT |= {"label": "long", "low": "long", "high": "long"}
_FOUND = {"anchor": "long", "asking": "long", "part": "int", "score": "long", "vec_id": "long"}


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


def _dealt(columns: dict, n: int) -> pa.RecordBatch:
    """Columns of _DEALT and the embedding; single numbers are repeated, absent ones are 0."""
    arrays = []
    for name, kind in _DEALT.items():
        value, kind = columns.get(name, 0), pa.int32() if kind == "int" else pa.int64()
        arrays.append(pa.array(np.full(n, value) if isinstance(value, int) else value).cast(kind))
    return pa.RecordBatch.from_arrays([*arrays, columns["embedding"]], names=[*_DEALT, "embedding"])


def _stored(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Every vector with its cell and lane."""
    top: Top = shared.value
    for whole in batches:
        for dim, batch in _by_dim(whole):
            cell = top.walk(dim, Space(top.longest[dim]).stored(_vectors(batch)))
            lanes = np.array([top.lanes.get((dim, int(c)), 1) for c in cell])
            columns = {c: batch.column(c) for c in ("vec_id", "label", "embedding")}
            columns |= {"dim": dim, "cell": cell, "lane": numbers(batch.column("spread")) % lanes}
            yield _dealt(columns, batch.num_rows)


def _sent(batches: Iterator[pa.RecordBatch], shared, same: bool, k: int) -> Iterator[pa.RecordBatch]:
    """Every query once for each lane of each cell that may hold part of its window."""
    top: Top = shared.value
    for whole in batches:
        for dim, batch in _by_dim(whole):
            for a in range(0, batch.num_rows if dim in top.longest else 0, BLOCK):
                part = batch.slice(a, BLOCK)
                low, high = (numbers(part.column(c)) for c in ("low", "high"))
                q = Queries(_ids(part), numbers(part.column("label")), _vectors(part), low, high, same)
                q.low = top.raised(dim, q, k)
                for cell, rows in top.cells(dim, q):
                    taken = part.take(pa.array(rows))
                    columns = {c: taken.column(c) for c in ("asking", "part", "vec_id", "label", "embedding", "high")}
                    columns |= {"dim": dim, "cell": cell, "kind": 1, "low": q.low[rows]}
                    for lane in range(top.lanes.get((dim, cell), 0)):
                        yield _dealt(columns | {"lane": lane}, len(rows))


def _searched(batches: Iterator[pa.RecordBatch], longest: dict[int, float], same: bool, k: int) -> Iterator[pa.RecordBatch]:
    """Sorted by (dim, cell, lane, kind): a lane's vectors first, then the queries sent there."""
    here, parts, tree = None, [], None
    for (dim, cell, lane, kind), batch in runs(batches, ("dim", "cell", "lane", "kind")):
        if (dim, cell, lane) != here:
            here, parts, tree = (dim, cell, lane), [], None
        if kind == 0:
            parts.append((_ids(batch), numbers(batch.column("label")), _vectors(batch)))
            continue
        if not parts and tree is None:
            continue
        space = Space(longest[dim])
        if tree is None:
            ids, labels, vectors = (np.concatenate(x) for x in zip(*parts, strict=True))
            parts, tree = [], gnat(space.stored(vectors), LEAF)
        for a in range(0, batch.num_rows, BLOCK):
            asked = batch.slice(a, BLOCK)
            low, high = (numbers(asked.column(c)) for c in ("low", "high"))
            search = Search(Queries(_ids(asked), numbers(asked.column("label")), _vectors(asked), low, high, same), space, k)
            search.descend(tree, ids, labels, vectors, np.arange(asked.num_rows))
            row, place = np.nonzero(search.score > _LOWEST)
            found = search.found[row, place]
            arrays = [pa.array(numbers(asked.column(c))[row]) for c in ("vec_id", "asking", "part")]
            arrays += [pa.array(search.score[row, place]), pa.array(found, mask=found == _NO_ID)]
            arrays[2] = arrays[2].cast(pa.int32())
            yield pa.RecordBatch.from_arrays(arrays, names=list(_FOUND))


def search(vectors: DataFrame, queries: DataFrame, top: Top, same: bool, k: int) -> DataFrame:
    """anchor, asking, part, score, vec_id, place (from 1): the best ``k`` rows of ``vectors`` (dim, vec_id, label,
    embedding) in the window from ``low`` to ``high`` of each of ``queries`` (these and asking, part, low, high;
    vec_id, asking and part name a query), among rows of the query's label or those of others."""
    shared = vectors.sparkSession.sparkContext.broadcast(top)
    longest = top.longest
    dealt = _ddl(_DEALT | {"embedding": vectors.schema["embedding"].dataType.simpleString()})
    spread = F.pmod(F.xxhash64("vec_id", "label", "embedding", F.lit(1)), F.lit(1 << 40)).alias("spread")
    stored = vectors.select("*", spread).mapInArrow(lambda b: _stored(b, shared), dealt)
    sent = queries.mapInArrow(lambda b: _sent(b, shared, same, k), dealt)
    key = ("dim", "cell", "lane")
    met = stored.unionByName(sent).repartition(*key).sortWithinPartitions(*key, "kind")
    found = met.mapInArrow(lambda b: _searched(b, longest, same, k), _ddl(_FOUND))
    best = Window.partitionBy("anchor", "asking", "part").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, **sizes: int
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for the rows of ``vectors`` (as
    :func:`usable` gives them) for which ``anchors`` holds."""
    vectors = vectors.withColumn("dim", F.size("embedding"))
    top = grow_top(vectors, **sizes)
    asked = vectors.where(anchors & F.col("vec_id").isNotNull()).distinct()
    asked = asked.withColumns({"asking": F.xxhash64("label", "embedding"), "part": F.lit(0)})
    every = asked.withColumns({"low": F.lit(_LOWEST + 1), "high": F.lit(_HIGHEST)})
    found = search(vectors, every, top, True, positives).select(
        "anchor", "asking", "place", F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id")
    )
    pairs = settle(asked.drop("part").withColumn("anchor", F.col("vec_id")).join(found, ["anchor", "asking"]))
    # From four fifths of the positive's score up to it; of negative scores none lies there.
    score = F.col("positive_score")
    windows = pairs.where(score >= 0).select(
        *("dim", "vec_id", "label", "embedding", "asking"),
        F.col("place").alias("part"),
        (score - F.expr("positive_score div 5")).alias("low"),
        score.alias("high"),
    )
    named = pairs.select("anchor", "asking", F.col("place").alias("part"), "positive_id", "positive_score")
    return search(vectors, windows, top, False, negatives).join(named, ["anchor", "asking", "part"]).select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        F.col("place").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )

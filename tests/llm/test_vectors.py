"""Hard negatives and centroid clustering against brute force in plain Python."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthclose.llm import clustering, hard_negatives
from monthclose.llm.common import ship_package
from monthclose.llm.registry import QUERIES
from tests.conftest import bag

SCHEMA = "vec_id long, embedding array<double>, label int"
SIZES = {"sample": 120, "cell_sample": 10, "lane": 20}


def floors(vector, scale=256):
    return [math.floor(scale * x) for x in vector]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


def takes_part(row):
    _, v, label = row
    return label is not None and v and all(x is not None and math.isfinite(x) for x in v)


def brute_negatives(rows, k=5):
    """Rows of the result by the contract: every anchor against every row."""
    kept = [(i, floors(v), label) for i, v, label in rows if takes_part((i, v, label))]
    order = lambda hit: (-hit[0], hit[1] is None, hit[1] or 0)
    out = []
    anchors = {(i, tuple(v), label) for i, v, label in kept if i is not None and i % 100 == 0}
    for anchor, v, label in anchors:
        scored = [(dot(v, w), i, other == label) for i, w, other in kept if i != anchor and len(w) == len(v)]
        for score, positive, _ in sorted((s for s in scored if s[2]), key=order)[:k]:
            fits = [s for s in scored if not s[2] and 80 * score <= 100 * s[0] <= 100 * score]
            for rank, (negative_score, negative, _) in enumerate(sorted(fits, key=order)[:k], 1):
                out.append((anchor, positive, rank, negative, score, negative_score))
    return sorted(out, key=repr)


def found_negatives(spark, rows, **sizes):
    vectors = hard_negatives.usable(spark.createDataFrame(rows, SCHEMA))
    found = hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, **sizes)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r) for r in found.select(*names).collect()), key=repr)


def clustered(seed, n, dim=6, labels=4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, dim))
    return [
        (20 * i, (centers[i % 5] + 0.4 * rng.normal(size=dim)).tolist(), int(rng.integers(labels))) for i in range(n)
    ]


ODD = [
    (100, [1.0, 0.5], 1),
    (100, [1.0, 0.5], 1),  # an anchor asked once, a row no other anchor loses
    (100, [0.5, 0.5], 2),  # the same id with another vector
    (7, [1.0, 0.5], 1),
    (7, [1.0, 0.5], 1),
    (8, [1.0, 0.5], 2),
    (9, [1.0, 0.5], 2),
    (10, [0.9, 0.45], 2),
    (None, [1.0, 0.5], 2),
    (None, [1.0, 0.5], 1),
    (11, [], 1),
    (12, None, 1),
    (13, [1.0, None], 2),
    (14, [1.0, float("nan")], 2),
    (15, [float("inf"), 1.0], 2),
    (16, [1.0, 0.5], None),
    (17, [1.0, 0.5, 0.0], 2),
    (200, [-1.0, 0.0], 3),
    (18, [1.0, 0.0], 3),
    (300, [0.0, 0.0], 4),
    (19, [1.0, 0.0], 4),
]


def test_hard_negatives_equal_brute_force(spark):
    ship_package(spark)
    rows = clustered(1, 250)
    assert found_negatives(spark, rows, **SIZES) == brute_negatives(rows)
    rows = clustered(2, 120, dim=3, labels=2) + ODD
    assert found_negatives(spark, rows, **SIZES) == brute_negatives(rows)


def test_hard_negatives_odd_rows_and_empty_tables(spark):
    ship_package(spark)
    assert found_negatives(spark, ODD) == brute_negatives(ODD)
    assert brute_negatives(ODD)
    assert found_negatives(spark, [(1, [1.0], 1)]) == []
    assert found_negatives(spark, ODD[:0]) == []


def test_hard_negatives_alike_vectors_and_large_numbers(spark):
    ship_package(spark)
    alike = [(50 * i, [0.25, 0.5], i % 3) for i in range(90)]
    assert found_negatives(spark, alike, **SIZES) == brute_negatives(alike)
    # Scores beyond 2**53, apart by less than doubles can tell.
    large = [(25 * i, [1e5 + i / 256, 1e5 - (i % 7) / 256, 3e4] + [1e5] * 20, i % 2) for i in range(40)]
    assert max(r[4] for r in brute_negatives(large)) > 2**53
    assert found_negatives(spark, large, **SIZES) == brute_negatives(large)


def test_gnat_ranges_hold_and_eliminate():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(30, 8)) * 50
    points = np.concatenate([c + rng.normal(size=(60, 8)) for c in centers])
    tree = hard_negatives.gnat(points, 20)

    def rows_below(node):
        return node.rows if not node.kids else np.concatenate([rows_below(kid) for kid in node.kids])

    assert sorted(rows_below(tree)) == list(range(len(points)))
    for j, kid in enumerate(tree.kids):
        away = hard_negatives.distances(tree.points, points[rows_below(kid)])
        assert np.allclose(away.min(axis=1), tree.near[:, j]) and np.allclose(away.max(axis=1), tree.far[:, j])
    vectors = np.floor(points * 256).astype(np.int64)
    space = hard_negatives.Space(float((vectors**2).sum(axis=1).max()))
    grown = hard_negatives.gnat(space.stored(vectors), 20)
    ids, labels = np.arange(len(points)), np.zeros(len(points), np.int64)
    low = (vectors[:1] ** 2).sum(axis=1)
    query = hard_negatives.Queries(np.array([-1]), np.array([0]), vectors[:1], low, low + 1_000_000, True)
    search = hard_negatives.Search(query, space, 5)
    search.descend(grown, ids, labels, vectors, np.arange(1))
    every, left = 0, [grown]
    while left:
        every += 1
        left += left.pop().kids
    assert search.visited < every / 3


def brute_clusters(rows, k, rounds, width):
    kept = [
        (i, floors(v)) for i, v, _ in rows if v and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = [hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "z" for i, _ in kept]
    starts = sorted(range(len(kept)), key=lambda r: (named[r], kept[r][1]))[:k]
    centroids = [kept[r][1] for r in starts]

    def assign():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)))
        return out

    for _ in range(rounds):
        owner = [n for _, n in assign()]
        for n in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, owner, strict=True) if o == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    final = assign()
    inertia = sum(d for d, _ in final)
    return sorted(
        (
            (i, n, d, sum(e for e, m in final if m == n), inertia, centroids[n])
            for (i, _), (d, n) in zip(kept, final, strict=True)
        ),
        key=repr,
    )


def found_clusters(spark, rows, k, rounds, width):
    vectors = clustering.usable(spark.createDataFrame(rows, SCHEMA), width).repartition(3)
    found = clustering.cluster(vectors, k, rounds)
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize(("k", "rounds"), [(12, 3), (1, 2), (500, 1), (7, 0)])
def test_clusters_equal_brute_force(spark, k, rounds):
    ship_package(spark)
    rows = clustered(4, 80) + [(3, [0.0] * 6, 1), (3, [0.0] * 6, 1), (None, [1.0] * 6, 1)]
    rows += [(i, [0.5] * 6, 1) for i in range(1000, 1030)]
    assert found_clusters(spark, rows, k, rounds, 6) == brute_clusters(rows, k, rounds, 6)


def test_clusters_odd_rows_ties_and_large_numbers(spark):
    ship_package(spark)
    assert found_clusters(spark, ODD, 3, 2, 2) == brute_clusters(ODD, 3, 2, 2)
    assert found_clusters(spark, ODD[:0], 3, 2, 2) == []
    grid = [(i, [float(i % 4), float(i // 4 % 4)], 0) for i in range(64)]
    assert found_clusters(spark, grid, 9, 2, 2) == brute_clusters(grid, 9, 2, 2)
    large = [(i, [1e6 * (i % 5), 1e6 * (i % 3) + i], 0) for i in range(30)]
    assert found_clusters(spark, large, 4, 2, 2) == brute_clusters(large, 4, 2, 2)
    with pytest.raises(Exception, match="does not fit"):
        found_clusters(spark, [(i, [1e8 * i, 1e8], 0) for i in range(9)], 2, 1, 2)


def test_vantage_tree_prunes_and_keeps_the_smaller_of_equals():
    rng = np.random.default_rng(5)
    centroids = rng.integers(-1000, 1000, (300, 3))
    centroids[150:] = centroids[:150]
    vectors = np.concatenate([centroids[:150], rng.integers(-1000, 1000, (500, 3))])
    tree = clustering.VantageTree.over(centroids)
    measured = []
    meet = clustering.VantageTree._meet
    try:
        clustering.VantageTree._meet = lambda s, v, at, *rest: measured.append(len(at)) or meet(s, v, at, *rest)
        number, distance = tree.nearest(vectors)
    finally:
        clustering.VantageTree._meet = meet
    every = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert number.max() < 150 and sum(measured) < every.size / 3


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_centroids"])
def test_extra_columns_with_inner_names_change_nothing(spark, tmp_path, name):
    ship_package(spark)
    rows = [(i, v, label) for i, v, label in clustered(6, 60, dim=64)]
    plain = spark.createDataFrame(rows, SCHEMA)
    extra = ("dim", "cell", "lane", "kind", "asking", "cluster", "sums", "spread", "low")
    plain.write.parquet(f"{tmp_path}/a/embeddings.parquet")
    plain.selectExpr("*", *[f"'x' AS {c}" for c in extra]).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    assert bag(QUERIES[name](spark, f"{tmp_path}/a")) == bag(QUERIES[name](spark, f"{tmp_path}/b"))

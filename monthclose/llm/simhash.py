"""Near duplicates by SimHash with a Gray-order hierarchical index.

A text becomes words (A-Z lower-cased, separated by ASCII white space), the words shingles, and the 64-bit hashes
of the shingles vote on each bit of the fingerprint. Fingerprints link if they differ in at most ``radius`` bits;
a document's component is the smallest id that can be reached over links.

Equal fingerprints are one node. The 64 bits are cut into ``radius + 2`` blocks; two fingerprints within the radius
agree in at least two whole blocks, so nodes are dealt out once per pair of blocks, keyed by the bits of that pair,
and every link is met in some bucket. All buckets of a task form one index: sorted by bucket and Gray rank, a forest
whose upper nodes hold the bits all their codes agree in and whose lower nodes only what is left. Every search goes
down from the top of its bucket, adds up differences on the way and leaves a whole group as soon as they exceed the
radius; there is no other way to a link. A bucket of many nodes (near copies of one text) is cut into parts, and each
pair of parts is a task of its own; a task hands on a spanning forest of such a bucket's links, not all pairs.
Components come from star contraction over these edges.

Null and empty texts, and texts of white space, have fingerprint zero and are linked like any other. Null ids lose
against any other id. Repeated rows share a component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthclose.llm.common import ROW_KEY, carried, numbers, one_row_per_key, runs, settle, with_row_key

WORDS, RADIUS, SEED = 4, 4, 42
#: Nodes of a bucket that one task compares with each other; larger buckets are cut into parts.
PART_NODES = 4_096
#: Codes under a leaf, nodes under an inner node; shingles that vote, codes that search, and codes held, at a time.
LEAF, FAN = 8, 4
VOTES, SEARCHES, HELD = 1 << 16, 1 << 16, 1 << 17
#: Of runs of more codes (often near copies of one text) a spanning forest is handed on, of smaller ones every link.
DENSE = 48


def _vote(hashes: np.ndarray) -> int:
    """Majority of each bit of big-endian hashes, as a signed 64-bit number."""
    votes = np.zeros(64, np.int64)
    for a in range(0, len(hashes), VOTES):
        votes += np.unpackbits(hashes[a : a + VOTES].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes)).view(">i8")[0])


def _shingle_hashes(text: str | None, words: int) -> np.ndarray:
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.empty(0, ">u8")
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - words + 1)
    last = ends[words - 1 :] if len(tokens) >= words else ends[-1:]
    digest = xxhash.xxh64_digest
    return np.frombuffer(
        b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)]), ">u8"
    )


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """As a signed 64-bit number."""
    hashes = _shingle_hashes(text, words)
    return _vote(hashes) if len(hashes) else 0


def fingerprints(docs: DataFrame, words: int = WORDS, columns: list | None = None) -> DataFrame:
    """``columns`` (doc_id) and fp of every row; whole texts are read where they lie."""
    chosen = docs.select(*(columns or [F.col("doc_id").cast("long").alias("doc_id")]), F.col("text").alias("text"))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, words) for t in batch.column(batch.num_columns - 1).to_pylist()]
            arrays = [*batch.columns[:-1], pa.array(prints, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], "fp"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(mapped, f"{kinds}, fp long")


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``radius + 2`` blocks that cover 64 bits."""
    edges = np.linspace(0, 64, radius + 3).round().astype(int).tolist()
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _bits(fp: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND((1 << width) - 1)


def buckets(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, table, bucket): a node once per pair of blocks."""
    blocks = _blocks(radius)
    keys = []
    for number, (i, j) in enumerate(combinations(range(len(blocks)), 2)):
        bits = F.shiftleft(_bits(F.col("fp"), *blocks[i]), blocks[j][1]).bitwiseOR(_bits(F.col("fp"), *blocks[j]))
        keys.append(bits * 64 * 64 + number)
    return nodes.select("fp", F.explode(F.array(*keys)).alias("bucket"))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence: the running parity of its bits from the top."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


class GrayIndex:
    """Codes by run (bucket) and Gray rank, under a forest of nodes that hold the bits all codes below agree in.

    ``levels`` go from the leaves upwards: (pattern, mask, place of the first child and behind the last one)."""

    def __init__(self, codes: np.ndarray, run: np.ndarray | None = None):
        run = np.zeros(len(codes), np.int64) if run is None else run
        order = np.lexsort((gray_rank(codes), run))
        self.codes, self.run = codes[order], run[order]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.visited = 0
        low, high, owner, size = self.codes, self.codes, self.run, LEAF
        while len(low) and (not self.levels or (owner[FAN:] == owner[:-FAN]).any()):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            place = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
            at = np.flatnonzero(place % size == 0)
            low, high, owner = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at), owner[at]
            self.levels.append((low, ~(low ^ high), np.append(at, len(place))))
            size = FAN
        self.top = owner

    def near(self, queries: np.ndarray, radius: int, run: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query number, place of the code) of all pairs of one run within the radius."""
        run = np.zeros(len(queries), np.int64) if run is None else run
        begin, end = np.searchsorted(self.top, run), np.searchsorted(self.top, run, "right")
        query, node = _spread(begin, end)
        apart = np.zeros(len(query), np.int64)
        above = np.zeros(len(query), np.uint64)  # bits counted already
        for level in range(len(self.levels) - 1, -2, -1):
            if level >= 0:
                pattern, mask, edges = self.levels[level]
                shared = mask[node]
            else:
                pattern, shared = self.codes, ~np.uint64(0)
            self.visited += len(node) if level >= 0 else 0
            apart = apart + np.bitwise_count((queries[query] ^ pattern[node]) & shared & ~above)
            keep = apart <= radius
            query, node, apart = query[keep], node[keep], apart[keep]
            if level >= 0:
                above = shared[keep]
                parent, child = _spread(edges[node], edges[node + 1])
                query, apart, above, node = query[parent], apart[parent], above[parent], child
        return query, node


def _spread(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, x) for every i and every x from begin[i] to before end[i]."""
    count = end - begin
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + begin[owner]


def _roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest member of each member's component."""
    root = np.arange(n)
    for a, b in pairs:
        if not root.any():
            break  # all are one component; more links change nothing
        while len(a):
            x, y = root[a], root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def _forest(codes: np.ndarray, others: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what is linked within ``codes``, or between ``codes`` and ``others``."""
    index = GrayIndex(codes)
    asking = index.codes if others is None else others
    every = index.codes if others is None else np.concatenate([index.codes, others])
    shift = 0 if others is None else len(codes)

    def pairs():
        for at in range(0, len(asking), 256):
            query, place = index.near(asking[at : at + 256], radius)
            yield query + at + shift, place

    root = _roots(len(every), pairs())
    member = np.flatnonzero(root != np.arange(len(every)))
    return every[root[member]], every[member]


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Sorted by (bucket, a, b): edges of each run. Runs of one task are searched together."""
    blocks = _blocks(radius)
    # By which blocks two codes agree in: the first table in whose buckets they meet.
    first = np.full(1 << len(blocks), -1)
    for number, (i, j) in reversed(list(enumerate(combinations(range(len(blocks)), 2)))):
        agreeing = np.arange(len(first))
        first[(agreeing >> i) & (agreeing >> j) & 1 == 1] = number

    def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        a, b = a.view(np.int64), b.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["u", "v"])

    def together(codes: np.ndarray, run: np.ndarray, table: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Every link of many runs, handed on by the first table it is met in."""
        index = GrayIndex(codes, run)
        for at in range(0, len(codes), SEARCHES):
            asking = index.codes[at : at + SEARCHES]
            query, place = index.near(asking, radius, index.run[at : at + SEARCHES])
            once = query + at < place
            query, place = query[once], place[once]
            differ, agreeing = asking[query] ^ index.codes[place], np.zeros(len(query), np.int64)
            for number, (bit, width) in enumerate(blocks):
                free = (differ >> np.uint64(bit)) & np.uint64((1 << width) - 1) == 0
                agreeing |= free.astype(np.int64) << number
            mine = first[agreeing] == table[index.run[place]]
            yield edges(asking[query[mine]], index.codes[place[mine]])

    held: list[np.ndarray] = []
    tables: list[int] = []
    held_rows, here, parts = 0, None, []

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal held_rows
        if here is None:
            return
        codes = np.concatenate([p[0] for p in parts]).view(np.uint64)
        left = np.concatenate([p[1] for p in parts])
        bucket, a, b = here
        if a != b:
            if left.any() and not left.all():
                yield edges(*_forest(codes[left], codes[~left], radius))
        elif len(codes) > DENSE:
            yield edges(*_forest(codes, None, radius))
        elif len(codes) > 1:
            held.append(codes)
            tables.append(bucket % 4096)
            held_rows += len(codes)

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal held, held_rows, tables
        if held:
            run = np.repeat(np.arange(len(held)), [len(c) for c in held])
            yield from together(np.concatenate(held), run, np.array(tables))
        held, tables, held_rows = [], [], 0

    for key, rows in runs(batches, ("bucket", "a", "b")):
        if key != here:
            yield from close()
            here, parts = key, []
            if held_rows > HELD:
                yield from flush()
        parts.append((numbers(rows.column("fp")), rows.column("left").to_numpy(zero_copy_only=False)))
    yield from close()
    yield from flush()


def links(nodes: DataFrame, radius: int = RADIUS, part_nodes: int = PART_NODES) -> DataFrame:
    """(u, v), u < v: edges that connect exactly what links within the radius connect."""
    dealt = buckets(nodes, radius)
    sizes = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    large = settle(sizes.where(F.col("n") > part_nodes).select("bucket", F.ceil(F.col("n") / part_nodes).cast("int").alias("parts")))
    cut = dealt.join(large, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    spread = (
        cut.withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "bucket",
            F.least("part", "other").alias("a"),
            F.greatest("part", "other").alias("b"),
            (F.col("part") <= F.col("other")).alias("left"),
            "fp",
        )
    )
    sorted_runs = spread.repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b")
    return sorted_runs.mapInArrow(lambda batches: _links(batches, radius), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of every node that has an edge; root is the component's smallest node. Star contraction: every
    node's larger neighbours, then its smaller ones, are hung under the smallest it knows, until nothing moves."""
    edges = settle(edges)
    before = None
    while True:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u < v").distinct()
        large = settle(large)
        down = large.toDF("w", "u")  # every u has smaller neighbours w
        least = down.groupBy("u").agg(F.min("w").alias("m"))
        small = down.join(least, "u").select(F.col("m"), F.col("w"))
        edges = settle(
            small.where("m < w").union(least.select("m", F.col("u").alias("w"))).distinct().toDF("u", "v")
        )
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return edges.select("v", F.col("u").alias("root"))
        before = mark


def rooted(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``nodes`` (distinct fp and whatever else) plus the root of each one's component."""
    roots = settle(components(links(nodes.select("fp"), radius)))
    return nodes.join(roots.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint of ``prints`` (doc_id, fp)."""
    nodes = rooted(settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least"))), radius)
    named = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    return nodes.join(named, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    prints = settle(fingerprints(docs, words))
    return prints.join(classes(prints, radius), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the one of smallest id, of rows that share it the one whose id and
    text have the smallest hash, of equal ones any. All columns as they came, whatever their names."""
    keyed = with_row_key(carried(docs))
    chosen = [F.col("row.doc_id").cast("long").alias("doc_id"), *ROW_KEY]
    prints = settle(fingerprints(keyed.select("*", "row.text"), words, chosen))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", *ROW_KEY))
    nodes = rooted(settle(prints.groupBy("fp").agg(first.alias("first"))), radius)
    best = nodes.groupBy("root").agg(F.min("first").alias("first")).select(*[F.col(f"first.{k}") for k in ROW_KEY])
    same = prints.groupBy(*ROW_KEY).agg(F.count(F.lit(1)).alias("n"))
    return one_row_per_key(keyed, best.join(same, list(ROW_KEY)))

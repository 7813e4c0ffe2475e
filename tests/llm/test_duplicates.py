"""Exact and near duplicates, and the top-k search, against brute force."""

import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from monthclose.llm import exact_dedup, simhash, topk
from monthclose.llm.common import columns_of, ship_package
from .conftest import ROWS


def by_text(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", "", text or "")].append((-len(text or ""), i is None, i or 0))
    return groups


def test_exact_groups(docs):
    rows = exact_dedup.digests(docs)
    found = exact_dedup.exact_dedup(rows, exact_dedup.own_history(rows)).collect()
    groups = by_text(ROWS)
    assert sum(r.kept for r in found) == len(groups)
    want = Counter()
    for text, members in groups.items():
        n, absent, keep = min(members)
        for _, none, i in members:
            want[(None if none else i, None if absent else keep, len(members))] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found) == want


def test_history_of_an_earlier_table(spark, docs):
    """Members of the history go, with the winner on record; nonmembers are grouped among themselves."""
    rows = exact_dedup.digests(docs)
    known = rows.where("doc_id = 11").selectExpr("digest", "99L AS keep_id", "cast(null AS long) AS keep_row", "7L AS group_size")
    found = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(rows, known).collect()}
    assert (11, 99, 7, False) in found
    assert {(12, 12, 1, True), (2, 2, 1, True), (1, 1, 2, True), (1, 1, 2, False)} <= found


def test_small_shards_and_many_copies(docs):
    rows = exact_dedup.digests(docs)
    history = exact_dedup.winners(rows)
    found = exact_dedup.look_up(rows, history, shard_digests=2, copy_rows=1).collect()
    assert len(found) == len(ROWS) and all(r.hit for r in found)


@pytest.mark.parametrize(("parts", "shard", "copy"), [(1, 2, 1), (2, 3, 4), (3, 50_000, 2), (50, 1, 200_000)])
def test_members_and_nonmembers_in_groups(spark, parts, shard, copy):
    """Whatever part of a table is indexed: winners and sizes per slot, groups of several among nonmembers too."""
    ship_package(spark)
    texts = [(n if n % 11 else None, "a b"[: n % 4] + f"{n * n % 13}" + " " * (n % 3)) for n in range(120)]
    rows = exact_dedup.digests(spark.createDataFrame([*texts, (500, None), (None, " ")], "doc_id long, text string"))
    history = exact_dedup.own_history(rows, parts, shard, copy)
    sizes = {bytes(r.digest): r.n for r in rows.groupBy("digest").agg({"row": "count"}).toDF("digest", "n").collect()}
    want = {bytes(r.digest): (r.keep_id, r.keep_row, r.group_size) for r in exact_dedup.winners(rows).collect()}
    on_record = {bytes(r.digest): (r.keep_id, r.keep_row, r.group_size) for r in history.collect()}
    assert on_record.items() <= want.items()
    assert (len(on_record) == len(want)) == (parts == 1)
    if parts == 50:
        assert any(sizes[d] > 1 for d in want.keys() - on_record.keys())
    found = exact_dedup.exact_dedup(rows, history).collect()
    assert len(found) == 122
    for r in found:
        keep_id, keep_row, n = want[bytes(r.digest)]
        assert (r.keep_id, r.keep_row, r.group_size, r.kept) == (keep_id, keep_row, n, r.row == keep_row)


@pytest.mark.parametrize("n", [0, 1, 2, 3000])
def test_perfect_hash(n):
    words = np.random.default_rng(n).integers(0, 2**63, (n, 2)).astype(np.uint64)
    hashed = exact_dedup.PerfectHash(words)
    assert sorted(hashed.slots(words).tolist()) == list(range(n))


def test_dedup_keeps_one_row_and_all_columns(docs, nothing):
    kept = exact_dedup.dedup_rows(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(by_text(ROWS))
    assert {r.text for r in kept.collect()} >= {"alpha  beta\tgamma delta\nepsilon zeta.", "no id here at all"}
    assert exact_dedup.dedup_rows(nothing).count() == 0


def fingerprint(text, n):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def reachable(codes, radius):
    root = list(range(len(codes)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= radius:
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(codes))]


def test_fingerprints(docs):
    found = Counter((r.doc_id, r.fp & (2**64 - 1)) for r in simhash.fingerprints(docs).collect())
    assert found == Counter((i, fingerprint(t, 4)) for i, t, *_ in ROWS)
    assert Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect())[(3, 3)] == 1


@pytest.mark.parametrize("part_nodes", [40, 4096])
def test_components_equal_all_pairs(spark, part_nodes):
    """Chains of near codes, a dense cluster and lone codes, with buckets cut into parts and whole."""
    draw = np.random.default_rng(11)
    codes = []
    for _ in range(20):
        code = int(draw.integers(0, 2**63))
        for _ in range(12):
            codes.append(code)
            for bit in draw.choice(64, int(draw.integers(1, 6)), replace=False):
                code ^= 1 << int(bit)
    base = int(draw.integers(0, 2**63))
    for _ in range(150):
        codes.append(base ^ sum(1 << int(b) for b in draw.choice(64, int(draw.integers(0, 4)), replace=False)))
    codes += [int(c) for c in draw.integers(0, 2**63, 100)]
    codes = sorted(set(codes))
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(c, i) for i, c in enumerate(signed)], "fp long, doc_id long")
    edges = simhash.links(nodes.select("fp"), 4, part_nodes).collect()
    place = {c: i for i, c in enumerate(signed)}
    root = list(range(len(codes)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for u, v in edges:
        x, y = top(place[u]), top(place[v])
        root[max(x, y)] = min(x, y)
    assert [top(i) for i in range(len(codes))] == reachable(codes, 4)
    named = {r.fp: r.component_id for r in simhash.classes(nodes).collect()}
    assert [named[c] for c in signed] == reachable(codes, 4)


def test_gray_index_finds_all_pairs():
    draw = np.random.default_rng(5)
    codes = np.unique(draw.integers(0, 2**14, 700).astype(np.uint64))
    index = simhash.GrayIndex(codes)
    query, place = index.near(codes, 3)
    found = {(int(codes[q]), int(index.codes[p])) for q, p in zip(query, place, strict=True)}
    want = {(int(a), int(b)) for a in codes for b in codes if int(a ^ b).bit_count() <= 3}
    assert found == want


def test_one_of_each(docs, nothing):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    named = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert kept.count() == len({c for _, c in named})
    assert simhash.one_of_each(nothing).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 400])
def test_gray_index_over_many_runs(n):
    draw = np.random.default_rng(n)
    codes, run = draw.integers(0, 2**12, n).astype(np.uint64), draw.integers(0, 1 + n // 9, n)
    index = simhash.GrayIndex(codes, run)
    query, place = index.near(codes, 2, run)
    found = Counter((int(run[q]), int(codes[q]), int(index.codes[p])) for q, p in zip(query, place, strict=True))
    assert all(run[q] == index.run[p] for q, p in zip(query, place, strict=True))
    assert found == Counter(
        (int(run[i]), int(codes[i]), int(codes[j]))
        for i in range(n)
        for j in range(n)
        if run[i] == run[j] and int(codes[i] ^ codes[j]).bit_count() <= 2
    )


def test_upper_nodes_prune_groups():
    draw = np.random.default_rng(8)
    heads = draw.integers(0, 2**51, 64) << 12  # groups that share all but twelve bits
    codes = np.unique((draw.choice(heads, 4096) + draw.integers(0, 2**12, 4096)).astype(np.uint64))
    index = simhash.GrayIndex(codes)
    index.near(codes[:100], 4)
    assert 0 < index.visited < 0.5 * 100 * sum(len(level[0]) for level in index.levels)


def test_links_of_driver_documents_come_from_the_tree(spark, monkeypatch):
    """Each link that is handed on was found by a search that went down through nodes of the index."""
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001") + "/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no driver tables")
    nodes = simhash.fingerprints(spark.read.parquet(path)).select("fp").distinct()
    dealt = simhash.buckets(nodes).selectExpr("bucket", "0 AS a", "0 AS b", "true AS left", "fp").orderBy("bucket")
    visited, near = [], simhash.GrayIndex.near

    def counted(index, *args):
        before = index.visited
        found = near(index, *args)
        visited.append((index.visited - before, len(found[0])))
        return found

    monkeypatch.setattr(simhash.GrayIndex, "near", counted)
    edges = [b for b in simhash._links(iter(dealt.toArrow().to_batches()), 4) if b.num_rows]
    assert edges and visited and all(nodes_seen > 0 for nodes_seen, hits in visited if hits)
    monkeypatch.undo()
    codes = [r.fp for r in nodes.collect()]
    place = {c: i for i, c in enumerate(sorted(codes))}
    root = np.arange(len(codes))
    for batch in edges:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            x, y = root[place[u]], root[place[v]]
            root[root == max(x, y)] = min(x, y)
    assert root.tolist() == reachable([c & (2**64 - 1) for c in sorted(codes)], 4)


def test_votes_in_blocks(monkeypatch):
    text = " ".join(f"w{n % 37}" for n in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "VOTES", 7)
    assert simhash.fingerprint(text) == whole
    assert whole & (2**64 - 1) == fingerprint(text, 4)


VECTORS = [(i, [float(x) for x in row]) for i, row in enumerate(np.random.default_rng(2).normal(0, 0.2, (500, 8)))]
ODD = [(1000, None), (1100, []), (1200, [float("nan")] * 8), (1300, [None] * 8), (None, [0.5] * 8), (200, VECTORS[200][1]), (1400, [1.0, 2.0])]


def best(vectors, k):
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in vectors if v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in whole if i is not None and i % 100 == 0}:
        scored = [(-sum(x * y for x, y in zip(a, v, strict=True)), c is None, c or 0) for c, v in whole if c != q and len(v) == len(a)]
        out |= {(q, n + 1, None if none else c, -s) for n, (s, none, c) in enumerate(sorted(scored)[:k])}
    return out


def test_top_k(spark):
    rows = [*VECTORS, *ODD]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = topk.whole_vectors(df)
    found = topk.top_k(vectors, vectors.where("vec_id % 100 = 0")).collect()
    assert {tuple(r) for r in found} == best(rows, 10)
    assert topk.top_k(vectors.where("vec_id < 0"), vectors.where("vec_id < 0")).count() == 0


def test_search_over_several_blocks_prunes_and_stays_exact():
    draw = np.random.default_rng(4)
    centers = draw.integers(-900, 900, (6, 16))
    points = (centers[draw.integers(0, 6, 3000)] + draw.integers(-20, 20, (3000, 16))).astype(float)
    ids = np.arange(3000)
    search = topk.Search(ids[:300], points[:300], 10)
    seen = []
    compare = search._compare
    search._compare = lambda q, r, *rest: (seen.append(len(q) * len(r)), compare(q, r, *rest))
    for at in range(0, 3000, 1000):
        search.meet(ids[at : at + 1000], points[at : at + 1000])
    scores = points[:300] @ points.T
    scores[np.arange(300), np.arange(300)] = -np.inf
    want = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)[:, :10]
    assert (search.found == want).all()
    assert sum(seen) < 0.9 * 300 * 3000


def test_top_k_is_exact_beyond_doubles(spark):
    """Products of components of 1e5 lie above 2**53, where doubles would confuse neighbouring scores."""
    draw = np.random.default_rng(8)
    near = [(i, [1e5 + float(d) / 1024 for d in draw.integers(0, 3, 64)]) for i in range(300)]
    rows = [*near, (5000, [-x for x in near[0][1]]), (5001, near[7][1])]
    vectors = topk.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = topk.top_k(vectors, vectors.where("vec_id % 100 = 0")).collect()
    want = best(rows, 10)
    assert max(s for *_, s in want) > 2**53
    assert {tuple(r) for r in found} == want


def test_top_k_refuses_what_no_whole_number_holds(spark):
    vectors = topk.whole_vectors(spark.createDataFrame([(100, [1e300, 1.0])], "vec_id long, embedding array<double>"))
    with pytest.raises(Exception, match="does not fit"):
        vectors.collect()


def test_columns_with_dots(docs):
    assert "a.b" in docs.select(*columns_of(docs)).columns

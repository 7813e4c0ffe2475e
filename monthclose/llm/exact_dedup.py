"""Exact duplicates by a minimal perfect hash over the distinct digests of a history.

Texts are equal when they are identical after all white space of ``[\\x20\\x09-\\x0D]`` is deleted; their SHA-256
is compared in full. The history is a table of distinct digests, dealt out by digest into shards; a task builds a
minimal perfect hash over one shard, whose slots hold the full digest and the locator of the winner. Rows look
their digest up in the slot it hashes to and are members if all 32 bytes agree. Members are repeats unless they are
the winner on record. Rows whose digest is no member are grouped among themselves.

An earlier table may be the history (``exact_dedup`` takes its winners). A table without one is its own: the distinct
digests of a first part of its rows are indexed, all rows look into them, and each task keeps the best row and the
number of rows of every slot; these are put together per slot (``own_history``). Groups with no row in the first part
are left to the nonmembers.

Shards that many rows look into (a third of all rows may be copies of one text) are given several tasks, each
with a copy of the shard's small index, so no task's share grows with a group; nonmembers find their group likewise.

Nulls count as empty texts. A null id loses against any other id. Of rows that agree in id and text exactly one
stays. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.llm.common import (
    ROW_KEY,
    WHITE,
    carried,
    numbers,
    one_row_per_key,
    raw_bytes,
    runs,
    settle,
    text_or_empty,
    with_row_key,
)

#: Digests per shard of the index, and rows that look into one copy of a shard.
SHARD_DIGESTS = 50_000
COPY_ROWS = 200_000
#: Only shards of more than one in so many rows are copied, so there are no more of them than that.
COPIED_SHARDS = 4_096
#: A table without a history takes one of so many parts of its rows, dealt by a hash, as the first.
HISTORY_PARTS = 2

DIGEST_COLUMNS = ["row", "doc_id", "n_chars", "digest"]


def digest_of(text: str = "text"):
    return F.unhex(F.sha2(F.regexp_replace(text_or_empty(text), WHITE, "").cast("binary"), 256))


def digests(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_chars, digest) of every row, written down once: texts are read no second time."""
    return settle(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.length(text_or_empty()).cast("long").alias("n_chars"),
            digest_of().alias("digest"),
        )
    )


def winners(rows: DataFrame, times: str = "1") -> DataFrame:
    """(digest, keep_id, keep_row, group_size): longest original text, then smallest id, then first row. A row counts
    ``times``."""
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("absent"), "doc_id", "row"))
    return (
        rows.groupBy("digest")
        .agg(best.alias("best"), F.sum(F.expr(times)).cast("long").alias("group_size"))
        .select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")
    )


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys: bit arrays by level, slot = rank of the key's bit.

    A key's bit on a level is set if no other key left on that level hashes there; the others go to the next
    level. What is left after the last level (keys alike in all 128 bits) is held in a small table.
    """

    LEVELS, LOAD = 48, 2.0

    def __init__(self, words: np.ndarray):
        self.bits: list[np.ndarray] = []
        self.rank: list[np.ndarray] = []
        self.size = 0
        left = np.arange(len(words))
        for level in range(self.LEVELS):
            if not len(left):
                break
            at = self._place(words[left], level, max(2, int(self.LOAD * len(left))))
            taken = np.bincount(at, minlength=max(2, int(self.LOAD * len(left)))) == 1
            self.bits.append(taken)
            self.rank.append(np.cumsum(taken) - 1 + self.size)
            self.size += int(taken.sum())
            left = left[~taken[at]]
        self.rest = {bytes(words[i]): self.size + n for n, i in enumerate(left.tolist())}
        self.size += len(left)

    @staticmethod
    def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = words[:, 0] + words[:, 1] * np.uint64(2 * level + 1) + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    def slots(self, words: np.ndarray) -> np.ndarray:
        """Slot of each key; keys that are no members get any slot or -1."""
        out = np.full(len(words), -1, np.int64)
        left = np.arange(len(words))
        for level, (bits, rank) in enumerate(zip(self.bits, self.rank, strict=True)):
            if not len(left):
                return out
            at = self._place(words[left], level, len(bits))
            found = bits[at]
            out[left[found]] = rank[at[found]]
            left = left[~found]
        for i in left.tolist() if self.rest else ():
            out[i] = self.rest.get(bytes(words[i]), -1)
        return out


class _Shard:
    """The index of one shard: digests, and what the history says of each, in slot order."""

    def __init__(self, batches: list[pa.RecordBatch], payload: Sequence[str]):
        table = pa.Table.from_batches(batches).combine_chunks() if batches else None
        digest = raw_bytes(table.column("digest").chunk(0), 32) if table else np.empty((0, 32), np.uint8)
        words = np.ascontiguousarray(digest).view(np.uint64)
        self.hash = PerfectHash(words[:, :2].copy())
        order = np.empty(len(words), np.int64)
        order[self.hash.slots(words[:, :2].copy())] = np.arange(len(words))
        self.words = words[order]
        take = pa.array(order)
        self.payload = [table.column(c).chunk(0).take(take) if table else pa.nulls(0, pa.int64()) for c in payload]

    def slots(self, batch: pa.RecordBatch) -> np.ndarray:
        """The slot that holds each row's digest, all of its bytes compared; -1 where none does."""
        words = np.ascontiguousarray(raw_bytes(batch.column("digest"), 32)).view(np.uint64)
        slot = self.hash.slots(words[:, :2].copy())
        hit = slot >= 0
        hit[hit] = (self.words[slot[hit]] == words[hit]).all(axis=1)
        return np.where(hit, slot, -1)


def _by_shard(batches: Iterator[pa.RecordBatch], payload: Sequence[str]) -> Iterator[tuple[_Shard, pa.RecordBatch]]:
    """Sorted by (shard, copy, kind): the members of a shard come before the rows that look them up."""
    here, members, shard = None, [], None
    for (part, copy, kind), rows in runs(batches, ("shard", "copy", "kind")):
        if (part, copy) != here:
            here, members, shard = (part, copy), [], None
        if kind == 0:
            members.append(rows)
            continue
        if shard is None:
            shard, members = _Shard(members, payload), []
        yield shard, rows


LOCATOR = ["keep_id", "keep_row", "group_size"]


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard, rows in _by_shard(batches, LOCATOR):
        slot = shard.slots(rows)
        index = pa.array(np.maximum(slot, 0), mask=slot < 0)
        yield pa.RecordBatch.from_arrays(
            [rows.column(c) for c in DIGEST_COLUMNS] + [pa.array(slot >= 0)] + [c.take(index) for c in shard.payload],
            names=[*DIGEST_COLUMNS, "hit", *LOCATOR],
        )


class _Tally:
    """The best row and the number of rows of each slot, over the rows one task sees of a shard."""

    def __init__(self, shard: _Shard):
        self.shard = shard
        self.count = np.zeros(shard.hash.size, np.int64)
        self.best = np.full((shard.hash.size, 4), np.iinfo(np.int64).max)  # -n_chars, id is null, id, row

    def add(self, rows: pa.RecordBatch) -> None:
        slot = self.shard.slots(rows)
        member = np.flatnonzero(slot >= 0)
        slot = slot[member]
        doc_id = rows.column("doc_id")
        order_by = np.stack(
            [
                -numbers(rows.column("n_chars")),
                doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
                numbers(doc_id.fill_null(0)),
                numbers(rows.column("row")),
            ],
            axis=1,
        )[member]
        np.add.at(self.count, slot, 1)
        met = np.unique(slot)
        slot, order_by = np.append(slot, met), np.concatenate([order_by, self.best[met]])
        sort = np.lexsort((*order_by.T[::-1], slot))
        first = sort[np.flatnonzero(np.diff(slot[sort], prepend=-1))]
        self.best[slot[first]] = order_by[first]

    def result(self) -> pa.RecordBatch:
        met = np.flatnonzero(self.count)
        n, absent, doc_id, row = self.best[met].T
        digest = pa.array([w.tobytes() for w in self.shard.words[met]], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(row), pa.array(doc_id, mask=absent == 1), pa.array(-n), digest, pa.array(self.count[met])],
            names=[*DIGEST_COLUMNS, "n"],
        )


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = None
    for shard, rows in _by_shard(batches, ()):
        if tally is None or tally.shard is not shard:
            if tally is not None:
                yield tally.result()
            tally = _Tally(shard)
        tally.add(rows)
    if tally is not None:
        yield tally.result()


def _dealt(rows: DataFrame, history: DataFrame, shard_digests: int, copy_rows: int) -> DataFrame:
    """Rows (kind 1) beside a copy of the shard of the history (kind 0) that their digest belongs to."""
    shards = max(1, -(-history.count() // shard_digests))
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")
    placed = rows.withColumn("shard", shard)
    most = max(copy_rows, -(-rows.count() // COPIED_SHARDS))
    hot = placed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("copies")).where("copies > 1")
    hot = F.broadcast(hot)  # no more than COPIED_SHARDS rows
    copies = F.coalesce("copies", F.lit(1))
    asking = placed.join(hot, "shard", "left").select(
        "shard",
        F.pmod(F.xxhash64("row"), copies).cast("int").alias("copy"),
        F.lit(1).alias("kind"),
        *DIGEST_COLUMNS,
    )
    members = (
        history.withColumn("shard", shard)
        .join(hot, "shard", "left")
        .select(
            "shard",
            F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"),
            F.lit(0).alias("kind"),
            *history.columns,
        )
    )
    both = asking.unionByName(members, allowMissingColumns=True)
    return both.repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind")


def look_up(rows: DataFrame, history: DataFrame, shard_digests: int = SHARD_DIGESTS, copy_rows: int = COPY_ROWS):
    """``rows`` plus hit, keep_id, keep_row and group_size from the perfect-hash index over ``history``."""
    return _dealt(rows, history.select("digest", *LOCATOR), shard_digests, copy_rows).mapInArrow(
        _look_up,
        "row long, doc_id long, n_chars long, digest binary, hit boolean, keep_id long, keep_row long, group_size long",
    )


def own_history(
    rows: DataFrame, parts: int = HISTORY_PARTS, shard_digests: int = SHARD_DIGESTS, copy_rows: int = COPY_ROWS
) -> DataFrame:
    """The history a table is to itself: the distinct digests of a first part of ``rows``, with the winner among all
    rows and their number, as counted slot by slot where all rows look into the index over these digests."""
    first = rows.where(F.pmod(F.xxhash64("row"), F.lit(parts)) == 0)
    digests = settle(first.select("digest").distinct())
    met = _dealt(rows, digests, shard_digests, copy_rows).mapInArrow(
        _tallied, "row long, doc_id long, n_chars long, digest binary, n long"
    )
    return settle(winners(met, "n"))


def exact_dedup(rows: DataFrame, history: DataFrame) -> DataFrame:
    """One row per row of ``rows`` (as ``digests`` gives them): row, doc_id, digest, keep_id, group_size, kept.

    ``history`` is (digest, keep_id, keep_row, group_size) with distinct digests. A member of it is kept only if
    its own row is the winner on record (keep_row); a winner from an earlier table has keep_row null.
    """
    found = settle(look_up(rows, history))
    others = found.where("NOT hit").select(*DIGEST_COLUMNS)
    groups = settle(winners(others).where("group_size > 1"))
    grouped = look_up(others, groups)
    alone = ~F.col("hit")
    grouped = grouped.withColumns(
        {
            "keep_id": F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")),
            "keep_row": F.when(alone, F.col("row")).otherwise(F.col("keep_row")),
            "group_size": F.when(alone, F.lit(1)).otherwise(F.col("group_size")),
        }
    )
    columns = ["row", "doc_id", "digest", *LOCATOR]
    every = found.where("hit").select(*columns).unionByName(grouped.select(*columns))
    return every.withColumn("kept", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)))


def dedup_rows(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that repeat another's text; all columns as they came, whatever their names."""
    keyed = with_row_key(carried(docs))
    narrow = settle(
        keyed.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("row.doc_id").cast("long").alias("doc_id"),
            F.length(text_or_empty("row.text")).cast("long").alias("n_chars"),
            digest_of("row.text").alias("digest"),
            *ROW_KEY,
        )
    )
    rows = narrow.select(*DIGEST_COLUMNS)
    kept = exact_dedup(rows, own_history(rows)).where("kept").select("row")
    same = narrow.groupBy(*ROW_KEY).agg(F.count(F.lit(1)).alias("n"))
    staying = narrow.join(kept, "row").select(*ROW_KEY).join(same, list(ROW_KEY))
    return one_row_per_key(keyed, staying)

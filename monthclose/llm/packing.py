"""Packing examples into sequences by vector bin packing.

Every sequence is limited in tokens, in segments and in loss-bearing tokens at once. Full stretches of long
examples become sequences of their own; the rest wait in a window. The open sequence takes the waiting piece with
the largest dot product between the piece's demands and the room left, each weighted by how scarce it is in the
window; if no piece fits whole, the best one is cut to fill the sequence to its limit. What is open when a task
ends is dealt into sequences whose lengths are powers of two, which need no padding.

All of it happens where a row is read: nothing is shuffled, and a task holds one window of pieces. A task's
sequences depend on its own rows and their order alone, so the rows should come from files, not straight from a
shuffle; a retried task then repeats them.

Instruction data come as a prompt and a response, encoded one after the other; the prompt's tokens bear no loss, those
of the response and the end id do. A document is an example without prompt.

A null text, prompt or response is empty: without both, an example consists of the end id. Repeated rows are packed as often as they come. An
empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from monthclose.llm.tokens import Vocabulary, byte_bpe

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "loss_tokens long"
)
WINDOW = 2048


@dataclass(frozen=True)
class Limits:
    """Of one sequence: tokens (a power of two), segments, loss-bearing tokens."""

    tokens: int = 1024
    segments: int = 64
    loss: int = 1024

    def __post_init__(self):
        if self.tokens < 1 or self.tokens & (self.tokens - 1):
            raise ValueError("tokens must be a power of two")
        if self.segments < 1 or self.loss < 1:
            raise ValueError("segments and loss must be at least 1")


class Packer:
    """Packs examples that come one by one; ``done`` holds (example, start, length, sequence, offset)."""

    def __init__(self, limits: Limits, first_sequence: int = 0, window: int = WINDOW, cut: bool = True):
        self.limits, self.next, self.cut, self.window = limits, first_sequence, cut, window
        self.waiting: list[tuple[object, int, int, int]] = []  # example, start, tokens, of which prompt
        self.done: list[tuple[object, int, int, int, int]] = []
        self.open: list[tuple[object, int, int, int]] = []
        self.used = np.zeros(3)

    def add(self, example: object, tokens: int, prompt: int = 0) -> None:
        """``prompt``: how many tokens at the start bear no loss."""
        full, start = self.limits.tokens, 0
        while self.cut and tokens - start >= full and full - max(0, min(prompt - start, full)) <= self.limits.loss:
            self.done.append((example, start, full, self._new(), 0))
            start += full
        if tokens > start:
            self.waiting.append((example, start, tokens - start, max(0, prompt - start)))
        if len(self.waiting) >= self.window:
            self._pack()

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def _close(self) -> None:
        offset, sequence = 0, self._new()
        for example, start, length, _ in self.open:
            self.done.append((example, start, length, sequence, offset))
            offset += length
        self.open, self.used = [], np.zeros(3)

    def _put(self, piece: tuple[object, int, int, int]) -> None:
        self.open.append(piece)
        self.used += (piece[2], 1, max(0, piece[2] - piece[3]))

    def _pack(self) -> None:
        """Place every waiting piece; the last sequence stays open."""
        limit = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
        pieces = self.waiting
        tokens = np.array([p[2] for p in pieces], float)
        prompt = np.array([p[3] for p in pieces], float)
        need = np.stack([tokens, np.ones(len(pieces)), np.maximum(tokens - prompt, 0)], axis=1)
        demand = need / limit
        scarce = demand.mean(axis=0)
        n = len(pieces)
        while n:
            room = limit - self.used
            gain = demand[:n] @ (scarce * room / limit)
            fits = (need[:n] <= room).all(axis=1)
            if room[1] < 2 and self.cut:
                fits &= need[:n, 0] >= room[0]  # the last segment must fill the sequence
            if fits.any():
                best = int(np.argmax(np.where(fits, gain, -1.0)))
                self._put(pieces[best])
            else:
                best = int(np.argmax(np.where(need[:n, 0] >= room[0], gain, -1.0)))
                example, start, length, plain = pieces[best]
                length_cut = int(min(room[0], plain + room[2], length)) if self.cut and room[1] >= 1 else 0
                if length_cut < 1 or (not self.cut):
                    if not self.open:
                        raise ValueError(f"an example of {length} tokens exceeds the limits and may not be cut")
                    self._close()
                    continue
                self._put((example, start, length_cut, min(plain, length_cut)))
                if length_cut < length:
                    pieces[best] = (example, start + length_cut, length - length_cut, max(0, plain - length_cut))
                    need[best] = (length - length_cut, 1, length - length_cut - pieces[best][3])
                    demand[best] = need[best] / limit
                    best = -1
            if best >= 0:
                n -= 1
                pieces[best], need[best], demand[best] = pieces[n], need[n], demand[n]
            if self.used[0] >= limit[0] or self.used[1] >= limit[1] or self.used[2] >= limit[2]:
                self._close()
        self.waiting = []

    def finish(self) -> None:
        self._pack()
        if not self.open:
            return
        if not self.cut:
            self._close()
            return
        rest, self.open, left = self.open, [], int(self.used[0])
        self.used = np.zeros(3)
        while left:
            size = room = 1 << (left.bit_length() - 1)
            while room:
                example, start, length, plain = rest[0]
                part = min(length, room)
                self.open.append((example, start, part, min(plain, part)))
                room -= part
                if part == length:
                    rest.pop(0)
                else:
                    rest[0] = (example, start + part, length - part, max(0, plain - part))
            self._close()
            left -= size


def _packed(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, limits: Limits, window: int):
    encode = byte_bpe(vocabulary)
    packer = Packer(limits, (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33, window)

    def rows() -> pa.RecordBatch:
        out = [[] for _ in range(8)]
        for (doc_id, ids, prompt), start, length, sequence, offset in packer.done:
            values = (
                doc_id,
                start,
                length,
                zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)]),
                len(ids) // 4,
                sequence,
                offset,
                max(0, start + length - max(start, prompt)),
            )
            for column, value in zip(out, values, strict=True):
                column.append(value)
        packer.done = []
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    for batch in batches:
        for doc_id, prompt, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            before = encode(prompt) if prompt else b""
            ids = before + encode(text or "") + b"\0\0\0\0"
            packer.add((doc_id, ids, len(before) // 4), len(ids) // 4, len(before) // 4)
            if len(packer.done) >= 4096:
                yield rows()
    packer.finish()
    yield rows()


def pack_examples(
    examples: DataFrame, vocabulary: Vocabulary | None = None, limits: Limits | None = None, window: int = WINDOW
) -> DataFrame:
    """One row per piece of an example (doc_id, prompt, response); ``loss_tokens`` are those behind the prompt."""
    vocabulary, limits = vocabulary or Vocabulary.from_files(), limits or Limits()
    return examples.selectExpr("cast(doc_id AS long) AS doc_id", "prompt", "response").mapInArrow(
        lambda batches: _packed(batches, vocabulary, limits, window), SCHEMA
    )


def pack_documents(
    docs: DataFrame, vocabulary: Vocabulary | None = None, limits: Limits | None = None, window: int = WINDOW
) -> DataFrame:
    """One row per piece of a document; all of a document's tokens bear loss."""
    examples = docs.selectExpr("doc_id", "cast(null AS string) AS prompt", "text AS response")
    return pack_examples(examples, vocabulary, limits, window)

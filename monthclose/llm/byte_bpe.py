"""Byte-level BPE, there and back: vectorised pre-tokenisation, cached pair merging, decoding by offsets.

The texts of a batch are one array of bytes. Each code point becomes a symbol: its class (letter, number, other, space,
other white space) and, where the split pattern looks ahead, what follows it. An automaton of eight states reads the
symbols and says where a pre-token starts. A symbol is a function from state to state; composing such functions is
associative and, there being only a few dozen different ones, a table look-up. So the states of all code points follow
from a scan: functions are composed within columns of a stretch, then across columns, then every column is walked
again from its known start, all columns at once. No regular expression meets a text. Stretches have a bounded number
of code points and hand their last state on, so a text may be of any length.

Pre-tokens are slices of the bytes; their ids are merged pair by pair, lowest rank first, and remembered. The offset of
each id in its text is kept, and decoding puts each id's bytes there.

A null text is empty: no ids, no bytes. Rows are independent and come back as often as they are given, ids of documents
null or repeated too. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from monthclose.llm.common import utf8, worker_state

#: Code points scanned at a time, and texts' bytes of one output batch (one text at least).
STRETCH, OUT_BYTES = 1 << 18, 1 << 20
#: Pre-tokens a worker remembers (a full cache is emptied), and the longest one remembered, in bytes.
CACHE_ENTRIES, CACHE_BYTES = 200_000, 48
#: Pre-tokens up to so many bytes are merged without a heap.
SHORT_BYTES = 40
NO_RANK = 1 << 40
ENCODED = "doc_id long, ids array<int>, offsets array<int>"

# Classes of code points, and symbols: classes 0 to 2, white space by whether it ends its run before something else,
# apostrophes that may open a contraction of two or three characters.
LETTER, NUMBER, OTHER, SPACE, WHITE = range(5)
SPACE_IN, SPACE_LAST, WHITE_IN, WHITE_LAST, SHORT, LONG = range(3, 9)
SYMBOLS = 9
# States: what the last character belongs to. ENDED: whatever comes next starts a pre-token.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_WHITE, ENDED, ONE_LEFT, TWO_LEFT = range(8)
STATES = 8


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether the character starts a pre-token."""
    if symbol in (SPACE_IN, WHITE_IN):
        return IN_WHITE, state != IN_WHITE
    if symbol == SPACE_LAST:
        return AFTER_SPACE, True
    if symbol == WHITE_LAST:
        return ENDED, True
    if symbol == LETTER and state in (ONE_LEFT, TWO_LEFT):
        return (ENDED if state == ONE_LEFT else ONE_LEFT), False
    run = (IN_LETTERS, IN_NUMBERS)[symbol] if symbol in (LETTER, NUMBER) else IN_OTHERS
    goes_on = state in (run, AFTER_SPACE)
    if symbol in (SHORT, LONG) and not goes_on:
        return (ONE_LEFT if symbol == SHORT else TWO_LEFT), True
    return run, not goes_on


@dataclass(frozen=True)
class Automaton:
    """Functions from state to state that symbols and their compositions make; all tables are look-ups.

    ``compose[f, g]``: first f, then g. ``of_symbol``: symbols, then the same as a text's first character."""

    of_symbol: np.ndarray
    compose: np.ndarray
    apply: np.ndarray
    starts: np.ndarray


@cache
def automaton() -> Automaton:
    nexts = np.array([[_step(s, a)[0] for s in range(STATES)] for a in range(SYMBOLS)])
    starts = np.array([[_step(s, a)[1] for s in range(STATES)] for a in range(SYMBOLS)])
    # A text's first character does the same whatever was before.
    nexts = np.concatenate([nexts, np.repeat(nexts[:, ENDED : ENDED + 1], STATES, axis=1)])
    starts = np.concatenate([starts, np.ones_like(starts)])
    known: dict[tuple, int] = {tuple(range(STATES)): 0}
    for row in nexts:
        known.setdefault(tuple(row), len(known))
    functions = list(known)
    while True:
        for f in list(functions):
            for g in list(functions):
                h = tuple(g[s] for s in f)
                if h not in known:
                    known[h] = len(known)
        if len(known) == len(functions):
            break
        functions = list(known)
    compose = np.array([[known[tuple(g[s] for s in f)] for g in functions] for f in functions], np.int32)
    return Automaton(np.array([known[tuple(row)] for row in nexts]), compose, np.array(functions, np.int32), starts)


def scan(symbols: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Whether each character starts a pre-token, and the state after the last one; ``state`` is that before."""
    machine, n = automaton(), len(symbols)
    if not n:
        return np.zeros(0, bool), state
    width = max(1, int(np.sqrt(n)))
    columns = -(-n // width)
    functions = np.zeros(columns * width, np.int32)  # filled up with the function that changes nothing
    functions[:n] = machine.of_symbol[symbols]
    rows = np.ascontiguousarray(functions.reshape(columns, width).T)
    whole = rows[0].copy()
    for row in rows[1:]:
        whole = machine.compose[whole, row]
    before = np.empty(columns, np.int32)
    for c, f in enumerate(whole.tolist()):
        before[c] = state
        state = int(machine.apply[f, state])
    states = np.empty_like(rows)
    for i, row in enumerate(rows):
        states[i] = before
        before = machine.apply[row, before]
    return machine.starts[symbols, states.T.reshape(-1)[:n]], state


def code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points whose UTF-8 starts at the places ``at`` of the bytes."""
    first = data[at].astype(np.uint32)
    out = first.copy()
    for low, rest, bits in ((0xC0, 1, 0x1F), (0xE0, 2, 0x0F), (0xF0, 3, 0x07)):
        here = np.flatnonzero(first >= low)
        value = first[here] & bits
        for k in range(1, rest + 1):
            value = value << 6 | data[np.minimum(at[here] + k, len(data) - 1)] & 0x3F
        out[here] = value
    return out


def symbols_of(points: np.ndarray, classes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Symbols of all but the last two code points. ``last`` marks the ends of texts: nothing is seen beyond them."""
    n = len(points) - 2
    kind = classes[points]
    symbol = kind[:n].astype(np.int64)
    white = kind >= SPACE
    ends_run = white[:n] & ~white[1 : n + 1] & ~last[:n]
    symbol[white[:n]] = 2 * kind[:n][white[:n]] - SPACE
    symbol[ends_run] += 1
    quote = np.flatnonzero((points[:n] == 0x27) & ~last[:n])
    one, two = points[quote + 1], points[quote + 2]
    symbol[quote[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
    pair = np.zeros(len(quote), bool)
    for a, b in ("re", "ve", "ll"):
        pair |= (one == ord(a)) & (two == ord(b))
    symbol[quote[pair & ~last[quote + 1]]] = LONG
    return symbol


def pre_token_starts(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """Places in the bytes where pre-tokens start, in order; a text's start is one unless it is empty."""
    found, state = [np.zeros(0, np.int64)], ENDED
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets] = True
    at = 0
    while at < len(data):
        # So many bytes hold a stretch's code points and the two beyond.
        lead = np.flatnonzero((data[at : at + 4 * (stretch + 2)] & 0xC0) != 0x80)[: stretch + 2] + at
        over = lead[stretch] if len(lead) > stretch else len(data)
        n = min(len(lead), stretch)
        points = np.zeros(n + 2, np.uint32)
        points[: len(lead)] = code_points(data, lead)
        # Whether a text ends with the code point; beyond those read it does not matter.
        last = np.ones(n + 2, bool)
        last[: len(lead) - 1] = opens[lead[1:]]
        symbol = symbols_of(points, classes, last)
        symbol += SYMBOLS * opens[lead[:n]]
        starts, state = scan(symbol, state)
        found.append(lead[:n][starts])
        at = int(over)
    return np.concatenate(found)


@dataclass(frozen=True)
class Ranks:
    """Ranks of byte strings and the classes of all code points as runs; read once, sent along with the job (1 MB)."""

    ranks: bytes = field(repr=False)
    kinds: bytes = field(repr=False)
    run_ends: bytes = field(repr=False)

    @staticmethod
    def from_file(path: str | None = None) -> Ranks:
        classes = library_classes()
        change = np.flatnonzero(np.diff(classes)) + 1
        kinds = classes[np.append(0, change)]
        ends = np.append(change, len(classes)).astype(np.int32)
        file = Path(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
        return Ranks(file.read_bytes(), kinds.tobytes(), ends.tobytes())

    def classes(self) -> np.ndarray:
        ends = np.frombuffer(self.run_ends, np.int32)
        return np.repeat(np.frombuffer(self.kinds, np.uint8), np.diff(ends, prepend=0))


@cache
def library_classes() -> np.ndarray:
    """The class of every code point, as the tokenizer's library sees letters, numbers and white space (its Unicode
    tables may be newer than Python's). Asked for once, where the job starts: the library keeps what a class matches."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    alone = {bytes([b]): b for b in range(256)}
    classes = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        kept = tiktoken.Encoding(kind, pat_str=pattern, mergeable_ranks=alone, special_tokens={}).encode_ordinary(every)
        classes[np.frombuffer(bytes(kept).decode().encode("utf-32-le"), "<u4")] = kind
    classes[0x20] = SPACE
    return classes


class Merger(dict):
    """Ids of a pre-token as 32-bit numbers."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: bytes) -> bytes:
        rank = self.ranks.get(piece)
        parts = [rank] if rank is not None else (self.short if len(piece) <= SHORT_BYTES else self.long)(piece)
        ids = array("i", parts).tobytes()
        if len(piece) <= CACHE_BYTES:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = ids
        return ids

    def short(self, piece: bytes) -> list[int]:
        """The pair of lowest rank, leftmost first, is joined until no pair has a rank."""
        rank, no = self.ranks.get, NO_RANK
        edges = list(range(len(piece) + 1))
        pairs = [rank(piece[i : i + 2], no) for i in edges[:-2]]
        while pairs and (low := min(pairs)) < no:
            i = pairs.index(low)
            del edges[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(piece[edges[i] : edges[i + 2]], no)
            if i:
                pairs[i - 1] = rank(piece[edges[i - 1] : edges[i + 1]], no)
        return [self.ranks[piece[a:b]] for a, b in zip(edges, edges[1:], strict=False)]

    def long(self, piece: bytes) -> list[int]:
        """The same with a heap of pairs and links between neighbours, not to take quadratic time."""
        rank, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pairs = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(pairs)
        while pairs:
            _, i, over = heapq.heappop(pairs)
            j = after[i] if end[i] else n
            if not end[i] or j >= n or end[j] != over:
                continue  # one of the two has been joined with another since
            end[i], end[j] = over, 0
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(piece[i : end[k]])) is not None:
                    heapq.heappush(pairs, (r, i, end[k]))
            h = before[i]
            if h >= 0 and (r := rank(piece[h:over])) is not None:
                heapq.heappush(pairs, (r, h, over))
        return [self.ranks[piece[i : end[i]]] for i in range(n) if end[i]]


class Coder:
    """Encodes batches of texts and decodes batches of ids."""

    def __init__(self, ranks: Ranks):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.ranks.splitlines())}
        self.classes, self.merge = ranks.classes(), Merger(table)
        self.place = np.zeros(max(table.values()) + 1, np.int64)
        self.length = np.zeros(len(self.place), np.int64)
        ordered = sorted(table, key=table.__getitem__)
        ids = [table[b] for b in ordered]
        self.length[ids] = [len(b) for b in ordered]
        self.place[ids] = np.cumsum(self.length[ids]) - self.length[ids]
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, their offsets in their text, and where each text's ids start (and the last's end)."""
        starts = pre_token_starts(data, offsets, self.classes)
        buffer, edges = data.tobytes(), np.append(starts, len(data)).tolist()
        merge = self.merge.__getitem__
        ids = np.frombuffer(b"".join([merge(buffer[a:b]) for a, b in zip(edges, edges[1:], strict=False)]), np.int32)
        lengths = self.length[ids]
        at = np.cumsum(lengths) - lengths
        first = np.searchsorted(at, offsets)
        return ids, at - np.repeat(offsets[:-1], np.diff(first)), first

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids, each id's from its place ``at`` on, and how many bytes each has."""
        lengths = self.length[ids]
        inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out = np.zeros(len(inside), np.uint8)
        out[np.repeat(at, lengths) + inside] = self.bytes[np.repeat(self.place[ids], lengths) + inside]
        return out, lengths


def _in_parts(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Slices of the batch of about OUT_BYTES each."""
    part = np.cumsum(sizes) // OUT_BYTES
    edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(sizes))
    for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
        yield batch.slice(a, b - a)


def _encoded(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    coder = worker_state("byte_bpe", shared.value, Coder)
    for whole in batches:
        for batch in _in_parts(whole, np.diff(utf8(whole.column(1))[1])):
            ids, at, first = coder.encode(*utf8(batch.column(1)))
            edges = pa.array(first, pa.int32())
            lists = [pa.ListArray.from_arrays(edges, pa.array(x, pa.int32())) for x in (ids, at)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["doc_id", "ids", "offsets"])


def _decoded(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    coder = worker_state("byte_bpe", shared.value, Coder)
    for whole in batches:
        for batch in _in_parts(whole, 4 * np.diff(whole.column(1).offsets.to_numpy())):
            lists = [batch.column(i) for i in (1, 2)]
            ids, at = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
            count = np.diff(lists[0].offsets.to_numpy())
            owner = np.repeat(np.arange(len(count)), count)
            size = np.bincount(owner, coder.length[ids], len(count)).astype(np.int64)
            start = np.cumsum(size) - size
            data, _ = coder.decode(ids, at + start[owner])
            edges = pa.py_buffer(np.append(start, len(data)).astype(np.int32).tobytes())
            texts = pa.Array.from_buffers(pa.binary(), len(count), [None, edges, pa.py_buffer(data.tobytes())])
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])


def encode(docs: DataFrame, ranks: Ranks | None = None) -> DataFrame:
    """doc_id, ids, and the offset in bytes of each id in its text."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks or Ranks.from_file())
    rows = docs.selectExpr("cast(doc_id AS long) AS doc_id", "coalesce(text, '') AS text")
    return rows.mapInArrow(lambda batches: _encoded(batches, shared), ENCODED)


def decode(encoded: DataFrame, ranks: Ranks | None = None) -> DataFrame:
    """The same rows and their bytes, ``decoded``. Ids and offsets must be as :func:`encode` gives them."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks or Ranks.from_file())
    rows = encoded.select("doc_id", "ids", "offsets")
    return rows.mapInArrow(lambda batches: _decoded(batches, shared), f"{ENCODED}, decoded binary")

"""Token counts with a two-tier, map-side lookup.

A pre-token is a run of spaces and the characters up to the next space; no piece of the vocabulary has a space
after another character, so pre-tokens are encoded independently of each other. One pass over all texts finds
the frequent pre-tokens: each task keeps a bounded summary of its own and hands on its heaviest, which alone are
added up. Their lengths become a compact table (at most ``table_entries`` pre-tokens of at most
``CACHE_LENGTH`` characters: 20 MB at the very most) that is broadcast. In the counting pass each word of a text is
looked up there, then in the worker's own cache, and only then encoded. No pre-token is ever shuffled.

The table only decides what is looked up where; counts do not depend on it.

A null text is empty: 0 bytes, 0 tokens. Rows are independent of each other; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.llm.common import utf8, worker_state
from monthclose.llm.tokens import CACHE_ENTRIES, CACHE_LENGTH

LIMIT = 4096
TABLE_ENTRIES = 65_536
#: Pre-tokens a task counts at a time, and of which it hands on the heaviest.
TASK_ENTRIES, TASK_HEAVIEST = 200_000, 8_192

_SPACE_RUN = re.compile(" +[^ ]*")


def _heaviest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's most frequent words. When the summary is full its lighter half is let go."""
    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                seen.update(text.split(" "))
        if len(seen) > TASK_ENTRIES:
            seen = Counter(dict(seen.most_common(TASK_ENTRIES // 2)))
    top = [(w, n) for w, n in seen.most_common(TASK_HEAVIEST) if 0 < len(w) <= CACHE_LENGTH and n > 1]
    yield pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["word", "n"]
    )


def frequent_words(docs: DataFrame, entries: int = TABLE_ENTRIES) -> list[str]:
    """At most ``entries`` words, whatever the size of the corpus."""
    counted = docs.select("text").mapInArrow(_heaviest, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [row.word for row in counted.orderBy(F.desc("n"), "word").limit(entries).collect()]


class _Lengths(dict):
    """Lengths of ' ' + word: the broadcast table first, then this worker's cache, then the tokenizer."""

    def __init__(self, model: bytes, frequent: dict[str, int]):
        import sentencepiece

        super().__init__(frequent)
        self.frequent = frequent
        self.encode = sentencepiece.SentencePieceProcessor(model_proto=model).encode
        self.last_space = len(self.encode("a ")) - len(self.encode("a"))

    def __missing__(self, word: str) -> int:
        if not word or word[-1] == "▁":
            raise LookupError  # a run of spaces goes on over the end of this word
        n = len(self.encode(word))
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_ENTRIES + len(self.frequent):
                self.clear()
                self.update(self.frequent)
            self[word] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        try:
            return sum(map(self.__getitem__, text.split(" ")))
        except LookupError:
            pass
        if "▁" in text:
            return len(self.encode(text))
        # The tokenizer sees one space before the text; of a run of spaces, encode() adds the first itself.
        total = 0
        for piece in _SPACE_RUN.findall(" " + text):
            if len(piece) == 1:  # a space that ends the text
                total += self.last_space
            else:
                total += len(self.encode(piece[1:])) if piece[1] == " " else self[piece[1:]]
        return total


def _lengths(shared: tuple[bytes, str, bytes]) -> _Lengths:
    model, words, lengths = shared
    frequent = dict(zip(words.split(" "), np.frombuffer(lengths, np.uint16).tolist(), strict=True)) if words else {}
    return _Lengths(model, frequent)


def _counted(batches: Iterator[pa.RecordBatch], shared, limit: int) -> Iterator[pa.RecordBatch]:
    count = worker_state("token_counts", shared.value, _lengths).count
    for batch in batches:
        n_bytes = pa.array(np.diff(utf8(batch.column(1))[1]), pa.int64())
        tokens = np.array([count(t) for t in batch.column(1).to_pylist()], np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), n_bytes, pa.array(tokens), pa.array(tokens > limit)],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )


def token_counts(docs: DataFrame, model: str | None = None, limit: int = LIMIT, entries: int = TABLE_ENTRIES):
    """doc_id, n_bytes, n_tokens and over_limit of every row; ``model`` is the path of the vocabulary file."""
    import sentencepiece

    proto = Path(model or public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    encode = sentencepiece.SentencePieceProcessor(model_proto=proto).encode
    words = [w for w in frequent_words(docs, entries) if w[-1] != "▁"]
    lengths = np.array([len(encode(w)) for w in words], np.uint16).tobytes()
    shared = docs.sparkSession.sparkContext.broadcast((proto, " ".join(words), lengths))
    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(
        lambda batches: _counted(batches, shared, limit),
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
    )

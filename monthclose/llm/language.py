"""Language of a text: sparse multinomial logistic regression on TF-IDF of character n-grams.

Features are hashed n-grams of one to three lower-cased characters, digits and ASCII marks read as one space, term
frequency times inverse document
frequency, scaled to length one. Document frequencies come from all texts that may be learnt from. Weights are
learnt by follow-the-regularised-leader with an elastic-net penalty on a sample of ``sample_docs`` labelled texts
(chosen by a hash of the id, evenly over the labels); a part of the sample that takes no part in learning sets
the temperature that calibrates the probabilities.

A text that is null or has no letter is ``und`` with score 0. Rows without id or label are not learnt from but are
predicted. Repeated rows are predicted alike. With no labelled text at all everything is ``und``. An empty table
gives no rows. Language, source and id are never looked at in a prediction. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthclose.llm.common import carried, crc_share

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Documented bound of the sample the weights are learnt from.
SAMPLE_DOCS = 2_000
UNKNOWN = "und"


_READ_AS = np.array([c if chr(c).isalpha() else 32 for c in range(128)], np.uint32)


def grams(text: str) -> np.ndarray:
    """How often each bucket's n-grams occur."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    chars = np.where(chars < 128, _READ_AS[chars & 127], chars)
    chars = chars[np.append(True, (chars[1:] != 32) | (chars[:-1] != 32))] if len(chars) else chars
    parts = []
    for n in ORDERS:
        if len(chars) < n:
            break
        mixed = np.full(len(chars) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            mixed = (mixed ^ chars[k : len(chars) - n + 1 + k]) * np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(13)
        parts.append(mixed >> np.uint32(32 - 15))
    return np.bincount(np.concatenate(parts), minlength=BUCKETS) if parts else np.zeros(BUCKETS, np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    """``weights`` is (buckets, labels); probabilities are softmax(scores / temperature)."""

    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.labels or not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.scores(vector(grams(text), self.idf)) / self.temperature)
        best = int(np.argmax(p))
        return self.labels[best], float(p[best])

    def scores(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (counts * idf).astype(np.float32)
    return x / max(float(np.sqrt(x @ x)), 1e-9)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def learn(
    labels: list[str],
    idf: np.ndarray,
    examples: list[tuple[int, np.ndarray, np.ndarray]],
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.01,
    passes: int = 3,
) -> Model:
    """FTRL-proximal with an elastic net. ``examples``: label number, buckets, values. Every fifth one is kept
    for the temperature."""
    k = len(labels)
    z, n = np.zeros((BUCKETS + 1, k), np.float64), np.zeros((BUCKETS + 1, k), np.float64)

    def weights(zi: np.ndarray, ni: np.ndarray, penalty: np.ndarray) -> np.ndarray:
        return -np.sign(zi) * np.maximum(np.abs(zi) - l1 * penalty, 0) / ((beta + np.sqrt(ni)) / alpha + l2 * penalty)

    taught = [e for i, e in enumerate(examples) if i % 5]
    for _ in range(passes):
        for label, at, x in taught:
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)  # the last one is the bias, without a penalty
            penalty = np.ones((len(at), 1))
            penalty[-1] = 0
            w = weights(z[at], n[at], penalty)
            p = softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    penalty = np.ones((BUCKETS + 1, 1))
    penalty[-1] = 0
    w = weights(z, n, penalty)
    model = Model(labels, idf.astype(np.float32), w[:-1].astype(np.float32), w[-1])
    kept = [e for i, e in enumerate(examples) if not i % 5]
    if kept:
        scores = np.stack([x @ model.weights[at] + model.bias for _, at, x in kept])
        truth = np.array([label for label, _, _ in kept])
        loss = [-np.log(softmax(scores / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in _TEMPERATURES]
        model.temperature = float(_TEMPERATURES[int(np.argmin(loss))])
    return model


_TEMPERATURES = np.geomspace(0.1, 10, 81)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen += grams(text) > 0
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places, counts = [], []
        for text in batch.column(1).to_pylist():
            count = grams(text)  # dense, so one at a time
            at = np.flatnonzero(count)
            places.append(at.astype("<i4").tobytes())
            counts.append(count[at].astype("<i4").tobytes())
        arrays = [batch.column(0), pa.array(places, pa.binary()), pa.array(counts, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["lang", "at", "n"])


def train(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model of all rows of ``labelled`` (doc_id, text, lang); only as many as ``sample_docs`` are fetched."""
    usable = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    # One row per language.
    sizes = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = sorted(sizes)
    if not labels:
        return Model([], np.ones(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0))
    counted = usable.select("text").mapInArrow(_document_frequencies, "bucket long, n long")
    idf = np.full(BUCKETS, np.log(1 + sum(sizes.values())) + 1)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        idf[r.bucket] = np.log((1 + sum(sizes.values())) / (1 + r.n)) + 1
    per_label = sample_docs / len(labels)
    share = F.create_map(*[F.lit(v) for lang in labels for v in (lang, min(1.0, per_label / sizes[lang]))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.where(draw < F.element_at(share, F.col("lang"))).select("lang", "text")
    rows = sample.mapInArrow(_features, "lang string, at binary, n binary").collect()
    examples = []
    for r in sorted(rows, key=lambda r: (hash_of(r.at), r.lang)):
        at, n = np.frombuffer(r.at, "<i4"), np.frombuffer(r.n, "<i4")
        if len(at):
            x = n * idf[at]
            examples.append((labels.index(r.lang), at, x / np.sqrt(x @ x)))
    return learn(labels, idf, examples)


def hash_of(data: bytes) -> int:
    import zlib

    return zlib.crc32(data)


def predictions(model: Model, docs: DataFrame, text: str) -> Column:
    """A struct of lang and score for each row of ``docs``, from its column ``text`` alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x labels floats

    @F.pandas_udf("lang string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang", "score"])

    return predicted(text)


def of_known_language(docs: DataFrame, model: Model, least_score: float) -> DataFrame:
    """The rows of ``docs`` whose language the model tells with ``least_score`` or more; all columns as they came.
    A model without labels lets every row stay."""
    rows = carried(docs)
    found = rows.withColumn("found", predictions(model, rows, "row.text"))
    known = (F.col("found.lang") != UNKNOWN) & (F.col("found.score") >= least_score)
    return found.where(known | F.lit(not model.labels)).select("row.*")


def trainable(docs: DataFrame) -> DataFrame:
    return docs.where(crc_share("doc_id", 4) != 2)


def languages(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learnt from the rows that are not held out."""
    model = train(trainable(docs), sample_docs)
    asked = docs.select("doc_id", "text", (crc_share("doc_id", 4) == 2).alias("held_out"))
    found = asked.withColumn("found", predictions(model, asked, "text"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")

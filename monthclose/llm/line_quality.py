"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. What speaks for it are features of the line and of the lines before and after it: shares of
kinds of characters, lengths of line and words, repetition of words and of whole lines; and the state of its
neighbours. The field is learnt by gradient ascent on labelled documents, all of whose lines carry the document's
label: a sample of about ``sample_docs`` documents at most, chosen by a hash of the id. Their texts are cut into
stretches of ``CHUNK`` lines; if the stretches of all of them hold more than ``sample_lines`` lines, each stretch has
the same chance to be learnt from, wherever in a text it stands and however long the text is. Forward-backward
marginals, weighted by the length of the lines, give the document's share of good text. A logistic curve turns it into a
probability; it is fitted on the shares of whole documents, those of a fifth of the sample that the field is not learnt
from (of all the sample, if that fifth lacks a label).

A null or empty text is one empty line and is scored like any other; a long text is scored over all its lines.
Repeated rows are scored alike. If labels repeat for an id, the largest counts; null labels do not count. Without
both labels to learn from, every score is the share of label 1 (0.5 if there is none). An empty table gives no rows.
Labels, language, source and id are never looked at in a score.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.llm.common import crc_share, text_or_empty

SAMPLE_DOCS = 3_000
SAMPLE_LINES = 200_000
CHUNK = 64
CURVE_PART = 5  # one in so many documents of the sample is for the curve
THRESHOLD = 0.3

_KIND = np.full(256, 9, np.uint8)  # bytes of characters beyond ASCII
for _number, _members in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b".,;:'\"-()", b"!?", b"<>/=|\\{}[]", b"#$%&*@^~_+`")
):
    _KIND[list(_members)] = _number
_KIND[[c for c in range(128) if _KIND[c] == 9]] = 8
_KINDS = 10
OWN = _KINDS + 7
FEATURES = 3 * OWN + 1


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, lengths) of the lines of a text; features of both neighbours are appended to a line's own."""
    lines = (text or "").split("\n")
    data = [line.encode("utf-8", "replace") for line in lines]
    size = np.fromiter(map(len, data), np.int64, len(data))
    own = np.zeros((len(lines), OWN), np.float32)
    kinds = _KIND[np.frombuffer(b"\n".join(data) + b"\n", np.uint8)]
    start = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    for kind in range(_KINDS):
        own[:, kind] = np.add.reduceat(kinds == kind, start)
    own[:, 8] -= 1  # the line's own end
    own[:, :_KINDS] /= np.maximum(size, 1)[:, None]
    seen: set[bytes] = set()
    for i, line in enumerate(data):
        words = line.split()
        n = max(1, len(words))
        own[i, _KINDS:] = (
            np.log1p(len(line)) / 8,
            min(len(line) / n, 30) / 10,
            len(set(words)) / n,
            line in seen and len(words) > 0,
            len(words) == 0,
            line[-1:] in b".!?" and len(line) > 0,
            np.log1p(len(words)) / 6,
        )
        seen.add(line)
    rows = np.zeros((len(lines), FEATURES), np.float32)
    rows[:, :OWN] = own
    rows[1:, OWN : 2 * OWN] = own[:-1]
    rows[:-1, 2 * OWN : 3 * OWN] = own[1:]
    rows[:, -1] = 1
    return rows, np.maximum(size, 1)


def marginals(good: np.ndarray, length: np.ndarray, step: np.ndarray, first: np.ndarray):
    """Forward-backward over many chains at once, laid one after the other in ``good`` (the score of state 1 on
    every line, state 0 has 0), longest first. Returns P(state 1) per line, the sums of the pair marginals (2 x 2)
    and of the first states, over all chains."""
    n, most = len(length), int(length.max(initial=0))
    start = np.concatenate(([0], np.cumsum(length)[:-1])).astype(np.int64)
    emit = np.stack([np.zeros(len(good)), good], axis=1)
    ahead, back = np.zeros((len(good), 2)), np.zeros((len(good), 2))
    alive = [int(np.searchsorted(-length, -t, side="left")) for t in range(most)]  # chains longer than t
    pairs = np.zeros((2, 2))
    if n:
        ahead[start] = first + emit[start]
    for t in range(1, most):
        at = start[: alive[t]] + t
        ahead[at] = np.logaddexp(ahead[at - 1, :1] + step[0], ahead[at - 1, 1:] + step[1]) + emit[at]
    for t in range(most - 2, -1, -1):
        at = start[: alive[t + 1]] + t
        after = emit[at + 1] + back[at + 1]
        back[at] = np.logaddexp(step[:, 0] + after[:, :1], step[:, 1] + after[:, 1:])
        total = np.logaddexp.reduce(ahead[at] + back[at], axis=1)
        pairs += np.exp(ahead[at][:, :, None] + step + after[:, None, :] - total[:, None, None]).sum(axis=0)
    both = ahead + back
    p = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    return p, pairs, np.array([(1 - p[start]).sum(), p[start].sum()])


@dataclass
class Field:
    """Weights of the features for 'good', of a step from state to state, of the first state; then the curve."""

    weights: np.ndarray
    step: np.ndarray
    first: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def shares(self, features: list[np.ndarray], lengths: list[np.ndarray]) -> np.ndarray:
        """Length-weighted share of good text of each document."""
        size = np.array([len(x) for x in features])
        order = np.argsort(-size, kind="stable")
        good = np.concatenate([features[i] for i in order]) @ self.weights
        p, _, _ = marginals(good, size[order], self.step, self.first)
        weight = np.concatenate([lengths[i] for i in order]).astype(float)
        at = np.concatenate(([0], np.cumsum(size[order])[:-1]))
        out = np.empty(len(features))
        out[order] = np.add.reduceat(p * weight, at) / np.add.reduceat(weight, at)
        return out

    def scores(self, features: list[np.ndarray], lengths: list[np.ndarray]) -> np.ndarray:
        share = np.clip(self.shares(features, lengths), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log(share / (1 - share)) + self.offset, -500, 500)))


def learn(chunks: list[tuple[int, np.ndarray]], steps: int = 200, rate: float = 0.1, penalty: float = 1e-3) -> Field:
    """Gradient ascent (Adam) on the mean conditional log-likelihood of the chunks' states, all equal to the label."""
    chunks = sorted(chunks, key=lambda c: -len(c[1]))
    size = np.array([len(x) for _, x in chunks])
    x = np.concatenate([x for _, x in chunks]).astype(np.float64)
    label = np.array([y for y, _ in chunks])
    state = np.repeat(label, size).astype(np.float64)
    stay = np.array([(size[label == y] - 1).sum() for y in (0, 1)], float)
    begin = np.array([(label == 0).sum(), (label == 1).sum()], float)
    theta = np.zeros(FEATURES + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        step, first = theta[FEATURES : FEATURES + 4].reshape(2, 2), theta[FEATURES + 4 :]
        p, pairs, starts = marginals(x @ theta[:FEATURES], size, step, first)
        slope = np.concatenate([x.T @ (state - p), (np.diag(stay) - pairs).ravel(), begin - starts]) / len(chunks)
        slope -= penalty * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Field(theta[:FEATURES], theta[FEATURES : FEATURES + 4].reshape(2, 2), theta[FEATURES + 4 :])


def calibrate(field: Field, share: np.ndarray, label: np.ndarray) -> None:
    """Fit slope and offset of the logistic curve by Newton steps, with a small penalty; a step that overshoots is halved."""
    z = np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1 - 1e-6))
    x, w = np.stack([z, np.ones_like(z)], axis=1), np.array([0.5, 0.0])

    def loss(w: np.ndarray) -> float:
        at = x @ w
        return float(np.sum(np.logaddexp(0, at) - label * at) + 0.05 * w @ w)

    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (label - p) - 0.1 * w)
        now = loss(w)
        while loss(w + step) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w + step
    field.slope, field.offset = float(max(w[0], 1e-3)), float(w[1])


def _chunks(share: float):
    """Stretches of the texts of (quality, text), each drawn with the chance ``share`` by a hash of text and place."""

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], []]
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                of_text = zlib.crc32(text.encode("utf-8", "replace"))
                draws = [(at, zlib.crc32(str(at).encode(), of_text)) for at in range(0, text.count("\n") + 1, CHUNK)]
                taken = [(at, draw) for at, draw in draws if draw < share * 2**32]
                rows = line_features(text)[0] if taken else None
                for at, draw in taken:
                    part = rows[at : at + CHUNK].astype("<f4").tobytes()
                    for column, value in zip(out, (draw, label, part), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())],
                names=["draw", "quality", "rows"],
            )

    return drawn


def _per_text(texts: pd.Series, result: Callable[[list[np.ndarray], list[np.ndarray]], np.ndarray]) -> pd.Series:
    """``result`` of the features and lengths of the texts, a few thousand lines at a time."""
    out, held, lines = [], [], 0
    for text in texts:
        held.append(line_features(text))
        lines += len(held[-1][0])
        if lines > 4_000:
            out.append(result(*map(list, zip(*held, strict=True))))
            held, lines = [], 0
    if held:
        out.append(result(*map(list, zip(*held, strict=True))))
    return pd.Series(np.concatenate(out) if out else np.zeros(0))


def train(
    docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES
) -> Field:
    """``docs`` (doc_id, text), ``labels`` (doc_id, quality). The driver gets the features of about ``sample_lines``
    lines at most, and label and share of good text of the sample's documents."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    n = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(draw < min(1.0, sample_docs / max(n, 1)))
    for_curve = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(CURVE_PART)) == 0
    # About sample_docs rows of two numbers, whatever the size of the tables.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("quality", "text", for_curve.alias("for_curve"))
    to_learn = rows.where(~F.col("for_curve")).select("quality", "text")
    lines = to_learn.agg(F.sum(F.regexp_count(text_or_empty(), F.lit("\n")) + 1)).first()[0] or 0
    share = min(1.0, sample_lines / max(lines, 1))
    found = sorted(to_learn.mapInArrow(_chunks(share), "draw long, quality int, rows binary").collect(), key=lambda r: (r.draw, r.rows))
    chunks = [(r.quality, np.frombuffer(r.rows, "<f4").reshape(-1, FEATURES)) for r in found]
    if len({y for y, _ in chunks}) < 2:
        given = rows.agg(F.avg("quality")).first()[0]
        good = min(max(0.5 if given is None else float(given), 1e-6), 1 - 1e-6)
        return Field(np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(2), 0.0, float(np.log(good / (1 - good))))
    field = learn(chunks)
    shared = docs.sparkSession.sparkContext.broadcast(field)  # fewer than 200 numbers

    @F.pandas_udf("double")
    def share_of(texts: pd.Series) -> pd.Series:
        return _per_text(texts, shared.value.shares)

    whole = sorted(rows.select("for_curve", share_of("text").alias("share"), "quality").collect())
    apart = [r for r in whole if r.for_curve]
    fitted = apart if len({r.quality for r in apart}) > 1 else whole
    calibrate(field, np.array([r.share for r in fitted]), np.array([r.quality for r in fitted], float))
    return field


def with_quality(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` plus score, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # fewer than 200 numbers

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return _per_text(texts, shared.value.scores)

    return docs.withColumn("score", scored("text"))


def quality(
    docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; learnt from the labels of rows that are not held out."""
    field = train(docs, labels.where(crc_share("doc_id", 5) != 0), sample_docs, sample_lines)
    asked = docs.select("doc_id", "text", (crc_share("doc_id", 5) == 0).alias("held_out"))
    return with_quality(asked, field).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )

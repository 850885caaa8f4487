"""Quality by positive-unlabelled learning.

Only trusted good documents (label 1, outside the held-out fold) and unlabelled
web text are learned from; label 0 is never used. A text's features are shares of
word shapes (letters, digits and repeats made alike, hashed) and a few measures
of its characters, words and lines.

The class prior is estimated from a first classifier of good against unlabelled:
the smallest ratio, over score limits, of the shares of unlabelled and of good
documents above, with an allowance for chance. Then the non-negative unbiased risk

    prior * E_good[loss(+)] + max(0, E_unlabelled[loss(-)] - prior * E_good[loss(-)])

of a logistic model is minimised by Adam; where a batch's second term is negative
its gradient is reversed, as usual for this estimator. Both samples are bounded;
scoring is one pass over whole texts without a shuffle.

Defined cases: null and empty texts score by the measures of an empty text;
repeated rows score alike; without good labels every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.labelled import SAMPLE_ROWS, fold, sample
from tidemark.llm.rows import column
from tidemark.llm.toxicity import sigmoid

SHAPES = 1 << 10
MEASURES = 14
FOLDS, HELD_OUT = 4, 2
LIMIT = 0.7

_kind = np.arange(256, dtype=np.uint8)
_kind[ord("a") : ord("z") + 1] = ord("a")
_kind[ord("A") : ord("Z") + 1] = ord("A")
_kind[ord("0") : ord("9") + 1] = ord("0")
_kind[0x80:] = ord("a")


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid((x - self.mean) / self.scale @ self.weights + self.bias)


def features(data: np.ndarray, off: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """A row per text: measures, then shares of word shapes."""
    words = W.Words(data, off, lo, hi)
    n, docs = np.maximum(words.count, 1), hi - lo
    raw, at = words.data, words.off
    chars = np.maximum(np.diff(at), 1)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(flags))[at]) / chars

    kind = _kind[raw]
    hashes = words.hashes()
    own = W.mix(hashes ^ W.mix(words.doc.astype(np.uint64)))
    _, first = np.unique(own, return_index=True)
    distinct = np.bincount(words.doc[first], minlength=docs)
    runs = W.Runs(own).all(3)
    inside = words.doc[:-2] == words.doc[2:] if len(words) > 2 else np.zeros(0, bool)
    _, once = np.unique(runs[inside], return_index=True)
    windows = np.bincount(words.doc[:-2][inside], minlength=docs) if len(words) > 2 else np.zeros(docs, int)
    new = np.bincount(words.doc[:-2][inside][once], minlength=docs) if len(words) > 2 else np.zeros(docs, int)
    lines, repeated = np.zeros(docs), np.zeros(docs)
    for i in range(docs):
        own_lines = [x for x in raw[at[i] : at[i + 1]].tobytes().split(b"\n") if x.strip()]
        lines[i], repeated[i] = len(own_lines), len(own_lines) - len(set(own_lines))
    x = np.zeros((docs, MEASURES + SHAPES), np.float32)
    size = np.bincount(words.doc, words.end - words.start, docs)
    x[:, :MEASURES] = np.stack(
        [
            np.log1p(words.count), size / n, distinct / n, new / np.maximum(windows, 1), np.log1p(lines) - np.log1p(words.count),
            repeated / np.maximum(lines, 1), share(kind == ord("A")), share(kind == ord("0")), share(kind == ord("a")),
            share(raw == 0x21), share(raw == 0x7C), share(np.isin(raw, list(b"#*$%&<>"))), share(raw == 0x2E), share(raw == 0x2C),
        ],
        axis=1,
    )
    if len(words):
        begin = np.zeros(len(raw), bool)
        begin[words.start] = True
        solid = np.repeat(True, len(raw)) & ~np.isin(kind, [0x20, *range(0x09, 0x0E)])
        keep = solid & (begin | (kind != np.append(kind[:1] + 1, kind[:-1])))
        shape = W.Words(np.where(keep, kind, 0x20).astype(np.uint8)[:0], np.zeros(1, np.int64))
        place = np.flatnonzero(keep)
        shape.data = kind[place]
        shape.start = np.searchsorted(place, words.start)
        shape.end = np.append(shape.start[1:], len(place))
        bucket = (shape.hashes() >> np.uint64(40)) % np.uint64(SHAPES)
        pair = words.doc * SHAPES + bucket.astype(np.int64)
        x[:, MEASURES:] = np.sqrt(np.bincount(pair, minlength=docs * SHAPES).reshape(docs, SHAPES) / n[:, None])
    return x


def class_prior(good: np.ndarray, unlabelled: np.ndarray) -> float:
    """The least ratio of the shares above a limit, plus an allowance for the samples' sizes."""
    limits = np.quantile(good, np.linspace(0.02, 0.98, 97))
    p = np.array([(good >= t).mean() for t in limits])
    u = np.array([(unlabelled >= t).mean() for t in limits])
    doubt = np.sqrt(np.log(40) / (2 * len(unlabelled))) + np.sqrt(np.log(40) / (2 * len(good)))
    best = int(np.argmin((u + doubt) / np.maximum(p, 1e-9)))
    return float(np.clip(u[best] / max(p[best], 1e-9), 0.05, 0.98))


def minimise(good: np.ndarray, other: np.ndarray, prior: float, steps: int = 600, rate: float = 0.01, decay: float = 1e-4):
    """Weights and bias of least non-negative unbiased risk."""
    rng = np.random.default_rng(9)
    p = np.zeros(good.shape[1] + 1)
    first, second = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        a = good[rng.integers(0, len(good), min(len(good), 512))].astype(float)
        b = other[rng.integers(0, len(other), min(len(other), 1024))].astype(float)
        sa, sb = sigmoid(a @ p[:-1] + p[-1]), sigmoid(b @ p[:-1] + p[-1])
        # the logistic loss of calling a text good is softplus(-z), of calling it bad softplus(z)
        negative = -np.log(np.maximum(1 - sb, 1e-12)).mean() + prior * np.log(np.maximum(1 - sa, 1e-12)).mean()
        ga, gb = prior * (sa - 1) / len(a), sb / len(b)
        minus = -prior * sa / len(a)
        if negative < 0:
            ga, gb, minus = 0 * ga, -gb, -minus
        grad = np.append(a.T @ (ga + minus) + b.T @ gb + decay * p[:-1], (ga + minus).sum() + gb.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        p = p - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return p[:-1], float(p[-1])


def fit(good: np.ndarray, other: np.ndarray) -> Model | None:
    if len(good) == 0 or len(other) == 0:
        return None
    mean = other.mean(0)
    scale = np.maximum(other.std(0), 0.02)
    g, u = (good - mean) / scale, (other - mean) / scale
    half, rest = len(g) // 2, len(u) // 2
    weights, bias = minimise(g[: max(1, half)], u[: max(1, rest)], 0.5, steps=300)
    prior = class_prior(g[half:] @ weights + bias, u[rest:] @ weights + bias)
    weights, bias = minimise(g, u, prior)
    return Model(mean, scale, weights, bias, prior)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = W.text_bytes(batch.column("text"))
        for lo, hi in W.slices(off):
            x = features(data, off, lo, hi).astype(np.float16)
            yield pa.RecordBatch.from_pydict(
                {"good": batch.column("good").slice(lo, hi - lo), "x": pa.array([row.tobytes() for row in x], pa.binary())}
            )


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on about rows / 2 good and rows / 2 unlabelled documents outside the held-out fold."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    good = labels.where((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & (F.col(label_col) == 1)).select("doc_id").distinct()
    good = texts.join(F.broadcast(sample(good, "doc_id", rows // 2)), "doc_id", "left_semi").withColumn("good", F.lit(1))
    other = sample(texts, "doc_id", rows // 2).withColumn("good", F.lit(0))
    got = good.unionByName(other).select("good", "text").mapInArrow(_rows, "good int, x binary").toArrow()
    if got.num_rows == 0:
        return None
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float16).reshape(got.num_rows, -1).astype(np.float32)
    kind = got.column("good").to_numpy()
    return fit(x[kind == 1], x[kind == 0])


def _scores(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = W.text_bytes(batch.column("text"))
            for lo, hi in W.slices(off):
                score = np.zeros(hi - lo) if model is None else model.scores(features(data, off, lo, hi)).astype(float)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").slice(lo, hi - lo), "score": pa.array(score)})

    return run


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    rows = docs.select(column(docs, id_col).cast("bigint").alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    got = rows.mapInArrow(_scores(model), "doc_id bigint, score double")
    held, above = fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.col("score") >= LIMIT
    return got.select("doc_id", held.alias("held_out"), "score", above.cast("int").alias("predicted"))

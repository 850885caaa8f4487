"""Toxicity by a factorization machine over hashed terms.

A term is a lower-cased run of ASCII letters, digits and other bytes beyond
0x7F, or its first PREFIXES bytes (inflected forms share those), hashed to BUCKETS. Training
reads a bounded sample of labelled documents outside the held-out fold. The machine's inputs are

* up to INPUTS terms whose document frequencies in the two classes differ most (by more than
  LEAST standard errors, in LEAST_DOCS documents of the sample or more), and
* the terms of up to PAIRS pairs whose covariance differs most between the classes (by more than
  LEAST_PAIRED standard errors), among the PAIRED terms whose presence varies most: such a
  term may tell nothing by itself.

A second-order factorization machine

    w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2),  x_i in {0, 1}

is fitted to them by Adam on the logistic loss. The pairwise part lets
an insult count differently beside a mention of a group than alone, which
additive weights cannot. Scores are of whole texts, in one pass without a shuffle, and only
the text goes to Python.

Defined cases: null and empty texts have no terms and score sigmoid(w0); repeated
rows score alike; without labels of both classes every score is 0; labels that disagree for
an id, or are null, are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.labelled import SAMPLE_ROWS, fold, sample
from tidemark.llm.rows import column

BUCKETS = 1 << 18
INPUTS, LEAST, LEAST_DOCS = 400, 3.0, 5
PAIRED, PAIRS, LEAST_PAIRED = 1000, 100, 6.0
FACTORS = 8
SLICE_BYTES = 1 << 20
PREFIXES = (4, 5)  # bytes
FOLDS, HELD_OUT = 3, 1
LIMIT = 0.7

_plain = np.arange(256, dtype=np.uint8)
for _b in range(128):
    if not chr(_b).isalnum():
        _plain[_b] = 0x20
_plain[ord("A") : ord("Z") + 1] += 32


@dataclass(frozen=True)
class Machine:
    """The chosen buckets in order, and the parameters."""

    buckets: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, doc: np.ndarray, term: np.ndarray, docs: int) -> np.ndarray:
        """doc and term: the distinct (document, input) pairs."""
        out = self.bias + np.bincount(doc, self.weights[term], docs)
        for f in range(self.factors.shape[1]):
            v = self.factors[term, f]
            out += 0.5 * (np.bincount(doc, v, docs) ** 2 - np.bincount(doc, v * v, docs))
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def terms(data: np.ndarray, off: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, bucket) pairs of some texts."""
    words = W.Words(_plain[data[off[lo] : off[hi]]], off[lo : hi + 1] - off[lo])
    doc = words.doc.astype(np.uint64) * np.uint64(BUCKETS)
    kinds = [words.hashes(), *[W.mix(words.hashes(k) + np.uint64(k)) for k in PREFIXES]]
    pair = np.unique(np.concatenate([doc + (h >> np.uint64(46)) % np.uint64(BUCKETS) for h in kinds]))
    return (pair // np.uint64(BUCKETS)).astype(np.int64), (pair % np.uint64(BUCKETS)).astype(np.int64)


def choose(seen: np.ndarray, n: np.ndarray, inputs: int = INPUTS) -> np.ndarray:
    """The buckets whose document frequencies differ most; seen and n: by class, of buckets and of documents."""
    rate, both = (seen + 0.5) / (n[:, None] + 1), (seen.sum(0) + 1) / (n.sum() + 2)
    z = np.abs(rate[1] - rate[0]) / np.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1]))
    z[seen.sum(0) < LEAST_DOCS] = 0
    best = np.argsort(-z, kind="stable")[:inputs]
    return np.sort(best[z[best] > LEAST])


def varied(seen: np.ndarray, n: np.ndarray, most: int = PAIRED) -> np.ndarray:
    """The buckets whose presence varies most."""
    share = seen.sum(0) / n.sum()
    best = np.argsort(-share * (1 - share), kind="stable")[:most]
    return np.sort(best[(share[best] > 0) & (share[best] < 1)])


def paired(doc: np.ndarray, term: np.ndarray, label: np.ndarray, terms: int, most: int = PAIRS) -> np.ndarray:
    """The terms of the pairs whose covariance differs most between the classes."""
    if terms == 0:
        return np.zeros(0, np.int64)
    covariance, n, spread = [], [], []
    for cls in (0, 1):
        mine = np.flatnonzero(label == cls)
        row = np.full(len(label), -1)
        row[mine] = np.arange(len(mine))
        have = row[doc] >= 0
        x = np.zeros((len(mine), terms), np.float32)
        x[row[doc[have]], term[have]] = 1
        rate = x.mean(0, dtype=float)
        covariance.append(x.T @ x / len(mine) - np.outer(rate, rate))
        n.append(len(mine))
        spread.append((rate, len(mine)))
    rate = sum(r * k for r, k in spread) / sum(n)
    scale = np.sqrt(np.outer(rate * (1 - rate), rate * (1 - rate)) * (1 / n[0] + 1 / n[1]))
    z = np.triu(np.abs(covariance[1] - covariance[0]) / np.maximum(scale, 1e-12), 1)
    best = np.argsort(-z, axis=None, kind="stable")[:most]
    best = best[z.ravel()[best] > LEAST_PAIRED]
    return np.unique(np.concatenate(np.unravel_index(best, z.shape)))


def fit(doc, term, label, buckets, steps: int = 1500, rate: float = 0.05, decay: float = 1e-4) -> Machine:
    """The machine fitted to documents that hold these of the chosen buckets."""
    label = np.asarray(label, float)
    n = len(label)
    x = np.zeros((n, len(buckets)), np.float32)
    x[doc, term] = 1
    rng = np.random.default_rng(5)
    p = [np.zeros(1), np.zeros(len(buckets)), rng.normal(0, 0.05, (len(buckets), FACTORS))]
    first, second = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    for step in range(1, steps + 1):
        pick = rng.integers(0, n, min(n, 2048))
        xb, y = x[pick].astype(float), label[pick]
        sums = xb @ p[2]
        logit = p[0] + xb @ p[1] + 0.5 * (sums**2 - xb @ p[2] ** 2).sum(1)
        g = (sigmoid(logit) - y) / len(pick)
        both = xb.T @ (g[:, None] * sums) - (xb.T @ g)[:, None] * p[2]
        for k, grad in enumerate((np.array([g.sum()]), xb.T @ g + decay * p[1], both + decay * p[2])):
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad**2
            p[k] = p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Machine(buckets, float(p[0][0]), p[1], p[2])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each class hold a bucket, at first for each batch; bucket -1 counts the texts."""
    for batch in batches:
        data, off = W.text_bytes(batch.column("text"))
        label = batch.column("label").to_numpy()
        for lo, hi in W.slices(off, SLICE_BYTES):
            doc, bucket = terms(data, off, lo, hi)
            toxic = label[lo:hi] == 1
            all_, ones = np.bincount(bucket, minlength=BUCKETS), np.bincount(bucket[toxic[doc]], minlength=BUCKETS)
            some = np.flatnonzero(all_)
            columns = [np.append(x, y) for x, y in ((some, -1), (all_[some], hi - lo), (ones[some], toxic.sum()))]
            yield pa.RecordBatch.from_pydict({k: pa.array(v.astype(np.int64)) for k, v in zip(("bucket", "n", "toxic"), columns)})


def _inputs(buckets: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = W.text_bytes(batch.column("text"))
            for lo, hi in W.slices(off, SLICE_BYTES):
                doc, term = _held(*terms(data, off, lo, hi), buckets)
                ends = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(term.astype(np.int32)))
                yield pa.RecordBatch.from_pydict({"label": batch.column("label").slice(lo, hi - lo), "terms": lists})

    return run


def _held(doc: np.ndarray, bucket: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of chosen buckets, and which of the chosen each is."""
    if len(buckets) == 0:
        return doc[:0], bucket[:0]
    at = np.minimum(np.searchsorted(buckets, bucket), len(buckets) - 1)
    have = buckets[at] == bucket
    return doc[have], at[have]


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> Machine | None:
    """Fit on about `rows` labelled documents outside the held-out fold; None without both classes.

    The driver gets a count per bucket and the chosen inputs of the sample, both of bounded size.
    """
    known = labels.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT).groupBy("doc_id")
    known = known.agg(F.min(label_col).alias("label"), F.max(label_col).alias("most")).where("label = most and doc_id is not null")
    known = sample(known.select("doc_id", F.col("label").cast("int").alias("label")), "doc_id", rows)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    texts = texts.select("label", "text")
    counts = texts.mapInArrow(_frequencies, "bucket bigint, n bigint, toxic bigint").groupBy("bucket")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).toArrow()
    bucket, every, ones = (counts.column(k).to_numpy() for k in ("bucket", "n", "toxic"))
    seen, n = np.zeros((2, BUCKETS)), np.zeros(2)
    real = bucket >= 0
    seen[:, bucket[real]] = [(every - ones)[real], ones[real]]
    n[:] = [(every - ones)[~real].sum(), ones[~real].sum()]
    if n.min() == 0:
        return None
    single, candidates = choose(seen, n), varied(seen, n)
    buckets = np.union1d(single, candidates)
    got = texts.mapInArrow(_inputs(buckets), "label int, terms array<int>").toArrow()
    lists, label = got.column("terms").combine_chunks(), got.column("label").to_numpy()
    doc, term = np.repeat(np.arange(len(label)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
    bucket = buckets[term]
    have = np.isin(bucket, candidates)
    pairs = candidates[paired(doc[have], np.searchsorted(candidates, bucket[have]), label, len(candidates))]
    chosen = np.union1d(single, pairs)
    have = np.isin(bucket, chosen)
    return fit(doc[have], np.searchsorted(chosen, bucket[have]), label, chosen)


def _of_texts(machine: Machine | None, texts: pa.Array) -> np.ndarray:
    """The score of each text."""
    data, off = W.text_bytes(texts)
    out = np.zeros(len(texts))
    if machine is not None:
        for lo, hi in W.slices(off, SLICE_BYTES):
            doc, term = _held(*terms(data, off, lo, hi), machine.buckets)
            out[lo:hi] = sigmoid(machine.logits(doc, term, hi - lo))
    return out


def _scored(text: Column, machine: Machine | None) -> Column:
    """The score as a column; the other columns of the frame stay where they are."""

    @F.arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        return pa.array(_of_texts(machine, texts))

    return toxicity(text.cast("string"))


def score(docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    got = docs.select(column(docs, id_col).cast("bigint").alias("doc_id"), _scored(column(docs, text_col), machine).alias("score"))
    held, above = fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.col("score") >= LIMIT
    return got.select("doc_id", held.alias("held_out"), "score", above.cast("int").alias("predicted"))


def harmless(docs: DataFrame, machine: Machine | None, text_col: str = "text") -> DataFrame:
    """The documents that score below the limit, with their columns."""
    return docs.where(_scored(column(docs, text_col), machine) < LIMIT)

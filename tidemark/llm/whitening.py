"""Whitening of embeddings by eigenvectors refined in mixed precision.

Every entry c becomes the integer floor(SCALE * c) + OFFSET. The fit list holds each
distinct vector once. Its covariance is gathered in two passes of exact integer sums:
first the sums of each dimension, then the products of vectors centred at the rounded
mean, from which the rest of the mean is taken out exactly. Only sums of one row or
matrix per batch are shuffled, never vectors, but for the list of distinct ones.

The driver solves the covariance (dim x dim, whatever the number of rows) in float32 and
corrects the eigenvectors X by iterations of Ogita and Aishima in extended precision

    R = I - X'X,  S = X'AX,  l_i = S_ii / (1 - R_ii),  X <- X + XE,
    E_ij = (S_ij + l_j R_ij) / (l_j - l_i),  or R_ij / 2 where l_i and l_j lie within
    2 (|S - diag(l)| + |A| |R|) of each other or i = j,

which square the error each time, of well separated eigenvalues. Those that lie that
near each other form a cluster; its columns are turned by the eigenvectors of the shifted
small problem X_J' (A - m I) X_J, whose relative gaps are large, before the next iteration.

Defined cases: vectors that are null, or hold null, NaN or infinite entries or entries
beyond 2**56, are left out; vectors of each length are whitened by themselves, with their
own fit list; empty vectors have no components and give no rows, nor do components whose
eigenvalue is not above FLAT of the trace (all, of a single distinct vector); repeated rows
are all returned and count once in the fit; a null id is kept; a deviation beyond 64 bits
is null; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import column
from tidemark.session import materialize

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
FLAT = 1e-14
LARGEST = 2.0**62
STEPS = 30
EXACT = 1 << 53  # float64 holds integers up to here
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)
_LIMB = 36  # bits; sums of 2 ** 27 batches fit


@dataclass(frozen=True)
class Fit:
    """What whitens vectors of one length: shift + rest / n is the mean; axes has a column per component."""

    n: int
    shift: np.ndarray  # whole numbers, OFFSET left out
    rest: list[int]  # sums of what the shift leaves
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def sums(self) -> list[int]:
        """The per-dimension sums of the fit list."""
        return [int(m) * self.n + r + OFFSET * self.n for m, r in zip(self.shift, self.rest)]

    def project(self, whole: np.ndarray) -> np.ndarray:
        centred = (whole - self.shift).astype(float) - np.array([r / self.n for r in self.rest])
        return centred @ self.axes / np.sqrt(self.values)

    def deviations(self, whole: np.ndarray) -> list[int | None]:
        """Sums of (n x - S) squared, exactly."""
        y = whole - self.shift
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.rest), default=0)
        if most * most * max(1, y.shape[1]) < 1 << 62:
            return ((self.n * y - np.array(self.rest, np.int64)) ** 2).sum(1).tolist()
        exact = ((self.n * y.astype(object) - np.array(self.rest, object)) ** 2).sum(1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The integers of each usable vector in as few bytes an entry as hold them; equal vectors get equal bytes."""
    for batch in batches:
        lists, ids = batch.column("vector"), batch.column("vec_id")
        off = lists.offsets.to_numpy()
        entry = lists.flatten()
        value = entry.to_numpy(zero_copy_only=False).astype(float)
        value[~np.isfinite(value)] = np.inf
        ends = off - off[0]
        good = np.ones(len(batch), bool)
        bad = np.flatnonzero(~(np.abs(value * SCALE) < LARGEST))
        good[np.searchsorted(ends, bad, "right") - 1] = False
        dims = np.diff(ends)
        good &= dims > 0
        for dim in np.unique(dims[good]):
            at = np.flatnonzero(good & (dims == dim))
            whole = np.floor(value[ends[at][:, None] + np.arange(dim)] * SCALE).astype(np.int64)
            most = np.maximum(whole.max(1), -(whole.min(1) + 1))
            width = np.searchsorted([1 << 7, 1 << 15, 1 << 31], most, "right")
            for k in np.unique(width):
                rows = np.flatnonzero(width == k)
                data = whole[rows].astype(_WIDTHS[k])
                step = data.itemsize * int(dim)
                parts = [pa.py_buffer((np.arange(len(rows) + 1, dtype=np.int32) * step).tobytes()), pa.py_buffer(data.tobytes())]
                packed = pa.Array.from_buffers(pa.binary(), len(rows), [None, *parts])
                columns = [ids.take(pa.array(at[rows])), pa.array(np.full(len(rows), dim, np.int32)), packed]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "dim", "whole"])


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, places in the batch, their integers), for each length and width; a bounded number of rows at a time."""
    dims = batch.column("dim").to_numpy()
    packed = batch.column("whole").cast(pa.large_binary())
    ends = np.frombuffer(packed.buffers()[1], np.int64)[packed.offset : packed.offset + len(batch) + 1]
    data = np.frombuffer(packed.buffers()[2], np.uint8) if len(batch) else np.zeros(0, np.uint8)
    sizes = np.diff(ends)
    for dim, size in sorted(set(zip(dims.tolist(), sizes.tolist()))):
        at = np.flatnonzero((dims == dim) & (sizes == size))
        step = max(1, (1 << 22) // dim)
        for lo in range(0, len(at), step):
            some = at[lo : lo + step]
            raw = data[ends[some][:, None] + np.arange(size)]
            yield dim, some, np.ascontiguousarray(raw).view(_WIDTHS[(size // dim).bit_length() - 1]).astype(np.int64)


def _limbs(exact: np.ndarray) -> dict[str, pa.Array]:
    """Whole numbers of any size as three columns of lists, whose sums give the sum."""
    flat, low = [int(v) for v in exact], (1 << _LIMB) - 1
    split = [[v >> 2 * _LIMB for v in flat], [v >> _LIMB & low for v in flat], [v & low for v in flat]]
    return {name: pa.array([part], pa.list_(pa.int64())) for name, part in zip(("high", "mid", "low"), split)}


_SUMS = "dim int, part int, n bigint, high array<bigint>, mid array<bigint>, low array<bigint>"


def _rows_of_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dim, at, whole in _parts(batch):
            low, high = (whole & 0xFFFF).sum(0), (whole >> 16).sum(0)
            total = high.astype(object) * (1 << 16) + low
            yield _record(dim, 0, len(at), total)


def _record(dim: int, part: int, n: int, exact: np.ndarray) -> pa.RecordBatch:
    first = {"dim": pa.array([dim], pa.int32()), "part": pa.array([part], pa.int32()), "n": pa.array([n], pa.int64())}
    return pa.RecordBatch.from_pydict(first | _limbs(exact))


def exact_products(y: np.ndarray) -> np.ndarray:
    """y'y as Python's whole numbers."""
    most = int(np.abs(y).max(initial=0))
    if most * most * 16 >= EXACT:
        wide = y.astype(object)
        return wide.T @ wide
    step = min(len(y), EXACT // max(1, most * most))
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for lo in range(0, len(y), max(1, step)):
        part = y[lo : lo + step].astype(float)
        total = total + (part.T @ part).astype(np.int64)  # whole numbers below 2 ** 53
    return total


def _products(shifts: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, whole in _parts(batch):
                for i, line in enumerate(exact_products(whole - shifts[dim])):
                    yield _record(dim, i, len(at), line)

    return run


def _total(parts: DataFrame) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """{(dim, part): (rows, sums)}: added up on the executors; dim or dim * dim numbers reach the driver."""
    cells = parts.select("dim", "part", "n", F.posexplode(F.arrays_zip("high", "mid", "low")).alias("at", "v"))
    cells = cells.groupBy("dim", "part", "at").agg(F.sum("n").alias("n"), *[F.sum(f"v.{x}").alias(x) for x in ("high", "mid", "low")])
    out: dict = {}
    for r in cells.orderBy("dim", "part", "at").toLocalIterator():
        out.setdefault((r.dim, r.part), (r.n, []))[1].append((((r.high << _LIMB) + r.mid) << _LIMB) + r.low)
    return out


def _norm(a: np.ndarray) -> float:
    return float(np.sqrt((a.astype(float) ** 2).sum()))


def clusters(values: np.ndarray, within: float) -> list[np.ndarray]:
    """Runs of values of which neighbours differ by no more than that, where longer than one."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > within) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def eigen(covariance: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(values falling, unit columns) of a symmetric matrix, to extended precision; signs as the largest entry is positive."""
    a = covariance.astype(np.longdouble)
    d = len(a)
    scale = np.trace(a)
    if not scale > 0:
        return np.zeros(d, np.longdouble), np.eye(d, dtype=np.longdouble)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    unit, size = np.eye(d, dtype=np.longdouble), _norm(a)
    enough = d * float(np.finfo(np.longdouble).eps) * 4
    for _ in range(steps):
        r, s = unit - x.T @ x, x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        apart = s - np.diag(np.diag(s))
        if max(np.abs(r).max(), np.abs(apart).max()) <= enough:
            break
        near = 2 * (_norm(s - np.diag(values)) + size * _norm(r))
        gap = values[None, :] - values[:, None]
        close = np.abs(gap) <= near
        # the formula of E less R / 2 is skew, so that rounding over a small gap only turns a cluster
        skew = (s + (values[None, :] + values[:, None]) / 2 * r) / np.where(close, 1, gap)
        x = x + x @ (r / 2 + np.where(close, 0, skew))
        for part in clusters(values, near):
            some = x[:, part]
            small = some.T @ (a @ some - values[part].mean() * some)
            small = (small + small.T) / 2
            if np.abs(small - np.diag(np.diag(small))).max() > enough:
                turn = np.linalg.eigh((small / np.abs(small).max()).astype(float))[1]
                x[:, part] = some @ turn.astype(np.longdouble)
    x = x / np.sqrt((x * x).sum(0))
    values = (x * (a @ x)).sum(0)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order]
    x = x * np.where(x[np.abs(x).argmax(0), np.arange(d)] < 0, -1, 1)
    return values * scale, x


def _longdouble(exact: np.ndarray) -> np.ndarray:
    return np.array([[np.longdouble(int(v)) for v in line] for line in exact], np.longdouble)


def fits(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of each length, from (dim, whole) of the distinct vectors."""
    sums = _total(distinct.mapInArrow(_rows_of_sums, _SUMS))
    shifts = {dim: np.array([(2 * s + n) // (2 * n) for s in total], np.int64) for (dim, _), (n, total) in sums.items()}
    products = _total(distinct.mapInArrow(_products(shifts), _SUMS))
    out = {}
    for (dim, _), (n, total) in sums.items():
        rest = [s - n * int(m) for s, m in zip(total, shifts[dim])]
        second = np.array([products[dim, i][1] for i in range(dim)], object).reshape(dim, dim)
        about = np.array(rest, object)
        covariance = _longdouble(n * second - np.outer(about, about)) / (np.longdouble(n) * np.longdouble(n))
        values, axes = eigen(covariance)
        trace = np.trace(covariance)
        keep = min(components, int((values > FLAT * trace).sum()))
        out[dim] = Fit(n, shifts[dim], rest, axes[:, :keep].astype(float), values[:keep].astype(float), float(trace))
    return out


def _second_moments(fit: dict[int, Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, whole in _parts(batch):
                white = np.column_stack([np.ones(len(at)), fit[dim].project(whole)])
                cells = (white.T @ white).ravel()
                columns = {"dim": pa.array([dim], pa.int32()), "sums": pa.array([cells.tolist()], pa.list_(pa.float64()))}
                yield pa.RecordBatch.from_pydict(columns)

    return run


def identity_errors(distinct: DataFrame, fit: dict[int, Fit]) -> dict[int, float]:
    """How far the covariance of the whitened fit list is from the identity, measured by a pass over it."""
    cells = distinct.mapInArrow(_second_moments(fit), "dim int, sums array<double>")
    cells = cells.select("dim", F.posexplode("sums").alias("at", "v")).groupBy("dim", "at").agg(F.sum("v").alias("v"))
    found: dict[int, dict[int, float]] = {}
    for r in cells.toLocalIterator():
        found.setdefault(r.dim, {})[r.at] = r.v
    out = {}
    for dim, by in found.items():
        k = len(fit[dim].values) + 1
        moments = np.array([by[i] for i in range(k * k)]).reshape(k, k) / fit[dim].n
        out[dim] = float(np.abs(moments[1:, 1:] - np.outer(moments[0, 1:], moments[0, 1:]) - np.eye(k - 1)).max(initial=0))
    return out


def _whitened(fit: dict[int, Fit], errors: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, whole in _parts(batch):
                one = fit[dim]
                k, rows = len(one.values), len(at)
                if k == 0:
                    continue
                each = pa.array(np.repeat(np.arange(rows), k))
                columns = {
                    "vec_id": batch.column("vec_id").take(pa.array(at)).take(each),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    "n": pa.array(np.full(rows * k, one.n, np.int64)),
                    "deviation": pa.array(one.deviations(whole), pa.int64()).take(each),
                    "whitened": pa.array(one.project(whole).ravel()),
                    "explained": pa.array(np.tile(one.values / one.trace, rows)),
                    "identity_error": pa.array(np.full(rows * k, errors[dim])),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every usable row."""
    vectors = rows.select(
        column(rows, id_col).cast("bigint").alias("vec_id"), column(rows, vector_col).cast("array<double>").alias("vector")
    ).where("vector is not null")
    vectors = materialize(vectors.mapInArrow(_whole, "vec_id bigint, dim int, whole binary"), "whole")
    distinct = materialize(vectors.select("dim", "whole").distinct(), "distinct")
    fit = fits(distinct, components)
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    return vectors.mapInArrow(_whitened(fit, identity_errors(distinct, fit)), schema)

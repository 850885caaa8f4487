"""Packing documents into sequences along a space-filling curve.

Every document's hashed parts are projected to DIMENSIONS random directions; the
projections, cut to BITS bits, give its place on a Hilbert curve, so that alike
documents lie near each other. Documents are sorted by range along the curve,
and each range is laid out from its beginning: a sequence is filled up with the
next document, which is cut where the sequence ends and goes on in the next one.

Documents are cut at multiples of GRID ids only. At those places the first pass,
which tokenizes, notes the CRC of the document's ids so far; the CRC of any piece
follows from the two at its ends. So neither texts nor ids are shuffled, only a
row of about n_tokens / 8 bytes per document. Padding is below GRID per sequence,
plus one last sequence for each range. `token_pieces` gives the ids themselves.

Defined cases: a null or empty text is the closing id alone; documents of any
length are cut; repeated rows are packed one by one; no rows give no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm import words as W
from tidemark.llm.rows import column
from tidemark.session import materialize

LENGTH = 2048
GRID = 32
CLOSING = 1
DIMENSIONS, BITS = 4, 12
RANGE_TOKENS = 8 << 20  # ids of a range; its row data are about an eighth of that
NOTES = "doc_id bigint, text_key bigint, curve bigint, n_tokens bigint, crcs binary"
PIECES = (
    "doc_id bigint, text_key bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of whole numbers below 2 ** bits."""
    x = points.astype(np.uint64).T.copy()
    one = np.uint64(1)
    q = np.uint64(1 << (bits - 1))
    while q > one:
        low = q - one
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0]) ^ swap
            x[i] = x[i] ^ swap
        q >>= one
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = np.uint64(1 << (bits - 1))
    while q > one:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - one), turn)
        q >>= one
    x ^= turn
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for row in x:
            out = (out << one) | ((row >> np.uint64(bit)) & one)
    return out.view(np.int64)


def curve_places(hashes: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Each text's hashed parts, projected and placed on the curve."""
    n = np.sqrt(np.maximum(np.bincount(doc, minlength=docs), 1))
    cells = np.empty((docs, DIMENSIONS), np.int64)
    for k in range(DIMENSIONS):
        sign = ((hashes >> np.uint64(40 + k)) & np.uint64(1)).astype(float) * 2 - 1
        spread = np.tanh(np.bincount(doc, sign, docs) / n / 4)
        cells[:, k] = np.minimum((spread + 1) / 2 * (1 << BITS), (1 << BITS) - 1)
    return hilbert(cells, BITS)


def _notes(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for batch in batches:
            _, off = W.text_bytes(batch.column("text"))
            for lo, hi in W.slices(off, 2 << 20):
                part = batch.slice(lo, hi - lo)
                ids, at, hashes, doc = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                crcs, counts = [], np.diff(at) + 1
                for i in range(hi - lo):
                    raw = np.append(ids[at[i] : at[i + 1]], np.uint32(CLOSING)).astype("<u4").tobytes()
                    crc, found = 0, []
                    for k in range(0, len(raw), 4 * GRID):
                        crc = zlib.crc32(raw[k : k + 4 * GRID], crc)
                        found.append(crc)
                    crcs.append(np.array(found, np.uint32).tobytes())
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "text_key": part.column("text_key"),
                        "curve": pa.array(curve_places(hashes, doc, hi - lo)),
                        "n_tokens": pa.array(counts.astype(np.int64)),
                        "crcs": pa.array(crcs, pa.binary()),
                    }
                )

    return run


def zero_shifts(most: int) -> np.ndarray:
    """Row n: what each bit of a CRC becomes when n ids follow."""

    def follow(x: np.ndarray) -> np.ndarray:
        for _ in range(32):
            x = (x >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (x & np.uint32(1)))
        return x

    rows = [np.uint32(1) << np.arange(32, dtype=np.uint32)]
    for _ in range(most):
        rows.append(follow(rows[-1]))
    return np.stack(rows)


def piece_crcs(before: np.ndarray, after: np.ndarray, length: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """CRCs of pieces from those of all ids before them and up to their end."""
    bits = (before[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
    return after ^ np.bitwise_xor.reduce(shifts[length] * bits, axis=1)


def _lay_out(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shifts = zero_shifts(length)
        sequence, filled = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            row, start, end, where, offset, before, after = [], [], [], [], [], [], []
            for i, (n, raw) in enumerate(zip(batch.column("n_tokens").to_pylist(), batch.column("crcs").to_pylist())):
                crcs, s = np.frombuffer(raw, np.uint32), 0
                while s < n:
                    e = min(n, s + length - filled)
                    e = e if e == n else e // GRID * GRID
                    if e > s:
                        row.append(i), start.append(s), end.append(e), where.append(sequence), offset.append(filled)
                        before.append(crcs[s // GRID - 1] if s else 0), after.append(crcs[-(-e // GRID) - 1])
                        filled += e - s
                        s = e
                    if s < n or filled == length:
                        sequence, filled = sequence + 1, 0
            begin, size = np.array(start, np.int64), np.array(end, np.int64) - np.array(start, np.int64)
            crc = piece_crcs(np.array(before, np.uint32), np.array(after, np.uint32), size, shifts)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").take(take),
                    "text_key": batch.column("text_key").take(take),
                    "start": pa.array(begin),
                    "length": pa.array(size),
                    "ids_crc32": pa.array(crc.astype(np.int64)),
                    "doc_tokens": batch.column("n_tokens").take(take),
                    "sequence_id": pa.array(where, pa.int64()),
                    "offset": pa.array(offset, pa.int64()),
                }
            )

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(column(docs, id_col).cast("bigint").alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    return rows.withColumn("text_key", F.xxhash64("doc_id", "text"))


def pack(docs: DataFrame, path: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents: which ids go to which place of which sequence."""
    notes = materialize(_texts(docs, id_col, text_col).mapInArrow(_notes(path), NOTES), "notes")
    total = notes.agg(F.sum("n_tokens")).first()[0] or 0
    ranges = max(1, -(-total // RANGE_TOKENS))
    order = ["curve", "text_key", "doc_id"]
    # documents with one place on the curve are spread by a hash, so no range outgrows its task
    placed = notes.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return placed.mapInArrow(_lay_out(length), PIECES)


def _cut(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for batch in batches:
            out: dict[str, list] = {"sequence_id": [], "offset": [], "doc_id": [], "ids": []}
            for row in batch.to_pylist():
                ids, *_ = encoder.encode([row["text"] or ""])
                ids = np.append(ids, np.uint32(CLOSING)).astype(np.int64)
                for p in row["pieces"]:
                    out["sequence_id"].append(p["sequence_id"]), out["offset"].append(p["offset"])
                    out["doc_id"].append(row["doc_id"]), out["ids"].append(ids[p["start"] : p["start"] + p["length"]])
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)})

    return run


def token_pieces(docs: DataFrame, pieces: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, offset, doc_id, ids): the token ids of pieces from `pack`, which should be stored."""
    lists = pieces.groupBy("text_key").agg(F.collect_list(F.struct("sequence_id", "offset", "start", "length")).alias("pieces"))
    texts = _texts(docs, id_col, text_col).dropDuplicates(["doc_id", "text_key"]).join(lists, "text_key")
    return texts.select("doc_id", "text", "pieces").mapInArrow(
        _cut(path), "sequence_id bigint, offset bigint, doc_id bigint, ids array<bigint>"
    )

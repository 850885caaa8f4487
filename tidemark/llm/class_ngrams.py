"""Scores of texts by a Brown class model: exchange clustering, class trigrams, word emissions.

Words go to CLASSES classes, and a text's probability is the product over its tokens of
P(class | the two classes before) * P(word | class). Classes come from the exchange
algorithm: a word joins the class that raises most the likelihood of the class bigrams

    sum N(c, d) log N(c, d) - 2 sum N(c) log N(c).

The most frequent words start as classes of their own and the others as one; each round moves
half of the words, which half by their hash, given where all others are.

Everything is counted over all training documents, on the executors:

* `encode` turns texts into chunks of about CHUNK_BYTES, one row each: the numbers of its
  tokens in the chunk's list of distinct words. They are stored bucketed by chunk, so that no
  later step shuffles tokens.
* Words meet by buckets of their 128-bit hash. A chunk sends one row per bucket with its
  counts, so a word has at most one entry per chunk however frequent it is; the bucket adds
  them up and sends back one row per chunk. There are so many buckets that each has about
  ENTRIES entries. No list of words is ever broadcast or collected: the driver gets class
  counts (CLASSES ** 3 at most), the seeds, and sums.

Transitions are smoothed by Witten and Bell from trigrams to bigrams to single classes.
A word that training hasn't seen has the probability that a token after the class before it is of a word
seen once (Good and Turing), smoothed by the share over all; known words share the rest. The
end of a text is a token with a class of its own, which also stands before its first word.

Defined cases: null and empty texts are an end alone; repeated rows are scored, and learned
from, one by one; a null id is kept and counts as empty text in the fold; without training
documents every word is unknown, and the end too; very long texts stand in a chunk of their
own; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.labelled import fold
from tidemark.llm.rows import column
from tidemark.session import materialize, scratch_path

FOLDS, HELD_OUT = 7, 2
CLASSES = 32  # the first is the end's
UNKNOWN = CLASSES
ROUNDS = 4
CHUNK_BYTES = 16 << 20
ENTRIES = 1_000_000
CONTEXT = 16.0  # tokens that the share of unknown words over all counts as, in the share after a class
CELLS = 2 * CLASSES  # a word's neighbours: the class before, the class after


def _bytes(values: np.ndarray) -> pa.Array:
    return pa.array([values.tobytes()], pa.large_binary()).cast(pa.binary())


def _array(table: pa.Table, name: str, kind: type, row: int = 0) -> np.ndarray:
    return np.frombuffer(table.column(name)[row].as_py() or b"", kind)


_CHUNK = "chunk bigint, types bigint, train_docs bigint, train_tokens bigint, ids binary, has_id binary, held binary, lengths binary, tokens binary, first binary, second binary, counts binary"


class _Chunk:
    """Documents being gathered into one row."""

    def __init__(self) -> None:
        self.first, self.second, self.tokens, self.lengths, self.ids, self.has_id, self.held = ([] for _ in range(7))
        self.size = self.types = 0

    def add(self, data: np.ndarray, off: np.ndarray, lo: int, hi: int, ids: pa.Array, held: np.ndarray) -> None:
        words = W.Words(data, off, lo, hi, lower=True)
        first, at, token = np.unique(words.hashes(), return_index=True, return_inverse=True)
        self.first.append(first)
        self.second.append(_second(words, at))
        self.tokens.append(token.astype(np.int32) + np.int32(self.types))
        self.types += len(first)
        self.lengths.append(words.count.astype(np.int32))
        self.ids.append(ids.fill_null(0).to_numpy())
        self.has_id.append(ids.is_valid().to_numpy(zero_copy_only=False))
        self.held.append(held)
        self.size += int(off[hi] - off[lo])

    def row(self, chunk: int) -> pa.RecordBatch:
        first, second, token, lengths, ids, has_id, held = map(
            np.concatenate, (self.first, self.second, self.tokens, self.lengths, self.ids, self.has_id, self.held)
        )
        order = np.lexsort((second, first))
        new = np.append(True, (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0))[: len(order)]
        number = np.empty(len(order), np.int32)
        number[order] = np.cumsum(new, dtype=np.int32) - 1
        token, order = number[token], order[new]
        learned = token[np.repeat(~held, lengths)]
        columns = {
            "chunk": pa.array([chunk], pa.int64()),
            "types": pa.array([len(order)], pa.int64()),
            "train_docs": pa.array([int((~held).sum())], pa.int64()),
            "train_tokens": pa.array([len(learned)], pa.int64()),
            "ids": _bytes(ids),
            "has_id": _bytes(has_id),
            "held": _bytes(held),
            "lengths": _bytes(lengths),
            "tokens": _bytes(token),
            "first": _bytes(first[order]),
            "second": _bytes(second[order]),
            "counts": _bytes(np.bincount(learned, minlength=len(order)).astype(np.int32)),
        }
        return pa.RecordBatch.from_pydict(columns)


def _second(words: W.Words, at: np.ndarray) -> np.ndarray:
    """Another hash, of some of the words."""
    size = words.end[at] - words.start[at]
    step = size + 1
    place = np.cumsum(step) - step
    byte = np.full(int(step.sum()), 0x20, np.uint8)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    byte[np.repeat(place, size) + inner] = words.data[np.repeat(words.start[at], size) + inner]
    return W.Words(byte, np.array([0, len(byte)])).hashes(family=1)


def _chunks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, now = TaskContext.get().partitionId(), 0, _Chunk()
        for batch in batches:
            data, off = W.text_bytes(batch.column("text"))
            held = batch.column("held").to_numpy(zero_copy_only=False)
            for lo, hi in W.slices(off):
                if now.size and now.size + off[hi] - off[lo] > size:
                    yield now.row(part << 32 | seq)
                    seq, now = seq + 1, _Chunk()
                now.add(data, off, lo, hi, batch.column("doc_id").slice(lo, hi - lo), held[lo:hi])
        if now.lengths:
            yield now.row(part << 32 | seq)

    return run


def encode(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", size: int = CHUNK_BYTES) -> DataFrame:
    """The chunks, bucketed by chunk: a step that joins something small to them doesn't shuffle them.

    They are an unmanaged table below the shared folder, under a name of its own.
    """
    rows = docs.select(
        column(docs, id_col).cast("bigint").alias("doc_id"), column(docs, text_col).cast("string").alias("text"), held.alias("held")
    )
    spark = docs.sparkSession
    # not fewer than a join would take, or Spark would rather shuffle
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    name = f"tidemark_chunks_{uuid.uuid4().hex}"
    writer = rows.mapInArrow(_chunks(size), _CHUNK).write.format("parquet").option("compression", "zstd").bucketBy(parts, "chunk")
    writer.option("path", scratch_path(spark, "chunks")).saveAsTable(name)
    return spark.table(name)


def bucket(first: np.ndarray, buckets: int) -> np.ndarray:
    return ((first >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _counted(buckets: int):
    """The words of a chunk and their counts, a row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for i in range(len(batch)):
                first, second, counts = (_array(table, k, t, i) for k, t in (("first", np.uint64), ("second", np.uint64), ("counts", np.int32)))
                edge = np.searchsorted(bucket(first, buckets), np.arange(buckets + 1))
                some = np.flatnonzero(np.diff(edge))
                cut = lambda values: pa.array([values[edge[b] : edge[b + 1]].tobytes() for b in some], pa.binary())
                columns = [pa.array(some, pa.int32()), pa.array([table.column("chunk")[i].as_py()] * len(some), pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, cut(first), cut(second), cut(counts)], ["bucket", "chunk", "first", "second", "counts"])

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one bucket after the other, from rows in order of bucket."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        at = batch.column("bucket").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1), len(at)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if hi > lo:
                if held and held[0].column("bucket")[0].as_py() != at[lo]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _joined(table: pa.Table, name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """A column's arrays end to end, and where each begins."""
    parts = [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


_TOTALS = "chunk bigint, bucket int, total binary, word binary, types bigint, singles bigint, top array<struct<first: binary, total: bigint>>"


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk of a bucket, its words' counts over all chunks and their numbers in the bucket; for the bucket, its sums."""
    for table in _by_bucket(batches):
        first, at = _joined(table, "first", np.uint64)
        second, _ = _joined(table, "second", np.uint64)
        counts, _ = _joined(table, "counts", np.int32)
        order = np.lexsort((second, first))
        new = np.append(True, (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0))
        number = np.empty(len(order), np.int32)
        number[order] = np.cumsum(new, dtype=np.int32) - 1
        total = np.bincount(number, counts, int(new.sum())).astype(np.int64)
        name = np.stack([first[order[new]], second[order[new]]], 1).astype(">u8")  # bytes in order of value
        best = np.lexsort((name[:, 1], name[:, 0], -total))[: CLASSES - 2]
        best = best[total[best] > 0]
        each = total[number]
        cut = lambda values: pa.array([values[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())
        n, null = len(table), pa.scalar(None)
        top = [[{"first": name[i].tobytes(), "total": int(total[i])} for i in best]]
        kind = pa.list_(pa.struct([("first", pa.binary()), ("total", pa.int64())]))
        chunk, number_of = table.column("chunk").combine_chunks(), table.column("bucket").combine_chunks()
        blank = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, kind)]
        names = ["chunk", "bucket", "total", "word", "types", "singles", "top"]
        yield pa.RecordBatch.from_arrays([chunk, number_of, cut(each), cut(number), *blank], names)
        sums = [pa.array([int((total > 0).sum())], pa.int64()), pa.array([int((total == 1).sum())], pa.int64()), pa.array(top, kind)]
        one = [pa.nulls(1, pa.int64()), number_of.slice(0, 1), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())]
        yield pa.RecordBatch.from_arrays([*one, *sums], names)


class _Held:
    """A chunk with the classes and counts of its words; the end is the word after the last."""

    def __init__(self, left: pa.Table, right: pa.Table, seeds: dict[bytes, int]):
        types = left.column("types")[0].as_py()
        self.lengths, self.held = _array(left, "lengths", np.int32), _array(left, "held", bool)
        self.tokens = _array(left, "tokens", np.int32)
        totals, classes, words = {}, {}, {}
        for b, total, word, cls in zip(*(right.column(k).to_pylist() for k in ("bucket", "total", "word", "class"))):
            if total is not None:
                totals[b], words[b] = np.frombuffer(total, np.int64), np.frombuffer(word, np.int32)
            else:
                classes[b] = np.frombuffer(cls, np.uint8)
        self.buckets = np.array(sorted(totals), np.int64)
        size = np.array([len(totals[b]) for b in self.buckets], np.int64)
        self.edge = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        join = lambda by, kind: np.concatenate([np.zeros(0, kind), *[by[b] for b in self.buckets]])
        self.total, self.word = join(totals, np.int64), join(words, np.int32)
        rest = np.full(types, CLASSES - 1, np.uint8)
        if seeds and len(classes) < len(totals):
            first, second = _array(left, "first", np.uint64), _array(left, "second", np.uint64)
            for name, cls in seeds.items():
                a, b = np.frombuffer(name, ">u8").astype(np.uint64)
                at = np.arange(np.searchsorted(first, a), np.searchsorted(first, a, "right"))
                rest[at[second[at] == b]] = cls
        for k, b in enumerate(self.buckets):
            if b in classes:
                rest[self.edge[k] : self.edge[k + 1]] = classes[b]
        rest[self.total == 0] = UNKNOWN
        self.classes = np.append(rest, np.uint8(0))
        self.end = types

    def stream(self, chosen: np.ndarray) -> np.ndarray:
        """The tokens of the chosen documents, each document with its end."""
        size = self.lengths[chosen].astype(np.int64)
        ends = np.cumsum(size + 1) - 1
        out = np.full(int(size.sum()) + len(size), self.end, np.int32)
        inner = np.ones(len(out), bool)
        inner[ends] = False
        out[inner] = self.tokens if chosen.all() else self.tokens[np.repeat(chosen, self.lengths)]
        return out


def _before(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two tokens before, within the text; the end's stands before its first token."""
    one = np.append(np.uint8(0), classes[:-1])
    two = np.append(np.uint8(0), one[:-1])
    two[one == 0] = 0
    return one, two


def _cells(cell: np.ndarray, n: np.ndarray) -> pa.Table:
    return pa.table({"cell": pa.array(cell, pa.int32()), "n": pa.array(n, pa.int64())})


def _bigrams(seeds: dict[bytes, int]):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Held(left, right, seeds)
        classes = chunk.classes[chunk.stream(~chunk.held)]
        n = np.bincount(_before(classes)[0].astype(np.int32) * CLASSES + classes, minlength=CLASSES * CLASSES)
        return _cells(np.flatnonzero(n), n[n > 0])

    return run


def _trigrams(left: pa.Table, right: pa.Table) -> pa.Table:
    """Counts of three classes; after CLASSES ** 3, those of words seen once after a class."""
    chunk = _Held(left, right, {})
    stream = chunk.stream(~chunk.held)
    classes = chunk.classes[stream]
    one, two = _before(classes)
    n = np.bincount((two.astype(np.int32) * CLASSES + one) * CLASSES + classes, minlength=CLASSES**3)
    once = np.bincount(one[np.append(chunk.total == 1, False)[stream]], minlength=CLASSES)
    n = np.concatenate([n, once])
    return _cells(np.flatnonzero(n), n[n > 0])


_PIECES = "bucket int, chunk bigint, word binary, class binary, cells binary, cell binary, n binary"


def _pieces(seeds: dict[bytes, int], buckets: int, half: int):
    """Of the words in one half of the buckets, the neighbours' classes counted; a row per bucket."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Held(left, right, seeds)
        turn = chunk.buckets // (buckets // 2) == half
        moving = np.append(np.repeat(turn, np.diff(chunk.edge)), False)
        stream = chunk.stream(~chunk.held)
        classes = chunk.classes[stream]
        some = np.flatnonzero(moving[stream])  # the last token is an end, so each of these has a next one
        keys = np.empty((2, len(some)), np.int32 if chunk.end * CELLS < 1 << 31 else np.int64)
        keys[:] = stream[some]
        keys *= CELLS
        keys[0] += _before(classes)[0][some]
        keys[1] += CLASSES + classes[some + 1].astype(keys.dtype)
        del stream, some, classes
        keys, n = np.unique(keys, return_counts=True)
        of, cell, n = keys // CELLS, (keys % CELLS).astype(np.uint8), n.astype(np.uint32)
        per_word = np.bincount(of, minlength=chunk.end + 1).astype(np.uint8)
        names, rows = ["bucket", "chunk", "word", "class", "cells", "cell", "n"], []
        mine = np.flatnonzero(turn)
        at = np.searchsorted(of, chunk.edge)
        for k in mine:
            a, b, p, q = chunk.edge[k], chunk.edge[k + 1], at[k], at[k + 1]
            rows.append([x.tobytes() for x in (chunk.word[a:b], chunk.classes[a:b], per_word[a:b], cell[p:q], n[p:q])])
        arrays = [pa.array([r[i] for r in rows], pa.binary()) for i in range(5)]
        number = pa.array(np.full(len(mine), left.column("chunk")[0].as_py(), np.int64))
        return pa.table([pa.array(chunk.buckets[mine], pa.int32()), number, *arrays], names)

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_classes(word: np.ndarray, cell: np.ndarray, n: np.ndarray, now: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """The class that each word joins: word, cell and n are its neighbours, in order of word; now, its class.

    Gains are those of moving one word while all others stay. In its own class, a word
    is weighed as if it were taken out and put back.
    """
    held, margin = bigrams.astype(float), bigrams.sum(0).astype(float)
    pairs, which = np.unique(n * CELLS + cell, return_inverse=True)
    c, k = pairs % CELLS, (pairs // CELLS).astype(float)[:, None]
    x = np.where((c < CLASSES)[:, None], held[c % CLASSES], held.T[c % CLASSES])  # by the class that the word joins
    join, stay = _xlogx(x + k) - _xlogx(x), _xlogx(x) - _xlogx(np.maximum(x - k, 0))
    edge = np.searchsorted(word, np.arange(len(now) + 1))
    out, lo = now.copy(), 0
    while lo < len(now):
        hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + 200_000, "right")) - 1)
        at = slice(edge[lo], edge[hi])
        some = np.flatnonzero(np.diff(edge[lo : hi + 1]))  # words without neighbours were never learned from
        if len(some):
            start, own = edge[lo:hi][some] - edge[lo], now[lo:hi][some].astype(np.int64)
            count = np.add.reduceat(np.where(cell[at] < CLASSES, n[at], 0), start).astype(float)
            gain = np.add.reduceat(join[which[at]], start) - 2 * (_xlogx(margin + count[:, None]) - _xlogx(margin))
            back = np.add.reduceat(stay[which[at], now[word[at]]], start)
            back = back - 2 * (_xlogx(margin[own]) - _xlogx(np.maximum(margin[own] - count, 0)))
            gain[:, 0] = -np.inf
            gain[np.arange(len(some)), own] = -np.inf
            best = gain.argmax(1)
            better = gain[np.arange(len(some)), best] > back + 1e-9
            out[lo:hi][some[better]] = best[better]
        lo = hi
    return out


def _exchange(bigrams: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_bucket(batches):
            entry, at = _joined(table, "word", np.int32)
            now = np.zeros(int(entry.max(initial=-1)) + 1, np.uint8)
            now[entry] = _joined(table, "class", np.uint8)[0]
            key, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
            late: list[tuple[np.ndarray, np.ndarray]] = []
            for i in range(len(table)):  # added up as they come, so that a frequent word takes no more than its cells
                word = np.repeat(_array(table, "word", np.int32, i), _array(table, "cells", np.uint8, i))
                late.append((word.astype(np.int64) * CELLS + _array(table, "cell", np.uint8, i), _array(table, "n", np.uint32, i).astype(np.int64)))
                if sum(len(k) for k, _ in late) > max(len(key), 1 << 20) or i == len(table) - 1:
                    key, inverse = np.unique(np.concatenate([key, *[k for k, _ in late]]), return_inverse=True)
                    n = np.bincount(inverse, np.concatenate([n, *[x for _, x in late]]), len(key)).astype(np.int64)
                    late = []
            classes = best_classes(key // CELLS, key % CELLS, n, now, bigrams)[entry]
            chunk, number = table.column("chunk").combine_chunks(), table.column("bucket").combine_chunks()
            cut = pa.array([classes[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([chunk, number, cut], ["chunk", "bucket", "class"])

    return run


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartition(parts, "bucket").sortWithinPartitions("bucket")


class Model:
    """Log10 probabilities of classes after two classes (the last index is an unknown word's), and of words unknown."""

    def __init__(self, cells: np.ndarray, types: int, tokens: int, singles: int):
        k = CLASSES
        three, once = cells[: k**3].reshape(k, k, k).astype(float), cells[k**3 :].astype(float)
        two = three.sum(0)
        self.count = two.sum(0)  # of each class
        self.types, self.tokens = types, tokens

        def smooth(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
            n, kinds = counts.sum(-1, keepdims=True), (counts > 0).sum(-1, keepdims=True)
            return np.where(n > 0, (counts + kinds * lower) / np.maximum(n + kinds, 1), lower)

        one = smooth(self.count, np.full(k, 1 / k))
        second = np.concatenate([smooth(two, one), one[None]])  # after an unknown word: any class
        third = np.broadcast_to(second[None], (k + 1, k + 1, k)).copy()
        third[:k, :k] = smooth(three, second[:k])
        share = (singles + 0.5) / (tokens + 1)
        follow = np.append(two.sum(1), 0.0)
        unknown = (np.append(once, 0.0) + CONTEXT * share) / (follow + CONTEXT)
        unknown = np.minimum(unknown, 1 - 1e-6)
        self.unknown = np.log10(unknown)
        self.known = np.log10(third) + np.log10(1 - unknown)[None, :, None]

    def scores(self, two: np.ndarray, one: np.ndarray, classes: np.ndarray, total: np.ndarray) -> np.ndarray:
        """The log10 probability of each token."""
        known = np.minimum(classes, CLASSES - 1)
        emitted = np.log10(np.maximum(total, 1)) - np.log10(np.maximum(self.count, 1))[known]
        return np.where(classes == UNKNOWN, self.unknown[one], self.known[two, one, known] + emitted)


def _scored(model: Model, docs: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Held(left, right, {})
        total = np.append(chunk.total, docs)
        classes = chunk.classes.copy()
        classes[-1] = 0 if docs else UNKNOWN
        n = chunk.lengths.astype(np.int64) + 1
        start, edge = np.cumsum(n) - n, np.append(np.cumsum(n) - n, n.sum())
        stream = chunk.stream(np.ones(len(n), bool))
        base, score, known = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n), np.int64)
        lo = 0
        while lo < len(n):  # a bounded number of tokens at a time, or one text
            hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + (1 << 20), "right")) - 1)
            some, at = stream[edge[lo] : edge[hi]], start[lo:hi] - edge[lo]
            mine, seen = classes[some], total[some]
            one, two = _before(mine)
            one[at], two[at] = 0, 0
            second = np.zeros(len(mine), bool)
            second[at[n[lo:hi] > 1] + 1] = True
            two[second] = 0
            base[lo:hi] = np.add.reduceat(np.log10((seen + 1) / (model.tokens + model.types + 1)), at)
            score[lo:hi] = np.add.reduceat(model.scores(two, one, mine, seen), at)
            known[lo:hi] = np.add.reduceat((seen > 0).astype(np.int64), at)
            lo = hi
        missing = ~_array(left, "has_id", bool)
        columns = {
            "doc_id": pa.array(_array(left, "ids", np.int64), mask=missing),
            "held_out": pa.array(chunk.held),
            "n_tokens": pa.array(n),
            "n_known": pa.array(known),
            "train_tokens": pa.array(np.full(len(n), model.tokens, np.int64)),
            "base_score": pa.array(base),
            "score": pa.array(score),
        }
        return pa.table(columns)

    return run


_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, size: int = CHUNK_BYTES, entries: int = ENTRIES
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document; two rounds at least."""
    if rounds < 2:
        raise ValueError("each half of the words must move once")
    chunks = encode(docs, fold(column(docs, id_col), FOLDS) == HELD_OUT, id_col, text_col, size)
    sums = chunks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("types", "train_docs", "train_tokens")]).first()
    cores = chunks.sparkSession.sparkContext.defaultParallelism
    # an even number, as half of them move
    buckets = 2 * max(1, -(-sums.types // (2 * entries)), min(cores, sums.types // 100_000))
    pieces = chunks.select("chunk", "first", "second", "counts").mapInArrow(
        _counted(buckets), "bucket int, chunk bigint, first binary, second binary, counts binary"
    )
    totals = materialize(_dealt(pieces, buckets).mapInArrow(_totals, _TOTALS), "totals")
    found = totals.where("chunk is null").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("types", "singles")]
    ).first()
    top = totals.where("chunk is null").select(F.explode("top").alias("t")).select("t.*")
    top = top.orderBy(F.col("total").desc(), "first").limit(CLASSES - 2).collect()
    seeds = {bytes(r["first"]): i + 1 for i, r in enumerate(top)}
    end = 1 if sums.train_docs else 0
    tokens, types = sums.train_tokens + sums.train_docs, found.types + end

    none = F.lit(None).cast("binary").alias("class")
    counts = totals.where("chunk is not null").select("chunk", "bucket", "total", "word", none)
    halves: dict[int, DataFrame] = {}

    def beside(run, schema: str, columns: list[str]) -> DataFrame:
        right = counts
        for moved in halves.values():
            right = right.unionByName(moved, allowMissingColumns=True)
        left = chunks.select("chunk", "types", "lengths", "held", "tokens", *columns)
        return left.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(run, schema)

    def summed(rows: DataFrame, size: int) -> np.ndarray:
        out = np.zeros(size, np.int64)
        for r in rows.groupBy("cell").agg(F.sum("n").alias("n")).collect():
            out[r.cell] = r.n
        return out

    for turn in range(rounds):
        names, start = (["first", "second"], seeds) if len(halves) < 2 else ([], {})
        bigrams = summed(beside(_bigrams(start), "cell int, n bigint", names), CLASSES**2).reshape(CLASSES, CLASSES)
        sent = _dealt(beside(_pieces(start, buckets, turn % 2), _PIECES, names), buckets)
        halves[turn % 2] = materialize(sent.mapInArrow(_exchange(bigrams), "chunk bigint, bucket int, class binary"), "classes")
    cells = summed(beside(_trigrams, "cell int, n bigint", []), CLASSES**3 + CLASSES)
    # the end is seen once only if there is one training document
    model = Model(cells, types, tokens, found.singles + (sums.train_docs == 1))
    return beside(_scored(model, sums.train_docs), _SCORES, ["ids", "has_id"])

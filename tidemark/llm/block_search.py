"""Exact ranked search over posting lists in blocks of similar documents.

A document's impact for a term is the part that the term adds to its score, a whole
number; a score is the sum of the impacts of the item's terms. Items are
taken in sets of about ITEMS, and only lists of terms that some item holds are built:

* One pass over the texts keeps, of each document, its length and the counts of those
  terms; the document counts follow from it. Nothing is left out.
* Documents are projected to DIRECTIONS random directions by their impacts and sorted by
  the signs there (and by a number of their own, so that copies can be split), then cut
  into shards of SHARD documents, or fewer where the set has many terms.
* Within a shard every term's list is cut into blocks: as many members as there are blocks
  of BLOCK documents are the centres, and each document joins the most similar one. A block's
  summary is the largest impact of each term in any of its documents.
* An item skips a block only if its terms' sum over the summary is below the item's
  threshold, and skips the lists of terms that, by their largest impacts, can't reach the
  threshold together. Documents of the other blocks are scored exactly.

Thresholds start from the TOP-th best score in a sample of about PILOT documents, which no
result can be below, and rise within a shard. Shards hand on no more than TOP documents
an item, and a window ranks those of all shards. No document that belongs in a result is
ever skipped.

Defined cases: null and empty texts, and texts without a term, are in no result; repeated
rows are ranked one by one; equal scores go by ascending id, null ids last; items without
terms, or whose terms no document holds, have no rows; repeated items count once, and
items of one id with different texts are ranked apart; empty tables give no rows; other
columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.rows import column
from tidemark.session import materialize

TOP = 50
ITEMS = 512
ITEM_BYTES = 1 << 20  # of the texts of a set of items
SHARD = 4096
BLOCK = 64
DIRECTIONS = 16
PILOT = 20_000
CELLS = 1 << 23  # documents times terms, of a shard
ROUNDING = 1 + 1e-9  # more than sums of doubles can err

_term = np.full(256, 0x20, np.uint8)
for _b in [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _term[_b] = _b + 32 if 0x41 <= _b <= 0x5A else _b


def term_words(data: np.ndarray, off: np.ndarray, lo: int, hi: int) -> W.Words:
    """Terms are runs of ASCII letters, digits and whatever lies beyond ASCII, A-Z lower-cased."""
    return W.Words(_term[data[off[lo] : off[hi]]], off[lo : hi + 1] - off[lo])


@dataclass(frozen=True)
class Items:
    """A set of items: the terms in order of hash, and each item's terms."""

    hashes: np.ndarray
    starts: np.ndarray
    data: np.ndarray
    first: np.ndarray
    terms: np.ndarray

    @staticmethod
    def of(texts: pa.Array) -> Items:
        data, off = W.text_bytes(texts)
        words = term_words(data, off, 0, len(texts))
        hashes, at, term = np.unique(words.hashes(), return_index=True, return_inverse=True)
        spelled = [words.text(i) for i in at]
        pairs = np.unique(words.doc.astype(np.int64) * max(1, len(hashes)) + term)
        doc = pairs // max(1, len(hashes))
        return Items(
            hashes,
            np.cumsum([0, *map(len, spelled)]),
            np.frombuffer(b"".join(spelled), np.uint8),
            np.searchsorted(doc, np.arange(len(texts) + 1)),
            pairs % max(1, len(hashes)),
        )

    def __len__(self) -> int:
        return len(self.first) - 1

    def find(self, words: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """(text, term) of the words that are terms of an item, compared byte by byte."""
        if len(self.hashes) == 0 or len(words) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = words.hashes()
        term = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        size = words.end - words.start
        at = np.flatnonzero((self.hashes[term] == hashes) & (np.diff(self.starts)[term] == size))
        if len(at) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        term, size = term[at], size[at]
        begin = np.cumsum(size) - size
        inner = np.arange(int(size.sum())) - np.repeat(begin, size)
        same = words.data[np.repeat(words.start[at], size) + inner] == self.data[np.repeat(self.starts[term], size) + inner]
        same = np.logical_and.reduceat(same, begin)
        return words.doc[at[same]], term[same]


def _postings(items: Items):
    """Each document's number of terms, and the items' terms with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, off = W.text_bytes(batch.column("text"))
            for lo, hi in W.slices(off):
                words = term_words(data, off, lo, hi)
                doc, term = items.find(words)
                key, tf = np.unique(doc * max(1, len(items.hashes)) + term, return_counts=True)
                doc, term = key // max(1, len(items.hashes)), key % max(1, len(items.hashes))
                ends = np.searchsorted(doc, np.arange(hi - lo + 1))
                salt = W.mix(np.arange(row, row + hi - lo, dtype=np.uint64) + (np.uint64(part) << np.uint64(36)))
                columns = {
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo),
                    "n": pa.array(words.count.astype(np.int64)),
                    "salt": pa.array(salt.view(np.int64)),
                    "terms": _lists(ends, term.astype(np.int32)),
                    "tfs": _lists(ends, tf.astype(np.int32)),
                }
                row += hi - lo
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    off = lists.offsets.to_numpy().astype(np.int64)
    return off - off[0], lists.flatten().to_numpy(zero_copy_only=False)


def _document_counts(terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column("terms"))[1], minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(some.astype(np.int32)), "df": pa.array(total[some])})

    return run


def impacts(term: np.ndarray, tf: np.ndarray, n: np.ndarray, weights: np.ndarray, docs: int, length: int) -> np.ndarray:
    """What each term adds; n: the length of its document; docs and length: of all documents with a term."""
    lengths, which = np.unique(n, return_inverse=True)
    m = np.array([50 + (50 * int(x) * docs) // length for x in lengths], np.int64)[which]
    return weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _directions(terms: int) -> np.ndarray:
    return np.random.default_rng(7).normal(size=(terms, DIRECTIONS)).astype(np.float32)


def project(ends: np.ndarray, term: np.ndarray, value: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The unit vectors of documents in the random directions; zero without terms."""
    parts = np.zeros((len(term) + 1, DIRECTIONS))
    np.cumsum(directions[term] * value[:, None].astype(float), 0, out=parts[1:])
    out = parts[ends[1:]] - parts[ends[:-1]]
    return (out / np.maximum(np.sqrt((out**2).sum(1, keepdims=True)), 1e-300)).astype(np.float32)


def _weighed(weights: np.ndarray, docs: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = _directions(len(weights))
        for batch in batches:
            ends, term = _flat(batch.column("terms"))
            tf = _flat(batch.column("tfs"))[1].astype(np.int64)
            n = np.repeat(batch.column("n").to_numpy(), np.diff(ends))
            value = impacts(term, tf, n, weights, docs, length)
            signs = project(ends, term, value, directions) > 0
            place = (signs @ (1 << np.arange(DIRECTIONS - 1, -1, -1))).astype(np.int32)
            columns = {
                "doc_id": batch.column("doc_id"),
                "salt": batch.column("salt"),
                "place": pa.array(place),
                "terms": _lists(ends, term),
                "impacts": _lists(ends, value),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return run


def blocks_of(doc: np.ndarray, ends: np.ndarray, points: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The block of each posting; ends: where each term's list ends; points: the documents' projections."""
    out, before = np.empty(len(doc), np.int64), 0
    size = np.diff(ends)
    long = np.flatnonzero(size > block)
    count = np.where(size > 0, 1, 0)
    count[long] = -(-size[long] // block)
    base = np.cumsum(count) - count
    out[:] = np.repeat(base, size)
    for t in long:
        mine = points[doc[ends[t] : ends[t + 1]]]
        centres = mine[np.linspace(0, len(mine) - 1, count[t]).astype(np.int64)]
        out[ends[t] : ends[t + 1]] += (mine @ centres.T).argmax(1)
    return out


class Shard:
    """Documents with their posting lists, searched for all items of a set.

    held has a row per document and a column per term; its whole numbers, and their sums
    over an item's terms, are exact as doubles up to 2 ** 53.
    """

    def __init__(self, ends: np.ndarray, term: np.ndarray, value: np.ndarray, terms: int, block: int = BLOCK):
        docs = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        self.held = np.zeros((len(ends) - 1, terms))
        self.held[docs, term] = value
        order = np.argsort(term, kind="stable")
        self.lists = np.searchsorted(term[order], np.arange(terms + 1))
        number = blocks_of(docs[order], self.lists, project(ends, term, value, _directions(terms)), block)
        by = np.argsort(number, kind="stable")  # a term's blocks lie together, in order of term
        self.doc, number = docs[order][by], number[by]
        self.edge = np.append(np.flatnonzero(np.append(True, np.diff(number) > 0)[: len(number)]), len(number))
        self.first = np.searchsorted(self.edge, self.lists)  # each term's first block
        self.largest = self.held.max(0, initial=0)
        self.scored = 0

    def _summaries(self, lo: int, hi: int, columns: np.ndarray) -> np.ndarray:
        """The largest impacts of some terms in each of the blocks from lo to hi."""
        out, step = np.empty((hi - lo, len(columns))), max(1, CELLS // (2 * len(columns)))
        while lo < hi:
            to = max(lo + 1, min(hi, int(np.searchsorted(self.edge, self.edge[lo] + step, "right")) - 1))
            rows, at = self.doc[self.edge[lo] : self.edge[to]], self.edge[lo:to] - self.edge[lo]
            out[len(out) - (hi - lo) : len(out) - (hi - to)] = np.maximum.reduceat(self.held[np.ix_(rows, columns)], at, 0)
            lo = to
        return out

    def bounds(self, has: np.ndarray, asks: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(block, item, bound) where the bound isn't below the item's floor; asks: which lists an item reads."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for t in np.flatnonzero(asks.any(1) & (np.diff(self.lists) > 0)):
            items = np.flatnonzero(asks[t])
            columns = np.flatnonzero(has[:, items].any(1))
            most = self._summaries(self.first[t], self.first[t + 1], columns) @ has[np.ix_(columns, items)].astype(float)
            r, c = np.nonzero(most * ROUNDING >= np.maximum(floor[items], 1))
            found.append((r + self.first[t], items[c], most[r, c] * ROUNDING))
        return tuple(np.concatenate(x) for x in zip(*found))

    def search(self, items: Items, floor: np.ndarray, ids: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, document, score): an item's best documents here, of at least its floor; ids: by which ties go."""
        count = len(items)
        item_of = np.repeat(np.arange(count), np.diff(items.first))
        has = np.zeros((self.held.shape[1], count), bool)
        has[items.terms, item_of] = True
        # an item's terms by their largest impact: those whose sum stays below its floor needn't be looked up
        most = self.largest[items.terms]
        order = np.lexsort((most, item_of))
        running = np.cumsum(most[order])
        running = running - np.repeat(np.append(0, running)[items.first[:-1]], np.diff(items.first))
        needed = order[(running * ROUNDING >= floor[item_of[order]]) & (running > 0)]
        asks = np.zeros_like(has)
        asks[items.terms[needed], item_of[needed]] = True
        block, item, bound = self.bounds(has, asks, floor)
        order = np.lexsort((-bound, item))
        block, bound, at = block[order], bound[order], np.searchsorted(item[order], np.arange(count + 1))
        found = [(np.zeros(0, np.int64),) * 3]
        for i in range(count):
            doc, score = self._best(block[at[i] : at[i + 1]], bound[at[i] : at[i + 1]], items.terms[items.first[i] : items.first[i + 1]], floor[i], ids, top)
            found.append((np.full(len(doc), i), doc, score))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _best(self, block: np.ndarray, bound: np.ndarray, terms: np.ndarray, floor: int, ids: np.ndarray, top: int):
        """An item's best documents; its blocks come by falling bound."""
        seen = np.zeros(len(self.held), bool)
        doc, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        lo, step = 0, 2
        while lo < len(block) and bound[lo] >= floor:  # the most promising blocks first
            part = block[lo : lo + step][bound[lo : lo + step] >= floor]
            new = np.unique(np.concatenate([self.doc[self.edge[b] : self.edge[b + 1]] for b in part]))
            new = new[~seen[new]]
            seen[new] = True
            self.scored += len(new)
            points = self.held[np.ix_(new, terms)].sum(1).astype(np.int64)
            keep = points >= max(floor, 1)
            doc, score = np.append(doc, new[keep]), np.append(score, points[keep])
            order = np.lexsort((ids[doc], -score))[:top]
            doc, score = doc[order], score[order]
            floor = max(floor, int(score[-1])) if len(score) == top else floor
            lo, step = lo + step, step * 2
        return doc, score


def _searched(items: Items, floor: np.ndarray, shard: int, block: int, top: int):
    shard = min(shard, max(1, CELLS // max(1, len(items.hashes))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            ends, term = _flat(table.column("terms").combine_chunks())
            value = _flat(table.column("impacts").combine_chunks())[1]
            ids = table.column("doc_id").combine_chunks()
            by = np.where(ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(), np.iinfo(np.int64).max)
            item, doc, score = Shard(ends, term, value, len(items.hashes), block).search(items, floor, by, top)
            columns = {"item": pa.array(item.astype(np.int32)), "doc_id": ids.take(pa.array(doc)), "score": pa.array(score)}
            return pa.RecordBatch.from_pydict(columns)

        held, size = [], 0
        for batch in batches:
            at = 0
            while at < len(batch):
                part = batch.slice(at, shard - size)
                held.append(part)
                at, size = at + len(part), size + len(part)
                if size == shard:
                    yield found(held)
                    held, size = [], 0
        if held:
            yield found(held)

    return run


def _best(rows: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _ranked(docs: DataFrame, names: list, items: Items, shard: int, block: int, pilot: int, top: int) -> DataFrame:
    """item_id, rank, doc_id and score of one set of items."""
    spark, terms = docs.sparkSession, len(items.hashes)
    postings = docs.mapInArrow(_postings(items), "doc_id bigint, n bigint, salt bigint, terms array<int>, tfs array<int>")
    postings = materialize(postings, "postings")
    held = postings.where(F.size("terms") > 0)
    docs_with, length = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(terms, np.int64)
    for r in held.select("terms").mapInArrow(_document_counts(terms), "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        weights[r.term] = math.floor(1000 * math.log((2 * docs_with + 2) / (2 * r.df + 1)))
    vectors = held.mapInArrow(
        _weighed(weights, docs_with, max(1, length)), "doc_id bigint, salt bigint, place int, terms array<int>, impacts array<bigint>"
    )
    parts = max(1, held.rdd.getNumPartitions())
    index = vectors.repartitionByRange(parts, "place", "salt").sortWithinPartitions("place", "salt")
    index = materialize(index.select("doc_id", "salt", "terms", "impacts"), "index")
    schema, floor = "item int, doc_id bigint, score bigint", np.zeros(len(items), np.int64)
    share = min(1.0, pilot / max(1, docs_with))
    some = index.where(F.pmod("salt", F.lit(1 << 20)) < int(share * (1 << 20)))
    first = some.mapInArrow(_searched(items, floor, shard, block, top), schema)
    for r in _best(first, top).where(F.col("rank") == top).collect():
        floor[r["item"]] = r.score
    found = _best(index.mapInArrow(_searched(items, floor, shard, block, top), schema), top)
    known = spark.createDataFrame([(i, name) for i, name in enumerate(names)], "item int, item_id bigint")
    return found.join(F.broadcast(known), "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    set_size: int = ITEMS,
    shard: int = SHARD,
    block: int = BLOCK,
    pilot: int = PILOT,
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's best documents."""
    rows = docs.select(column(docs, id_col).cast("bigint").alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    asked = items.select(column(items, item_col).cast("bigint").alias("item_id"), column(items, item_text_col).cast("string").alias("text"))
    asked = asked.where("text is not null").distinct()
    n, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    sets = max(1, -(-n // set_size), -(-size // ITEM_BYTES))
    found = []
    for i in range(sets):  # a bounded number of items, in expectation
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(sets)) == i).orderBy("item_id", "text").toArrow()
        texts = part.column("text").combine_chunks()
        found.append(_ranked(rows, part.column("item_id").to_pylist(), Items.of(texts), shard, block, pilot, top))
    return reduce(DataFrame.unionByName, found)


ORACLE_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
asked AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
size AS (SELECT count(*) FILTER (len(terms) > 0) AS n, sum(len(terms)) AS l FROM doc),
tf AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM doc)
  WHERE term IN (SELECT term FROM asked) GROUP BY row, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, size GROUP BY term),
scored AS (
  SELECT asked.item_id, asked.text, doc.doc_id, doc.row,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(doc.terms) * n) // l)))) AS BIGINT) AS score
  FROM tf JOIN asked USING (term) JOIN weight USING (term) JOIN doc USING (row), size
  GROUP BY asked.item_id, asked.text, doc.doc_id, doc.row),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
"""

"""Substring dedup by relative Lempel-Ziv parsing of every document against an index of all.

The reference is the whole corpus, cut into blocks at places that depend on the
words alone: in every window of `window` words the least hash among its runs of
`anchor` words is that window's anchor, and a block is the words of all
consecutive windows with one anchor. Equal windows have equal anchors, so a
window can only recur in a block under the same anchor, and the index of blocks,
keyed by anchor and spread over the cluster, holds every place to look.

Each document is parsed along its blocks:

* nothing else in the index has the anchor: a literal;
* the same block occurs again: a factor over the whole block;
* other blocks have the anchor too, but none is equal: the factor ends somewhere
  inside. At these boundaries the windows are checked one by one against those
  of all blocks under the anchor, each distinct block being taken once.

Neighbouring factors join into spans of at least `window` words, and the words in
spans go. Windows are judged on the input. All occurrences go, the first too.
Anchors, blocks and windows are compared by two independent 64-bit hashes each.

Only 5 to 10 % of the places carry an anchor, so the index is far smaller than the
text. Frequent blocks, anchors and windows are counted by aggregates that combine
before the shuffle; no group is gathered in a task except the spans of a document.

Defined cases: a null text has no words and stays null in `without_repeats`, a text
shorter than a window loses nothing, rows equal in id and text are judged as two
occurrences of each window (so both lose them), rows without an id are kept apart by
their text, and other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.rows import packed, unpacked
from tidemark.session import materialize

WINDOW = 35
ANCHOR = 8
BLOCK_PLACES = 1 << 22  # places whose least hash is sought at once; a bound of memory
KEY = ["uid", "text_key"]  # the id, null as 0, and a hash of id and text
BLOCKS = "uid bigint, text_key bigint, start int, windows int, anchor bigint, block bigint"
PLACES = "uid bigint, text_key bigint, start int, anchor bigint, times bigint, hashes array<bigint>"


def least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` neighbours the place of the least; of equals, the first."""
    n = len(hashes) - width + 1
    out = np.empty(max(n, 0), np.int64)
    low = np.uint64((1 << 24) - 1)
    for at in range(0, n, BLOCK_PLACES):
        part = hashes[at : min(at + BLOCK_PLACES, n) + width - 1]
        least = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        have = 1
        while have < width:  # runs of length `have` are reduced to their least
            more = min(have, width - have)
            least = np.minimum(least[:-more], least[more:])
            have += more
        out[at : at + len(least)] = (least & low).astype(np.int64) + at
    return out


class Parsed:
    """The words of some texts and the hashes that blocks and windows need."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lo: int, hi: int):
        self.words = W.Words(data, off, lo, hi)
        hashes = self.words.hashes()
        self.one, self.two = W.Runs(hashes, 1), W.Runs(W.mix(hashes + np.uint64(1)), 2)

    def blocks(self, window: int, anchor: int) -> dict[str, np.ndarray]:
        """Every block: its text, first window, number of windows, anchor and content."""
        words, n = self.words, len(self.words)
        fits = np.zeros(0, np.int64)
        if n >= window:
            fits = np.flatnonzero(words.doc[: n - window + 1] == words.doc[window - 1 :])
        if len(fits) == 0:
            return {k: np.zeros(0, np.int64) for k in ("doc", "start", "windows", "anchor", "block")}
        at = least_places(self.one.all(anchor), window - anchor + 1)[fits]
        new = np.ones(len(fits), bool)
        new[1:] = (at[1:] != at[:-1]) | (fits[1:] != fits[:-1] + 1)
        begin = np.flatnonzero(new)
        windows = np.diff(np.append(begin, len(fits)))
        start, at = fits[begin], at[begin]
        block = self.two.at(start, windows + window - 1) ^ W.mix((at - start).astype(np.uint64) + np.uint64(7))
        return {
            "doc": words.doc[start],
            "start": start - words.first[words.doc[start]],
            "windows": windows,
            "anchor": self.two.at(at, anchor).view(np.int64),
            "block": block.view(np.int64),
        }


def _index(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = W.text_bytes(batch.column("text"))
            for lo, hi in W.slices(off):
                got = Parsed(data, off, lo, hi).blocks(window, anchor)
                rows = pa.array(got.pop("doc") + lo)
                ids = {k: batch.column(k).take(rows) for k in KEY}
                small = {k: pa.array(got[k].astype(np.int32)) for k in ("start", "windows")}
                yield pa.RecordBatch.from_pydict(ids | small | {k: pa.array(got[k]) for k in ("anchor", "block")})

    return run


def _boundary_windows(window: int):
    """The hashes of the windows of the listed blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("blocks")
            rows = np.flatnonzero(np.asarray(asked.is_valid()))
            if len(rows) == 0:
                continue
            batch, asked = batch.take(pa.array(rows)), asked.take(pa.array(rows))
            data, off = W.text_bytes(batch.column("text"))
            for lo, hi in W.slices(off):
                parsed = Parsed(data, off, lo, hi)
                part = asked.slice(lo, hi - lo)
                flat = part.flatten()
                doc = np.repeat(np.arange(hi - lo), np.diff(part.offsets.to_numpy()))
                start, windows = (flat.field(k).to_numpy().astype(np.int64) for k in ("start", "windows"))
                ends = np.cumsum(windows)
                place = np.arange(windows.sum()) - np.repeat(ends - windows, windows)
                place += np.repeat(parsed.words.first[doc] + start, windows)
                hashes = pa.ListArray.from_arrays(
                    pa.array(np.append(0, ends).astype(np.int32)), pa.array(parsed.one.at(place, window).view(np.int64))
                )
                rows_of = pa.array(doc + lo)
                yield pa.RecordBatch.from_pydict(
                    {k: batch.column(k).take(rows_of) for k in KEY}
                    | {"start": flat.field("start"), "anchor": flat.field("anchor"), "times": flat.field("times")}
                    | {"hashes": hashes}
                )

    return run


def _removed(words: W.Words, spans: pa.ListArray, window: int) -> np.ndarray:
    """Which words lie in a window that recurs."""
    flat = spans.flatten()
    doc = np.repeat(np.arange(len(spans)), np.diff(spans.offsets.to_numpy()))
    start = words.first[doc] + flat.field("start").to_numpy().astype(np.int64)
    return W.covered(len(words), start, flat.field("windows").to_numpy().astype(np.int64) + window - 1)


def _cut(window: int):
    """Join factors to spans and take their words out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = W.text_bytes(batch.column("text"))
            for lo, hi in W.slices(off):
                words = W.Words(data, off, lo, hi)
                gone = _removed(words, batch.column("spans").slice(lo, hi - lo), window)
                removed = np.diff(np.append(0, np.cumsum(gone))[words.first])
                kept = []
                for i in range(hi - lo):
                    a, b = words.first[i], words.first[i + 1]
                    here = words.data[words.off[i] : words.off[i + 1]].tobytes().split()
                    kept.append(b" ".join(here if not removed[i] else [here[k] for k in np.flatnonzero(~gone[a:b])]))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part.column("id"),
                        "n_words": pa.array(words.count.astype(np.int64)),
                        "n_removed": pa.array(removed.astype(np.int64)),
                        "text": _texts(part.column("text"), kept, removed),
                        "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                        "rest": part.column("rest"),
                    }
                )

    return run


def _texts(before: pa.Array, kept: list[bytes], removed: np.ndarray) -> pa.Array:
    after = pa.array(kept, pa.binary()).cast(pa.string())
    return pc.if_else(pa.array(removed > 0), after, before.cast(pa.string()))


def parse(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each document with n_words, n_removed, its text and the hash of its kept words; "rest" has other columns.

    A text that loses words becomes the kept ones joined by spaces; others stay as they are.
    """
    rows = packed(docs, text_col, id=id_col).withColumn("id", F.col("id").cast("bigint"))
    rows = rows.select(
        F.coalesce("id", F.lit(0).cast("bigint")).alias("uid"), F.xxhash64("id", "text").alias("text_key"), "id", "text", "rest"
    )
    blocks = materialize(rows.select(*KEY, "text").mapInArrow(_index(window, anchor), BLOCKS), "blocks")
    again = (
        blocks.groupBy("anchor")
        .agg(F.count("*").alias("n"), (F.min("block") != F.max("block")).alias("varied"))
        .where("n > 1")
        .select("anchor", "varied")
    )
    # stored before it is joined, so that the join with a very common anchor can be split
    shared = materialize(blocks.join(materialize(again, "again"), "anchor"), "shared")
    # under anchors with one block only, every occurrence of the block recurs
    whole = shared.where(~F.col("varied")).select(*KEY, "start", "windows")
    varied = shared.where("varied")
    distinct = varied.groupBy("anchor", "block").agg(
        F.count("*").alias("times"), F.min(F.struct(*KEY, "start", "windows")).alias("at")
    )
    often = materialize(distinct.where("times > 1").select("anchor", "block"), "often")
    whole = whole.unionByName(varied.join(often, ["anchor", "block"], "left_semi").select(*KEY, "start", "windows"))
    asked = (
        distinct.select("at.*", "anchor", "times")
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("start", "windows", "anchor", "times")).alias("blocks"))
    )
    windows = (
        _beside(rows, asked)
        .mapInArrow(_boundary_windows(window), PLACES)
        .select(*KEY, "start", "anchor", "times", F.posexplode("hashes").alias("step", "hash"))
    )
    recurring = windows.groupBy("anchor", "hash").agg(F.sum("times").alias("n")).where("n > 1").select("anchor", "hash")
    parts = (
        windows.where("times = 1")
        .join(recurring, ["anchor", "hash"], "left_semi")
        .select(*KEY, (F.col("start") + F.col("step")).alias("start"), F.lit(1).alias("windows"))
    )
    spans = whole.unionByName(parts).groupBy(*KEY).agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    nothing = F.from_json(F.lit("[]"), "array<struct<start:int,windows:int>>")
    whole_rows = _beside(rows, spans).withColumn("spans", F.coalesce("spans", nothing))
    rest = rows.schema["rest"].dataType.simpleString()
    return whole_rows.mapInArrow(
        _cut(window),
        f"id bigint, n_words bigint, n_removed bigint, text string, kept_sha256 string, rest {rest}",
    )


def _beside(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """The rows with their list or null. Both uses shuffle the rows alike, so Spark does it once."""
    return rows.join(lists.hint("merge"), KEY, "left")


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, recurring passages cut out; texts that lose nothing stay as they are."""
    return unpacked(parse(docs, window, ANCHOR, id_col, text_col), docs.columns, text_col)

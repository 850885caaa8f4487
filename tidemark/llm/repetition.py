"""Quality rule: repetition within a text, from its suffix array.

The suffixes of each text's words are sorted by prefix doubling. Between
neighbours in that order the longest common prefix is found by bisection over
hashes of runs. A word's longest repeat is the larger of the two prefixes it
shares with its neighbours, which is the depth of the deepest LCP interval that
holds it; the spans of all maximal repeats of at least min_repeat words are
united. A text fails when they cover more than max_covered of its words or one
of them is longer than longest_repeat.

Defined cases: a null or empty text has no words and fails the base rule (fewer
than min_words); repeated rows are judged one by one; a text of any length is
read whole; further columns of the input, whatever their names, do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import words as W
from tidemark.llm.rows import column

SYMBOLS = b"#*$%&|<>"
SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, covered_words bigint, longest_repeat bigint"
)


@dataclass(frozen=True)
class Limits:
    """What a text may have.

    min_words and max_repeat_percent (words in 3-word windows found twice) are the
    base rule; the rest belong to the suffix array.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    min_repeat: int = 8
    max_covered: float = 0.3
    longest_repeat: int = 100


def suffix_order(symbols: np.ndarray, doc: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places sorted by the symbols from there to the end of their text.

    Texts are kept apart, so a suffix has neighbours of its own text only. Symbols
    may come in any fixed order. Only places whose order is still open are sorted
    again as the compared length doubles.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    new = np.ones(n, bool)
    new[1:] = symbols[order[1:]] != symbols[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ends, length = first[1:][doc], 1
    open_ = _open(new)
    while len(open_):
        places = order[open_]
        then = places + length
        inside = then < ends[places]
        second = np.where(inside, rank[np.where(inside, then, 0)] + 1, 0)
        group = rank[places]
        by = np.argsort(group * (n + 1) + second, kind="stable")
        places, group, second = places[by], group[by], second[by]
        order[open_] = places
        new = np.ones(len(places), bool)
        new[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        rank[places] = open_[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        open_ = open_[_open(new)]
        length *= 2
    return order


def _open(new: np.ndarray) -> np.ndarray:
    """Indexes of the members of groups of two or more."""
    alone = new & np.append(new[1:], True)
    return np.flatnonzero(~alone)


def longest_repeats(words: W.Words) -> np.ndarray:
    """For each word, the length of the longest run from there that its text holds twice."""
    n = len(words)
    longest = np.zeros(n, np.int64)
    if n == 0:
        return longest
    hashes = words.hashes()
    order = suffix_order(W.mix(hashes ^ W.mix(words.doc.astype(np.uint64))), words.doc, words.first)
    a, b = order[:-1], order[1:]
    near = (words.doc[a] == words.doc[b]) & (hashes[a] == hashes[b])
    a, b = a[near], b[near]
    ends, runs = words.first[1:][words.doc], W.Runs(hashes)
    limit = np.minimum(ends[a] - a, ends[b] - b)
    common = np.ones(len(a), np.int64)
    todo = np.arange(len(a))  # double the length while it holds, then bisect
    low, high = common.copy(), limit + 1
    step = 2
    while len(todo):
        todo = todo[step <= limit[todo]]
        same = runs.at(a[todo], step) == runs.at(b[todo], step)
        low[todo[same]] = step
        high[todo[~same]] = step
        todo = todo[same]
        step *= 2
    todo = np.flatnonzero(high - low > 1)
    while len(todo):
        middle = (low[todo] + high[todo]) // 2
        same = runs.at(a[todo], middle) == runs.at(b[todo], middle)
        low[todo[same]] = middle[same]
        high[todo[~same]] = middle[~same]
        todo = todo[high[todo] - low[todo] > 1]
    np.maximum.at(longest, a, low)
    np.maximum.at(longest, b, low)
    return longest


def _within(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many flags each text has."""
    return np.diff(np.append(0, np.cumsum(flags))[first])


def measures(data: np.ndarray, off: np.ndarray, lo: int, hi: int, limits: Limits) -> dict[str, np.ndarray]:
    words = W.Words(data, off, lo, hi)
    n_words, n = words.count.astype(np.int64), len(words)
    longest = longest_repeats(words)
    repeat = _within(W.covered(n, np.flatnonzero(longest >= 3), 3), words.first)
    long = np.flatnonzero(longest >= limits.min_repeat)
    covered = _within(W.covered(n, long, longest[long]), words.first)
    most = np.zeros(hi - lo, np.int64)
    np.maximum.at(most, words.doc, longest)

    raw, at = words.data, words.off
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    word_chars = _within(~space[raw] & ((raw & 0xC0) != 0x80), at)
    n_symbols = _within(symbol[raw], at)
    dup = np.zeros(hi - lo, np.int64)
    for i in range(hi - lo):
        lines = [x for x in raw[at[i] : at[i + 1]].tobytes().split(b"\n") if x.strip()]
        dup[i] = len(lines) - len(set(lines))
    failed = (n_words < limits.min_words) | (100 * repeat > limits.max_repeat_percent * n_words)
    kept = ~failed & (covered <= limits.max_covered * n_words) & (most <= limits.longest_repeat)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": dup,
        "n_repeat_words": repeat,
        "base_failed": failed,
        "kept": kept,
        "covered_words": covered,
        "longest_repeat": np.where(most >= limits.min_repeat, most, 0),
    }


def judge(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its counts and verdict; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = W.text_bytes(batch.column("text"))
            for lo, hi in W.slices(off):
                got = measures(data, off, lo, hi, limits)
                ids = batch.column("doc_id").slice(lo, hi - lo)
                yield pa.RecordBatch.from_pydict({"doc_id": ids} | {k: pa.array(v) for k, v in got.items()})

    pairs = docs.select(column(docs, id_col).cast("bigint").alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    return pairs.mapInArrow(run, SCHEMA)

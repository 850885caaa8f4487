"""Token ids of whole batches for a word-level byte-pair tokenizer.

The tokenizer composes characters (NFC), lower-cases, and encodes runs of letters,
single digits, runs of other signs and English contractions, each by itself. So
texts are cut into such parts with numpy, every distinct part is encoded once by
the tokenizers library and remembered by the worker, and ids are gathered.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from tidemark.llm import words as W

MOST_KNOWN = 1 << 20  # parts that a worker remembers; a bound of memory
_tables: list[np.ndarray] = []
_encoders: dict[str, Encoder] = {}

SPACE, LETTER, NUMBER, OTHER = range(4)


def tables() -> tuple[np.ndarray, np.ndarray]:
    """The kind of each code point and its lower case."""
    if not _tables:
        kind, lower = np.full(0x110000, OTHER, np.uint8), np.arange(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            letter = unicodedata.category(chr(c))[0]
            if letter == "L":
                kind[c] = LETTER
                low = chr(c).lower()
                lower[c] = ord(low) if len(low) == 1 else c
            elif letter in "NZ":
                kind[c] = NUMBER if letter == "N" else SPACE
                low = chr(c).lower()
                lower[c] = ord(low) if len(low) == 1 else c
            elif chr(c).lower() != chr(c):
                lower[c] = ord(chr(c).lower()[0])
        kind[[*range(0x09, 0x0E), 0x85]] = SPACE
        _tables.extend([kind, lower])
    return _tables[0], _tables[1]


class Encoder:
    """A tokenizer and the parts that it has encoded."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.begin, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids, where each text's begin, and the hash and text of every part."""
        odd = [i for i, t in enumerate(texts) if "İ" in t or "<|" in t]
        plain = list(texts)
        for i in odd:  # special tokens, and the letter whose lower case has two characters
            plain[i] = ""
        joined = "\n".join(plain)
        if not unicodedata.is_normalized("NFC", joined):
            plain = [unicodedata.normalize("NFC", t) for t in plain]
            joined = "\n".join(plain)
        kind, lower = tables()
        points = lower[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        start, end = _parts(points, kind[points])
        begins = np.cumsum([0, *[len(t) + 1 for t in plain]])[:-1]
        doc = np.searchsorted(begins, start, "right") - 1
        hashes = _hashes(points, start, end)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        slots = self._slots(distinct, points, start[first], end[first])[which]
        size = self.begin[slots + 1] - self.begin[slots]
        total = np.cumsum(size)
        place = np.arange(total[-1] if len(total) else 0) - np.repeat(total - size, size) + np.repeat(self.begin[slots], size)
        ids, per_text = self.ids[place], np.bincount(doc, size, len(texts)).astype(np.int64)
        if odd:
            pieces = np.split(ids, np.cumsum(per_text)[:-1])
            for i in odd:
                pieces[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
            ids, per_text = np.concatenate(pieces), np.array([len(p) for p in pieces])
        return ids, np.append(0, np.cumsum(per_text)), hashes, doc

    def _slots(self, keys: np.ndarray, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(self.keys) > MOST_KNOWN:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            parts = [points[a:b].tobytes().decode("utf-32-le", "surrogatepass") for a, b in zip(start[new], end[new])]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
            slots = len(self.begin) - 1 + np.arange(len(new))
            self.begin = np.append(self.begin, self.begin[-1] + np.cumsum([len(x) for x in found]))
            self.ids = np.concatenate([self.ids, np.array([i for x in found for i in x], np.uint32)])
            self.keys, self.slots = np.insert(self.keys, at[new], keys[new]), np.insert(self.slots, at[new], slots)
        return self.slots[np.searchsorted(self.keys, keys)]


def _parts(points: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.ones(n + 1, bool)
    edge[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    for i in np.flatnonzero((points[:-1] == ord("'")) & edge[: n - 1]):
        after = points[i + 1 : i + 3].tobytes().decode("utf-32-le", "surrogatepass")
        size = 1 if after[:1] in ("s", "t", "m", "d") else 2 if after in ("re", "ve", "ll") else 0
        if size:
            edge[i + 1 : i + 1 + size] = False
            edge[i + 1 + size] = True
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    solid = kind[start] != SPACE
    return start[solid], end[solid]


def _hashes(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(points) + 1, np.uint64)
    base = 0x9E3779B97F4A7C15
    np.cumsum(W.mix(points.astype(np.uint64) + np.uint64(1)) * W.powers(base, len(points)), out=sums[1:])
    inverse = W.powers(pow(base, -1, 1 << 64), len(points))
    return W.mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]

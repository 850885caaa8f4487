"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def repetition(text, min_repeat=8):
    """The op3 counts of a text, covered words and longest repeat."""
    w = words(text)
    n = len(w)
    windows = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    repeated = {j for i in range(n - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    longest, covered = 0, set()
    for i in range(n):
        best = 0
        for j in range(n):
            if i != j:
                k = 0
                while max(i, j) + k < n and w[i + k] == w[j + k]:
                    k += 1
                best = max(best, k)
        if best >= min_repeat:
            covered |= set(range(i, i + best))
            longest = max(longest, best)
    return {
        "n_words": n,
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "covered_words": len(covered),
        "longest_repeat": longest,
    }


def without_repeats(texts, window=35):
    """The kept words of each text: those in no window that starts elsewhere too."""
    seen = Counter()
    lists = [words(t) for t in texts]
    for w in lists:
        for i in range(len(w) - window + 1):
            seen[tuple(w[i : i + window])] += 1
    out = []
    for w in lists:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def sha(kept):
    return hashlib.sha256(" ".join(kept).encode()).hexdigest()


def lower_az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k=3):
    w = words(lower_az(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(ids, links):
    """The smallest id reachable from each."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}

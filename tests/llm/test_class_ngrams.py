from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import class_ngrams as C
from tidemark.llm import queries
from tidemark.llm import words as W

SF = "/root/testdata/sf0.001"
END = None


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def hashes(word):
    data = np.frombuffer(word.encode(), np.uint8)
    words = W.Words(data, np.array([0, len(data)]))
    return int(words.hashes()[0]), int(words.hashes(family=1)[0])


def f(x):
    return x * math.log(x) if x > 0 else 0.0


def plain(rows, rounds=C.ROUNDS):
    """(id, n_tokens, n_known, N, base, score) of each row, by dictionaries."""
    texts = [(i, brute.words(brute.lower_az(t))) for i, t in rows]
    train = [w for i, w in texts if not held_out(i)]
    total = Counter(x for w in train for x in [*w, END])
    name = {w: hashes(w) for w in total if w is not END}
    k = C.CLASSES
    seeds = sorted(name, key=lambda w: (-total[w], name[w]))[: k - 2]
    cls = {w: k - 1 for w in name} | {w: i + 1 for i, w in enumerate(seeds)} | {END: 0}
    pairs = Counter(p for w in train for p in zip([END, *w], [*w, END]))
    near = defaultdict(list)
    for (a, b), n in pairs.items():
        near[b].append((0, a, n))
        near[a].append((1, b, n))
    for turn in range(rounds):
        matrix, count = Counter(), Counter()
        for (a, b), n in pairs.items():
            matrix[cls[a], cls[b]] += n
        for w, n in total.items():
            count[cls[w]] += n
        moves = {}
        for w in name:
            if name[w][0] >> 63 != turn % 2:
                continue
            cells = Counter()
            for side, other, n in near[w]:
                cells[side, cls[other]] += n

            def change(c, sign):
                out = 0.0
                for (side, o), n in cells.items():
                    x = matrix[o, c] if side == 0 else matrix[c, o]
                    out += f(x + n) - f(x) if sign > 0 else f(x) - f(x - n)
                x, n = count[c], total[w]
                return out - 2 * (f(x + n) - f(x) if sign > 0 else f(x) - f(x - n))

            gains = {c: change(c, 1) for c in range(1, k) if c != cls[w]}
            best = max(gains, key=lambda c: (round(gains[c], 7), -c))
            if gains[best] > change(cls[w], -1) + 1e-7:
                moves[w] = best
        cls.update(moves)
    tri, bi, uni, once = Counter(), Counter(), Counter(), Counter()
    for w in train:
        c = [0, 0, *[cls[x] for x in [*w, END]]]
        for j, x in enumerate([*w, END], 2):
            tri[tuple(c[j - 2 : j + 1])] += 1
            bi[tuple(c[j - 1 : j + 1])] += 1
            uni[c[j],] += 1
            once[c[j - 1]] += total[x] == 1
    n_all, types, singles = sum(total.values()), len(total), sum(v == 1 for v in total.values())
    contexts = {0: defaultdict(list), 1: defaultdict(list), 2: defaultdict(list)}
    for size, table in ((0, uni), (1, bi), (2, tri)):
        for key, n in table.items():
            contexts[size][key[:-1]].append((key[-1], n))

    def p(history, c):
        have = contexts[len(history)].get(history, [])
        lower = p(history[1:], c) if history else 1 / k
        n = sum(x for _, x in have)
        return (dict(have).get(c, 0) + len(have) * lower) / (n + len(have)) if n else lower

    out = []
    for i, w in texts:
        base = score = 0.0
        two, one = 0, 0
        for x in [*w, END]:
            c = cls[x] if total[x] else C.UNKNOWN
            follow = sum(n for _, n in contexts[1].get((one,), []))
            u = min((once[one] + C.CONTEXT * (singles + 0.5) / (n_all + 1)) / (follow + C.CONTEXT), 1 - 1e-6)
            base += math.log10((total[x] + 1) / (n_all + types + 1))
            history = (one,) if C.UNKNOWN in (two, one) else (two, one)
            score += math.log10(u) if c == C.UNKNOWN else math.log10((1 - u) * p(history if one != C.UNKNOWN else (), c) * total[x] / uni[c,])
            two, one = one, c
        out.append((i, held_out(i), len(w) + 1, sum(total[x] > 0 for x in [*w, END]), n_all, base, score))
    return out


def check(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9) and a[6] == pytest.approx(b[6], rel=1e-6, abs=1e-6)


def test_equals_plain_model(spark):
    rng = random.Random(4)
    kinds = [[f"{c}{i}" for i in range(12)] for c in "AbcÉ"]
    rows = []
    for i in range(150):
        words, kind = [], rng.randrange(4)
        for _ in range(rng.randint(0, 40)):
            words.append(rng.choice(kinds[kind]))
            kind = (kind + rng.choice([1, 1, 1, 2])) % 4
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    rows += [(200, None), (201, ""), (None, "a b"), (5, rows[5][1]), (5, "once only"), (202, "x" * 9000 + " " + "b1 c2 " * 3000)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, chunk int")
    want = plain(rows)
    check(C.score(docs).collect(), want)
    # neither chunks nor buckets change anything
    check(C.score(docs.repartition(3), size=500, entries=7).collect(), want)
    assert C.score(docs.where("false")).count() == 0
    nobody = docs.where("doc_id = 200 or doc_id = 201").where("crc32(cast(doc_id as string)) % 7 = 2").union(docs.where("doc_id = 1").selectExpr("6L", "text", "chunk"))
    rows = [(r.doc_id, r.text) for r in nobody.collect()]
    assert all(held_out(i) for i, _ in rows)
    for r in C.score(nobody).collect():
        assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and math.isfinite(r.score) and r.score < 0


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(6)
    k = C.CLASSES
    three = rng.poisson(0.05, (k, k, k)) * (rng.random((k, k, 1)) < 0.3)
    model = C.Model(np.concatenate([three.ravel(), rng.poisson(0.5, k)]), 100, int(three.sum()), 9)
    total = 10.0 ** model.known.astype(float)
    for two in range(k + 1):
        for one in range(k + 1):
            assert total[two, one].sum() + 10 ** model.unknown[one] == pytest.approx(1)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op12_brown_class_ngrams(spark, SF).collect()
    check(got, plain(docs))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held) and len(got) == len(docs)

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from tests.compare import connect, differences
from tests.llm import brute
from tidemark.llm import block_search as B
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(brute.lower_az(text))


def plain(docs, items, top=B.TOP):
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in set(items):
        found = []
        for i, c in held:
            n = sum(c.values())
            m = 50 + 50 * n * n_docs // length
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def got(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


def test_equals_plain_search(spark):
    rng = random.Random(5)
    vocabulary = [[f"{c}{i}" for i in range(30)] for c in ("Ab", "é", "x", "漢")]
    docs = []
    for i in range(400):
        own = vocabulary[i % 4]
        docs.append((i, rng.choice([" ", "-", "\n"]).join(rng.choice(own if rng.random() < 0.9 else vocabulary[0]) for _ in range(rng.randint(1, 30)))))
    docs += [(500, None), (501, ""), (502, "!? |"), (None, docs[3][1]), (None, docs[3][1]), (7, docs[7][1])]
    docs += [(600 + i, "Ab1 Ab2 é3") for i in range(80)] + [(700, "x1 " * 4000 + "q" * 5000)]
    items = [(i, " ".join(rng.choice(rng.choice(vocabulary)) for _ in range(rng.randint(1, 12)))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "unheard of"), (53, "AB1 ab1 É3"), (53, "AB1 ab1 É3"), (54, "q" * 5000), (55, "ab1, ab2; é3")]
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")
    table = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id bigint, text string, item_id int")
    want = plain(docs, items)
    assert got(B.search(table, asked)) == want
    # small shards, blocks, samples and sets of items change nothing
    assert got(B.search(table.repartition(3), asked, shard=64, block=5, pilot=60, set_size=11)) == want
    assert got(B.search(table, asked, top=3, shard=100, block=8, pilot=100)) == plain(docs, items, 3)
    assert B.search(table.where("false"), asked).count() == 0
    assert B.search(table, asked.where("false")).count() == 0


def test_blocks_are_skipped():
    rng = np.random.default_rng(8)
    kinds = [rng.choice(160, 12, replace=False) for _ in range(40)]
    rows = [np.unique(np.append(kinds[i % 40][:10], rng.integers(0, 160, 2))) for i in range(2000)]
    ends = np.cumsum([0, *map(len, rows)])
    term = np.concatenate(rows)
    value = rng.integers(1, 1000, 160)[term] * rng.integers(90, 100, len(term))  # as of terms rare and common
    chosen = [np.unique(rng.integers(0, 160, 8)) for _ in range(20)]
    first = np.cumsum([0, *map(len, chosen)])
    items = B.Items(np.arange(160, dtype=np.uint64), np.zeros(161, np.int64), np.zeros(0, np.uint8), first, np.concatenate(chosen))
    shard = B.Shard(ends, term, value, 160, 16)
    item, doc, score = shard.search(items, np.zeros(20, np.int64), np.arange(2000), 10)
    dense = np.zeros((2000, 160), np.int64)
    dense[np.repeat(np.arange(2000), np.diff(ends)), term] = value
    held = 0
    for q, terms_of in enumerate(chosen):
        points = dense[:, terms_of].sum(1)
        held += int((points > 0).sum())
        best = np.lexsort((np.arange(2000), -points))[:10]
        assert doc[item == q].tolist() == best[points[best] > 0].tolist()
        assert score[item == q].tolist() == points[best][points[best] > 0].tolist()
    assert shard.scored < 0.7 * held  # documents that share a term with the item


def test_query(spark):
    tables = [[(r[0], r[1]) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id"))]
    assert got(queries.op13_geometric_block_search(spark, SF)) == plain(*tables)
    assert differences(queries.op13_geometric_block_search(spark, SF), connect(SF), B.ORACLE_SQL) == []

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import tidemark.llm.jaccard_join as J
from tests.llm import brute
from tidemark.llm import queries
from tidemark.llm.components import components

SCHEMA = "doc_id bigint, text string, node string, rest int, uid int"


def corpus():
    """Texts of all sizes with copies, some edited so that similarity lies around the limit."""
    rng = random.Random(5)
    out = [None, "", "\n", "one", "One", "one two", "a b c", "A  b\tC", "a b c d"]
    for size in (9, 10, 11, 12, 20, 40, 80, 150, 300):
        for _ in range(2):
            base = [f"w{rng.randint(0, 5000)}" for _ in range(size + 2)]
            for edits in range(0, max(2, size // 20)):
                for _ in range(4):
                    text = list(base)
                    for _ in range(edits):
                        text[rng.randrange(len(text))] = f"e{rng.randint(0, 10**6)}"
                    out.append(" ".join(text[: len(text) - rng.randint(0, 2)]))
    base = [f"h{rng.randint(0, 5000)}" for _ in range(120)]
    for _ in range(150):  # one large group of near copies, all different
        text = list(base)
        for _ in range(2):
            text[rng.randrange(len(text))] = f"e{rng.randint(0, 10**6)}"
        out.append(" ".join(text))
    return out


def wanted(texts):
    sets = [brute.shingles(t) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])
    ]
    return sets, brute.components(range(len(sets)), links)


@pytest.mark.parametrize("rounds, block", [(0, 20), (2, 512)])
def test_equals_brute_force(spark, monkeypatch, rounds, block):
    monkeypatch.setattr(J, "ROUNDS", rounds)
    monkeypatch.setattr(J, "BLOCK", block)
    texts = corpus()
    texts += [texts[20], texts[40]]
    rows = [(i, t, "n", 1, 2) for i, t in enumerate(texts)]
    got = J.similar_documents(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    sets, component = wanted(texts)
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), component[i]) for i in component}


def test_one_of_each(spark):
    rows = [(5, "a b c d", "n", 1, 2), (3, "A b c d", "n", 3, 2), (3, "A b c d", "n", 4, 2), (7, None, None, 1, 2)]
    rows += [(8, "", "n", 1, 1), (None, "x y z", "n", 1, 1), (None, "a b c d", "n", 9, 9), (9, "other words here", "n", 0, 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = J.one_of_each(frame)
    assert got.schema.simpleString() == frame.schema.simpleString()
    assert sorted(str(r.doc_id) for r in got.collect()) == ["3", "7", "8", "9", "None"]
    assert J.one_of_each(frame.where(F.lit(False))).count() == 0


def test_one_of_each_with_repeated_and_null_ids(spark):
    rows = [(1, "a b c d", "n", 1, 1), (1, "unlike words of its own", "n", 2, 1), (2, "A b c d", "n", 3, 1)]
    rows += [(None, "x y z", "n", 4, 1), (None, "X y z", "n", 5, 1), (None, "x  y z", "n", 6, 1)]
    got = sorted(r.text.lower().split()[0] for r in J.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == ["a", "unlike", "x"]


def test_sketches_of_similar_sets_share_a_bucket():
    rng = np.random.default_rng(2)
    starts = np.array(J.bands(5000))
    for _ in range(2000):
        n = int(rng.integers(10, 400))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        gone = int(rng.integers(0, n // 19 + 1))
        extra = int(rng.integers(0, n // 19 + 1))
        b = np.concatenate([a[gone:], rng.integers(0, 1 << 63, extra, dtype=np.uint64)])
        if (gone or extra) and J.linked(n - gone, n, len(b)):
            assert set(J.parity_keys(a, 90, starts).tolist()) & set(J.parity_keys(b, 90, starts).tolist()), (n, gone, extra)


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7)]
    links += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == brute.components(linked, [(a, b) for a, b in links if a != b])


def test_query_has_every_document(spark):
    got = queries.op4_parity_sketch_jaccard_join(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    sets, component = wanted([d.text for d in docs])
    least = [d.doc_id for d in docs]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {
        d.doc_id: (len(sets[i]), least[component[i]]) for i, d in enumerate(docs)
    }


def test_bounded_parts_find_similar_sets():
    rng = np.random.default_rng(3)
    starts = np.array(J.bands(5000))
    for _ in range(500):
        n = int(rng.integers(200, 900))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        gone = n // 10
        b = np.concatenate([a[gone:], rng.integers(0, 1 << 63, gone, dtype=np.uint64)])
        keys = J.parity_keys(a, 80, starts, J.PARTS)
        assert len(keys) <= 2 * J.PARTS
        assert set(keys.tolist()) & set(J.parity_keys(b, 80, starts, J.PARTS).tolist())


def test_no_written_frame_holds_every_bucket_key(spark, monkeypatch):
    """The classes' bucket keys are shuffled once; only the members of buckets with two classes are written."""
    written, keys = {}, []

    def counted(df, name="table"):
        out = materialize(df, name)
        if name == "sketches":
            keys.append(out.dropDuplicates(["n", "one", "two"]).select(F.sum(F.size("keys"))).first()[0])
        else:
            written[name] = max(written.get(name, 0), out.count())
        return out

    materialize = J.materialize
    monkeypatch.setattr(J, "materialize", counted)
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = J.similar_documents(docs).collect()
    sets, component = wanted(texts)
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == {
        i: (len(sets[i]), component[i]) for i in range(len(texts))
    }
    assert max(written.values()) < keys[0]


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_share_as_many_buckets_as_each_needs(percent):
    rng = np.random.default_rng(4)
    starts = np.array(J.bands(5000))
    tried = 0
    for _ in range(1500):
        n = int(rng.integers(5, 700))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        most = n * (100 - percent) // percent
        gone, extra = int(rng.integers(0, most + 1)), int(rng.integers(0, most + 1))
        if rng.random() < 0.3:  # all differences on one side
            gone, extra = rng.permutation([most, 0])
        b = np.concatenate([a[gone:], rng.integers(0, 1 << 63, extra, dtype=np.uint64)])
        if not (gone or extra) or not J.linked(n - gone, n, len(b), percent):
            continue
        tried += 1
        mine, other = J.parity_bands(a, percent, starts), J.parity_bands(b, percent, starts)
        shared = [(int(((x == y) & (x > 0)).sum()), p, q) for k, p, x in mine for l, q, y in other if k == l]
        assert any(both >= max(p, q) for both, p, q in shared), (n, gone, extra)
    assert tried > 300


def test_unlike_sets_of_a_size_write_no_sets(spark, monkeypatch):
    """Unlike texts of a size, all with one passage: none shares as many buckets as a similar pair would."""
    written = {}

    def counted(df, name="table"):
        out = materialize(df, name)
        written[name] = max(written.get(name, 0), out.count())
        return out

    materialize = J.materialize
    monkeypatch.setattr(J, "materialize", counted)
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(30)]
    texts = [[*(f"w{rng.randrange(10**6)}" for _ in range(200)), *passage] for _ in range(60)]
    texts.append([*texts[0][:-1], "last"])
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    kept = J.one_of_each(docs, 5, 80).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == list(range(60))
    assert written["sets"] == 2

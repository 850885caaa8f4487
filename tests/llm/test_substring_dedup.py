from __future__ import annotations

import random

from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import queries
from tidemark.llm import words as W
from tidemark.llm.substring_dedup import least_places, parse, without_repeats

SCHEMA = "doc_id bigint, text string, anchor string, rest string, uid int"


def corpus():
    """Texts that share passages of about a window's length, edited in places."""
    rng = random.Random(7)
    passages = [[f"w{rng.randint(0, 400)}" for _ in range(n)] for n in (34, 35, 36, 40, 70, 90, 200)]
    out = [None, "", " ", "one", " ".join(passages[0]), " ".join(["x"] * 36), " ".join(["x", "y"] * 40)]
    for _ in range(70):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts += [f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 40))]
            part = list(rng.choice(passages))
            if rng.random() < 0.5:
                part[rng.randrange(len(part))] = "edit"
            at = rng.randint(0, 10)
            parts += part[at:] if rng.random() < 0.3 else part
        out.append(rng.choice([" ", "\n", "\t "]).join(parts))
    return out


def test_equals_brute_force(spark):
    texts = corpus()
    texts += [texts[10], texts[10]]
    rows = [(None if i in (8, 9) else i, t, "a", "r", 1) for i, t in enumerate(texts)]
    rows.append(rows[-1])  # the same row again
    got = parse(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    kept = brute.without_repeats([r[1] for r in rows])
    want = sorted((str(r[0]), len(brute.words(r[1])), len(brute.words(r[1])) - len(k), brute.sha(k)) for r, k in zip(rows, kept))
    assert sorted((str(r.id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == want


def test_columns_and_texts(spark):
    shared = " ".join(f"s{i}" for i in range(50))
    rows = [(1, f"a\nb  {shared} c", "a", "r", 1), (2, f"{shared}", "a", "r", 2), (3, "left  as\nit is", "a", None, 3), (4, None, None, "r", 4)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = without_repeats(frame)
    assert got.schema.simpleString() == frame.schema.simpleString()
    assert {r.doc_id: r.text for r in got.collect()} == {1: "a b c", 2: "", 3: "left  as\nit is", 4: None}
    assert without_repeats(frame.where(F.lit(False))).count() == 0


def test_least_places_across_blocks(monkeypatch):
    import numpy as np

    import tidemark.llm.substring_dedup as module

    monkeypatch.setattr(module, "BLOCK_PLACES", 50)
    hashes = W.mix(np.arange(333, dtype=np.uint64))
    want = [i + int(np.argmin(hashes[i : i + 28])) for i in range(333 - 27)]
    assert least_places(hashes, 28).tolist() == want


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    kept = dict(zip([d.doc_id for d in docs], brute.without_repeats([d.text for d in docs])))
    got = queries.op1_relative_lz_substring_dedup(spark, sf_dir).collect()
    assert {r.doc_id: r.kept_sha256 for r in got} == {i: brute.sha(k) for i, k in kept.items()}

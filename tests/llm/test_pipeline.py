"""The corpus pipeline, stage by stage, against plain versions."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import mixing, toxicity
from tidemark.llm import words as W
from tidemark.session import materialize

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, uid string, place int"
INSULTS = ["vile", "scum", "filth", "vermin"]


def corpus():
    """Toxic documents, near copies, a shared passage of 50 words, wordless texts, repeated rows, a null id and source."""
    rng = random.Random(11)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = {i: fresh(rng.randrange(40, 90)) for i in range(120)}
    toxic = set(range(0, 120, 3))
    for i in toxic:
        for _ in range(6):
            texts[i].insert(rng.randrange(len(texts[i])), rng.choice(INSULTS))
    passage = fresh(50)
    for i in (31, 61, 91):
        texts[i] = texts[i][:20] + passage + texts[i][20:]
    for copy, of in ((121, 1), (122, 1), (124, 122)):
        texts[copy] = [*texts[of][:-1], fresh(1)[0]]
    rows = [(i, " ".join(w)) for i, w in sorted(texts.items())]
    rows += [(125, None), (126, ""), (127, " \n"), (128, " ".join(texts[40])), (40, " ".join(texts[40]))]
    rows += [(None, " ".join(fresh(60)))]
    docs = [(i, t, "en", (None, "web", "books")[(i or 0) % 3 if (i or 0) % 5 else 1], len(t or ""), "u", 7) for i, t in rows]
    return docs, [(i, 1, int(i in toxic)) for i in range(120)], toxic


def plain_score(machine, text):
    """Bias, weights and the factors' products of all pairs of the text's terms, one by one."""
    data, off = W.text_bytes(pa.array([text], pa.string()))
    held = [k for k, b in enumerate(machine.buckets) if b in set(toxicity.terms(data, off, 0, 1)[1])]
    logit = machine.bias + sum(machine.weights[k] for k in held)
    logit += sum(machine.factors[a] @ machine.factors[b] for a, b in combinations(held, 2))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def rows_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_every_stage(spark, folder, monkeypatch):
    docs, labels, toxic = corpus()
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    stages = []

    def stored(df, name):
        stages.append(materialize(df, name))
        return stages[-1]

    machines, train = [], toxicity.train

    def trained(*args):
        machines.append(train(*args))
        return machines[-1]

    monkeypatch.setattr(corpus_pipeline, "materialize", stored)
    monkeypatch.setattr(toxicity, "train", trained)
    pieces = [r.asDict() for r in corpus_pipeline.run(spark, folder).collect()]
    assert all(s.columns == [c.split()[0] for c in COLUMNS.split(", ")] for s in stages)
    harmless, once, cut, mixed = (rows_of(s) for s in stages)

    # documents that the trained machine scores high go, all others stay as they were
    want = [(d[0], d[1], d[3]) for d in docs if plain_score(machines[0], d[1]) < toxicity.LIMIT]
    assert Counter(harmless) == Counter(want)
    assert {d[0] for d in docs} - toxic <= {i for i, _, _ in harmless}
    assert len(toxic & {i for i, _, _ in harmless}) <= 0.1 * len(toxic)

    # one row of each component of near copies; wordless texts all stay
    sets = [brute.shingles(t, corpus_pipeline.NEAR_WORDS) for _, t, _ in harmless]
    near = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= corpus_pipeline.NEAR_PERCENT * len(sets[a] | sets[b])
    ]
    groups = defaultdict(set)
    for row, component in brute.components(range(len(sets)), near).items():
        groups[component].add(harmless[row])
    assert len(once) == len(groups) and set(once) <= set(harmless)
    assert all(sum((row in group) for row in once if row[1] and row[1].split()) <= 1 for group in groups.values() if len(group) > 1)
    assert all(any(row in group for row in once) for group in groups.values())
    assert {i for i, t, _ in once if not (t or "").split()} == {125, 126, 127}

    # passages that recur go from all documents
    kept = brute.without_repeats([t for _, t, _ in once])
    assert {(i, s): brute.words(t) for i, t, s in cut} == {(i, s): w for (i, _, s), w in zip(once, kept)}
    assert sum(len(brute.words(t)) for _, t, _ in cut) == sum(len(brute.words(t)) for _, t, _ in once) - 150
    assert all(r.n_chars == len(r.text or "") for r in stages[2].collect() if r.text is not None)

    # the mix takes what the SQL of its operator says
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?)", [list(r) for r in cut])
    at = {c[0]: k for k, c in enumerate(db.execute(mixing.ORACLE_SQL).description)}
    taken = {r[at["doc_id"]]: r[at["taken"]] for r in db.execute(mixing.ORACLE_SQL).fetchall()}
    got = Counter()
    for i, t, _ in mixed:
        got[i] += len(brute.words(t))
    assert {i: n for i, n in taken.items() if n} == {i: n for i, n in got.items() if n}

    # every token of every copy lies in one place of one sequence
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    tokens = Counter()
    for i, t, _ in mixed:
        tokens[i] += len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    packed, places = Counter(), defaultdict(list)
    for p in pieces:
        packed[p["doc_id"]] += p["length"]
        places[p["sequence_id"]].append((p["offset"], p["length"]))
    assert packed == tokens
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 2048


def test_an_empty_corpus(spark, folder):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_near_copies_that_bounded_parts_miss(spark):
    """Two long texts at 0.8 whose differences fall in the first 64 parts of each band they join on."""
    import numpy as np

    from tidemark.llm import jaccard_join as J

    size, percent = corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT

    def shingles(words):
        data, off = W.text_bytes(pa.array([" ".join(words)], pa.string()))
        return next(J.shingle_sets(data, off, 0, 1, size))

    rng = random.Random(5)
    a = [f"w{i}" for i in range(8000)]
    runs = np.array([shingles(a[i : i + size])[0] for i in range(len(a) - size + 1)])
    starts = np.array(J.bands(8 * len(runs)))
    own = int(np.searchsorted(starts, len(runs), "right")) - 1
    b = list(a)
    for band in (own, own + 1):
        top = int(starts[band + 1]) - 1
        parts = max(J.PARTS, int((J.difference(top, top, percent) + 1) / 1.5))
        part = ((runs >> np.uint64(33)) % np.uint64(parts)).astype(int)
        for p in range(J.PARTS):
            at = np.flatnonzero(part == p)
            if len(at) and all(b[i] == a[i] for i in range(at[0], at[0] + size)):
                b[at[0]] = f"x{rng.randrange(10**9)}"
    one, two = shingles(a), shingles(b)
    assert J.linked(len(set(one.tolist()) & set(two.tolist())), len(one), len(two), percent)
    capped = set(J.parity_keys(one, percent, starts, J.PARTS).tolist())
    assert not capped & set(J.parity_keys(two, percent, starts, J.PARTS).tolist())

    docs = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b)), (3, "lone words here")], "doc_id bigint, text string")
    kept = corpus_pipeline.one_of_similar(spark, docs, "unused").collect()
    assert sorted(r.doc_id for r in kept) == [1, 3]

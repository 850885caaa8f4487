from __future__ import annotations

import base64
import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import defaultdict
from decimal import Decimal

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.compare import connect, differences
from tests.llm import brute
from tidemark.llm import embedding_forest, mixing, packing, pu_quality, queries, tokens, toxicity, url_rules, warc
from tidemark.llm import words as W
from tidemark.session import materialize

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


def test_tokens_equal_the_library():
    rng = random.Random(1)
    bits = ["'s", "'re", "'ll", "'", "d", "ve", "a", "B", "É", "é", "1", "२", "!", "..", "漢", "ß", " ", "\x85", "ﬁ", "Σ", "<|endoftext|>", "İ", "😀"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    got = tokens.Encoder(PATH)
    ids, at, *_ = got.encode(texts)
    want = [e.ids for e in got.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_packing(spark):
    rng = random.Random(2)
    texts = [None, "", "a", "b c " * 5000] + [" ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(1, 900))) for _ in range(60)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "a b", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start int")
    pieces = materialize(packing.pack(docs, PATH))
    tokenizer = Tokenizer.from_file(PATH)
    by, sequences = defaultdict(list), defaultdict(list)
    for p in pieces.collect():
        by[p.doc_id].append(p), sequences[p.sequence_id].append(p)
    for doc_id, text, _ in rows:
        ids, at = tokenizer.encode(text or "", add_special_tokens=False).ids + [1], 0
        for p in sorted(by[doc_id], key=lambda p: p.start):
            cut = np.array(ids[p.start : p.start + p.length], "<u4")
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(cut.tobytes()))
            at += p.length
        assert at == len(ids)
    for members in sequences.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.LENGTH
    crc = {(p.sequence_id, p.offset): p.ids_crc32 for p in pieces.collect()}
    for p in packing.token_pieces(docs, pieces, PATH).collect():
        assert crc[p.sequence_id, p.offset] == zlib.crc32(np.array(p.ids, "<u4").tobytes())
    assert packing.pack(docs.where(F.lit(False)), PATH).count() == 0


def test_hilbert_neighbours_touch():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    places = packing.hilbert(cells, 3)
    assert sorted(places.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(axis=1) == 1).all()


def test_mixing(spark):
    assert differences(queries.op6_systematic_mixing(spark, SF), connect(SF), mixing.ORACLE_SQL) == []
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "b", "c", None]), 5) for i in range(3000)]
    rows += [(None, None, "a", 1), (7, "same row", "b", 1), (7, "same row", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int")
    drawn = mixing.draw(docs, rows_per_task=100).collect()
    taken, target = defaultdict(int), {}
    for r in drawn:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 41 for s in target)
    assert mixing.mixed(docs).count() == sum(r["copies"] for r in drawn)
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mixed(docs.where(F.lit(False))).count() == 0


def test_url_rules(spark):
    urls = [
        (1, "https://www.EXAMPLE.com/en/1", ("www.example.com", "/en/1", "www.example.com/en/", "allow")),
        (2, "http://a.example.com/en/x?q", ("a.example.com", "/en/x", "example.com/en/", "block")),
        (3, "http://b.net/fr/", ("b.net", "/fr/", "net/fr/", "block")),
        (4, "http://xcom/en", ("xcom", "/en", None, "allow")),
        (5, None, ("", "", None, "allow")),
        (6, "no host", ("", "", None, "allow")),
        (7, "http://a.com", ("a.com", "", None, "allow")),
    ]
    rows = [(i, u, "x") for i, u, _ in urls] + [(10 + i, f"http://s{i}.net/es/{i}", "x") for i in range(50)] + [(99, "http://q.org/es/1", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    got = {r.page_id: r for r in url_rules.judge(pages).collect()}
    assert len(got) == len(rows)
    assert all((got[i].host, got[i].path, got[i].rule, got[i].verdict) == want for i, _, want in urls)
    assert got[99].rule is None and got[99].verdict == "block"  # "es" nearly always leads to a block
    assert url_rules.judge(pages.where(F.lit(False))).count() == 0


def test_loser_tree():
    rng = random.Random(4)
    for k in range(7):
        runs = [sorted((rng.randint(0, 9), i) for i in range(rng.randint(0, 12))) for _ in range(k)]
        got = [runs[r][i] for r, i in warc.merged(runs)]
        assert got == sorted(x for run in runs for x in run)


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [(i, f"http://h{i % 3}.com/{i % 5}", f"<p>{i % 7}é\r\n\r\n</p>" * (i % 7), i) for i in range(60)]
    rows += [(100, None, None, 1), (101, "a\nb", "", 1), (None, "http://x", "<p>1é\r\n\r\n</p>", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, at int").repartition(4)
    first: dict = {}
    for i, _, html, _ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        first.setdefault(html or "", i)
    got = {r.page_id: r for r in warc.archive_and_merge(pages).collect()}
    assert len(got) == len(rows)
    for i, _, html, _ in rows:
        payload, leader = (html or "").encode(), first[html or ""]
        want = (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        want += ("response", None) if leader == i else ("revisit", leader)
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == want
    order = [r.url_key for r in sorted(got.values(), key=lambda r: r.place)]
    assert order == sorted(order)
    assert warc.archive_and_merge(pages.where(F.lit(False))).count() == 0


def test_embedding_forest(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 16))
    vectors = np.concatenate([base[rng.integers(0, 60)] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.3]) for _ in range(400)]).reshape(-1, 16)
    rows = [(i, v.tolist(), int(i % 2), "x") for i, v in enumerate(vectors)]
    rows += [(900, rows[0][1], 0, "x"), (901, None, 0, "x"), (902, [0.0] * 16, 0, "x"), (903, [float("nan")] * 16, 0, "x"), (904, rows[0][1], None, "x")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, node string")
    got = {r.vec_id: r for r in embedding_forest.near_duplicates(frame, leaf_size=60).collect()}
    fine = [r for r in rows if r[0] < 901]
    unit = np.array([r[1] for r in fine], np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & np.equal.outer([r[2] for r in fine], [r[2] for r in fine])
    links = {(fine[a][0], fine[b][0]) for a, b in zip(*np.nonzero(np.triu(near, 1)))}
    assert sum(r.n_links for r in got.values()) >= 0.9 * 2 * len(links)
    counts = {r[0]: int(n) - 1 for r, n in zip(fine, near.sum(axis=1))}
    assert all(got[i].n_links <= n for i, n in counts.items())
    assert got[900].component_id == got[0].component_id
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in (901, 902, 903, 904))
    assert embedding_forest.near_duplicates(frame.where(F.lit(False))).count() == 0


def test_forest_keeps_the_links_of_a_large_group(spark):
    """1,000 unlike vectors of pair cosine about 0.96, with and without others of their label: no random cut can part them."""
    rng = np.random.default_rng(7)
    unit = rng.normal(size=(1001, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    group, others = unit[0] + unit[1:] * (1 / 0.96 - 1) ** 0.5, rng.normal(size=(1500, 32))
    vectors = np.concatenate([group, group, others]).astype(np.float32)
    labels = [0] * 1000 + [1] * 2500
    rows = [(i, v.tolist(), k) for i, (v, k) in enumerate(zip(vectors, labels))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r.vec_id: r for r in embedding_forest.near_duplicates(frame, leaf_size=100).collect()}
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & np.equal.outer(labels, labels)
    counts = near.sum(axis=1) - 1
    assert counts[:2000].min() > 900
    assert [got[i].n_links for i in range(1000)] == counts[:1000].tolist()
    assert sum(got[i].n_links for i in range(1000, 3500)) >= 0.999 * counts[1000:].sum()
    assert all(got[i].n_links <= n for i, n in enumerate(counts))


@pytest.mark.parametrize("name, label", [("op9_positive_unlabelled_quality", "quality"), ("op10_factorization_machine_toxicity", "toxic")])
def test_scorers_on_held_out_rows(spark, name, label):
    sf_dir = "/root/testdata/sf0.1"
    got = queries.QUERIES[name](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r[label] for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_scorers_without_labels_or_texts(spark):
    docs = spark.createDataFrame([(1, None, 5), (None, "", 5), (3, "idiot", 5)], "doc_id bigint, text string, score int")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for module in (toxicity, pu_quality):
        got = module.score(docs, module.train(docs, none)).collect()
        assert len(got) == 3 and all(r.score == 0 and r.predicted == 0 for r in got)
    assert toxicity.harmless(docs, None).columns == docs.columns


def test_pairs_need_factors():
    """An insult beside a mention of a group is toxic, either alone is not: additive weights can't say so."""
    rng = np.random.default_rng(1)
    insult, group = rng.integers(0, 2, 2000), rng.integers(0, 2, 2000)
    x = np.stack([insult, group], 1)
    doc, term = np.nonzero(x)
    machine = toxicity.fit(doc, term, insult ^ group ^ 1, np.array([5, 9]))
    assert ((machine.logits(doc, term, 2000) > 0) == (insult == group)).mean() == 1


def test_pairs_are_found_in_texts(spark):
    """Neither term tells anything alone, so only their pair can have brought them in."""
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(3000):
        insult, group = rng.integers(0, 2, 2)
        words = [f"w{k}" for k in rng.integers(0, 300, 12)] + ["insult"] * insult + ["people"] * group
        rows.append((i, " ".join(rng.permutation(words))))
        labels.append((i, int(insult == group)))
    docs, known = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    machine = toxicity.train(docs, known)
    got = toxicity.score(docs, machine).collect()
    held = [(r.predicted, labels[r.doc_id][1]) for r in got if r.held_out]
    assert len(held) > 500 and np.mean([a == b for a, b in held]) >= 0.95
    # the score is the sum over pairs, written out
    for i in range(20):
        own = set(toxicity.terms(*W.text_bytes(pa.array([rows[i][1]])), 0, 1)[1].tolist())
        at = [k for k, b in enumerate(machine.buckets) if b in own]
        logit = machine.bias + sum(machine.weights[k] for k in at)
        logit += sum(float(machine.factors[a] @ machine.factors[b]) for k, a in enumerate(at) for b in at[k + 1 :])
        assert next(r.score for r in got if r.doc_id == i) == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-9)


def test_held_out_labels_are_not_learned(spark):
    rows = [(i, f"{'vile' if i % 2 else 'kind'} a{i % 7} b{i % 5}") for i in range(400)] + [(i, "kind") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    held = {i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1}
    scores = []
    for flipped in (0, 1):
        labels = [(i, (i % 2) ^ (flipped if i in held else 0)) for i in range(400)] + [(1, None)]
        labels += [(2, 1), (2, 0)]  # disagree
        known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
        got = toxicity.score(docs, toxicity.train(docs, known)).collect()
        scores.append(sorted((r.doc_id, r.score) for r in got))
        assert len(got) == len(rows)
    assert scores[0] == scores[1]


def test_forest_compares_labels_of_any_type(spark):
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(4, 8))
    cases = {
        "double": [1.2, 1.4, 1.2, 0.0, -0.0, None],
        "string": ["a b", "a  b", "a b", "é", "é", None],
        "bigint": [1 << 40, (1 << 40) + 1, 1 << 40, -5, -5, None],
        "decimal(10,2)": [Decimal("1.20"), Decimal("1.21"), Decimal("1.20"), Decimal("0"), Decimal("0"), None],
    }
    for kind, labels in cases.items():
        rows = [(i, vectors[0].tolist(), label) for i, label in enumerate(labels)]
        frame = spark.createDataFrame(rows, f"vec_id bigint, embedding array<double>, label {kind}")
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_forest.near_duplicates(frame).collect()}
        assert got == {0: (1, 0, True), 1: (0, 1, True), 2: (1, 0, False), 3: (1, 3, True), 4: (1, 3, False), 5: (0, 5, True)}


def test_forest_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    fine = [r for r in rows if r.embedding is not None and r.label is not None and None not in r.embedding]
    unit = np.array([r.embedding for r in fine], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & np.equal.outer([r.label for r in fine], [r.label for r in fine])
    np.fill_diagonal(near, False)
    links = [(fine[a].vec_id, fine[b].vec_id) for a, b in zip(*np.nonzero(near))]
    component = brute.components([r.vec_id for r in rows], links)
    count = {r.vec_id: 0 for r in rows} | {r.vec_id: int(n) for r, n in zip(fine, near.sum(1))}
    got = queries.op7_projection_tree_forest(spark, SF).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (count[i], component[i]) for i in count}


def url_tokens(url):
    host, path = (re.search(r"://([^/?#]*)([^?#]*)", url) or re.match("()()", "")).groups()
    query = re.search(r"\?([^#]*)", url)
    out = [f"host:{x}" for x in host.lower().split(".") if x] + [f"path:{x}" for x in path.split("/") if x]
    out += [f"extension:{x}" for x in re.findall(r"\.([A-Za-z0-9]+)$", path)]
    out += [f"query:{x.split('=')[0]}" for x in (query.group(1) if query else "").split("&") if x.split("=")[0]]
    return {k + ":" + re.sub("[0-9]+", "0", v) for k, v in (x.split(":", 1) for x in out)}


def test_mined_verdicts_equal_brute_force(spark):
    """Every combination of tokens of an unlisted url, counted over the listed ones."""
    rng = random.Random(7)
    hosts = ["a.net", "b.net", "x.com", "www.example.com", "example.com", "c.org", "d.org"]
    urls = []
    for i in range(400):
        path = "/".join(rng.choice(["en", "es", "fr", "ads", "ads", "shop", f"p{rng.randint(0, 99)}"]) for _ in range(rng.randint(1, 4)))
        urls.append((i, f"http://{rng.choice(hosts)}/{path}{rng.choice(['', '.html', '?id=3&q', '?q'])}"))
    urls += [(500, urls[3][1]), (501, urls[3][1]), (None, "http://c.org/ads"), (502, "http://c.org/" + "ads/" * 3000)]
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    mining = url_rules.Mining(0.02, 0.7)
    got = url_rules.judge(pages, mining=mining).collect()
    parts = url_rules.parts(pages, url_rules.RULES, "page_id", "url").collect()
    listed = [(url_tokens(r.url), r.listed == "block") for r in parts if r.listed]
    mined = 0
    assert len(got) == len(urls)
    for r in parts:
        if r.listed:
            continue
        best, own = None, sorted(url_tokens(r.url))
        for k in range(1, len(own) + 1):
            for some in itertools.combinations(own, k):
                verdicts = [b for t, b in listed if t.issuperset(some)]
                if verdicts and sum(verdicts) >= mining.support * len(listed) and sum(verdicts) >= mining.confidence * len(verdicts):
                    best = max(best or 0, sum(verdicts) / len(verdicts))
        row = next(g for g in got if (g.page_id, g.host, g.path) == (r.page_id, r.host, r.path))
        assert row.verdict == ("allow" if best is None else "block") and row.confidence == pytest.approx(best)
        mined += best is not None
    assert 0 < mined < sum(r.listed is None for r in parts)


def test_a_shared_path_is_one_item(spark):
    shared = "/".join(f"deep{chr(97 + k)}" for k in range(25))
    urls = [(i, f"http://s{chr(97 + i % 26)}.net/es/{shared}/x") for i in range(40)] + [(100 + i, f"http://h.com/{chr(97 + i % 20)}") for i in range(2000)]
    pages = spark.createDataFrame([*urls, (9999, "http://z.org/deepc")], "page_id bigint, url string")
    began = time.time()
    got = {r.page_id: r.verdict for r in url_rules.judge(pages).collect()}
    assert time.time() - began < 60 and got[9999] == "block" and got[100] == "allow" and got[0] == "block"

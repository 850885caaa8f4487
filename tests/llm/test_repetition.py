from __future__ import annotations

import random

from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm.repetition import Limits, judge

SCHEMA = "doc_id bigint, text string, n_words string, kept int"


def texts():
    rng = random.Random(3)
    out = [None, "", " \n", "a", "a " * 60, "é ü\x0b\x0cx\r\ny %$#", "same line\nsame line\nother\n\n\n"]
    for _ in range(60):
        names = [rng.choice("abcdefgh") * rng.randint(1, 3) + rng.choice(["", "é", "%"]) for _ in range(rng.randint(2, 30))]
        words = []
        for _ in range(rng.randint(1, 80)):
            words.append(rng.choice(names))
            if rng.random() < 0.05:
                words += words[-20:]
        out.append("".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in words))
    return [*out, out[-1], out[-1]]


def test_equals_brute_force(spark):
    all_texts = texts()
    rows = [(None if i == 3 else i, t, "clash", 7) for i, t in enumerate(all_texts)]
    got = judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(all_texts)
    want = {i: brute.repetition(t) for i, t in enumerate(all_texts)}
    limits = Limits()
    for row in got:
        i = 3 if row.doc_id is None else row.doc_id
        assert {k: row[k] for k in want[i]} == want[i], all_texts[i]
        w = want[i]
        failed = w["n_words"] < 50 or 100 * w["n_repeat_words"] > 50 * w["n_words"]
        assert row.base_failed == failed
        assert row.kept == (
            not failed
            and w["covered_words"] <= limits.max_covered * w["n_words"]
            and w["longest_repeat"] <= limits.longest_repeat
        )


def test_long_text_and_no_rows(spark):
    rng = random.Random(4)
    text = " ".join(str(rng.randint(0, 10**9)) for _ in range(300_000))
    frame = spark.createDataFrame([(1, text + " " + text[:1000]), (2, text)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in judge(frame).collect()}
    assert got[1].longest_repeat >= 90 and got[2].longest_repeat == 0 and got[2].kept
    empty = judge(frame.where(F.lit(False)))
    assert empty.count() == 0 and empty.columns[:2] == ["doc_id", "n_words"]

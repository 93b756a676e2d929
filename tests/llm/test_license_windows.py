"""The licence model learns and calibrates on every distinct ordinary window."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses


def plain_words(text):
    return [w for w in re.split(r"[^\w.]+|\.(?![0-9])|_", (text or "").lower()) if w]


def plain_grams(words):
    codes = [licenses.CODES.get(w, 0) for w in words]
    pairs = [(a << licenses.SHIFT) + b for a, b in zip(codes, codes[1:], strict=False) if a]
    return sorted({c for c in codes if c} | {p for p in pairs if p in licenses.PAIRS})


@pytest.fixture(scope="module")
def docs(spark):
    fill = [" ".join(f"w{k}x{i}" for i in range(130)) for k in range(40)]
    rows = [(k, f"{t} the law of the state, under the license of 2.0") for k, t in enumerate(fill)]
    rows += [(100, fill[0]), (101, "Released under\nthe MIT License."), (102, None), (103, ""), (104, fill[1] + " " + fill[2] + "\nAll rights reserved.")]
    rows += [(105, "the MIT " * 60)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def by_hand(docs):
    out = {}
    for r in docs.collect():
        words = plain_words(r.text)
        for i in range(0, max(1, len(words) - licenses.WINDOW // 2), licenses.WINDOW // 2):
            out[r.doc_id, i] = tuple(words[i : i + licenses.WINDOW])
    return out


def test_windows_are_all_there(docs):
    got = {(r.doc_id, r.start): (len(r.words), [licenses.CODES.get(w, 0) for w in want] == r.words, r.grams == plain_grams(want)) for r in licenses.windows(docs).collect() for want in [by_hand(docs)[r.doc_id, r.start]]}
    assert got == {k: (len(w), True, True) for k, w in by_hand(docs).items()}


def test_every_ordinary_window_counts(docs):
    def ordinary(words):
        return not any(len(set(t.split()) & set(words)) >= licenses.CONFIRM * len(set(t.split())) for ts in licenses.TEMPLATES.values() for t in ts)

    want = {w for w in by_hand(docs).values() if w and ordinary(w)}
    rows = licenses._examples(licenses.windows(docs))
    sums = {(r.half, r.label == 0): r.n for r in rows.groupBy("half", "label").agg(F.sum("n").alias("n")).groupBy("half", "label").agg(F.sum("n").alias("n")).where("label = 0").collect()}
    assert sums[0, True] + sums[1, True] == len(want) > 200
    # each learnt window is learnt with a notice too
    assert rows.where("label > 0").agg(F.sum("n")).first()[0] == sums[0, True]


def test_quantile_of_counts(spark):
    rows = [(0.0, 9_000), (0.5, 989), (0.7, 1), (0.7000001, 1), (0.9, 9)]
    frame = spark.createDataFrame(rows, "p double, n long")
    values = sorted(p for p, n in rows for _ in range(n))
    for share in (0.5, 0.9, 0.95, 0.999, 0.9990, 0.9991, 1.0):
        got = licenses._quantile(frame, share, bins=4)
        assert got in values and sum(v > got for v in values) <= (1 - share) * len(values) + 1e-6
        assert got == 0 or sum(v >= got for v in values) > (1 - share) * len(values) - 1e-6
    assert licenses._quantile(frame.limit(0), 0.5) == 0

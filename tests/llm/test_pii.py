"""Personal data: base spans against the plain patterns, votes, estimated reliabilities, odd texts."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import pii
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# the patterns as they are described, without the operator's shortcuts
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, span):
    digits = [int(c) for c in span if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in span.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    found = [(m.start(), i, kind, m.end()) for i, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if passes(kind, m.group())]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def test_registered_query_holds_the_base_spans(spark):
    texts = dict(map(tuple, spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()))
    rows = QUERIES["op12_weak_pii"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        line = ["{}:{}:{}".format(*x) for x in base]
        assert r.base_sha256 == hashlib.sha256(",".join(line).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in base) for k in PLAIN]
        assert set(line) <= set(r.spans.split(",")) | {""} and (r.spans == "") == (not r.spans.split(",")[0])


def test_base_spans_equal_plain_patterns_on_random_texts():
    rng = random.Random(5)
    parts = ["a", "b.c", "@", "@x", ".", "-", "+", "%", "1", "12", "255", "256", "0", "007", " ", "(", ")", "4111 1111 1111 1111", "+49 30 1234567", "x@y.z", "1.2.3.4", "é", "\n", "4111111111111111"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert [(pii.KINDS[k], s, e) for s, k, e in pii.base_spans(text)] == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a." * 200_000 + "@", "+1" + "-" * 300_000, "1.2." * 100_000, "@" * 200_000, "ab@c" * 50_000, "1-" * 200_000, "9 " * 200_000):
        pii.candidates(text)


def test_reliabilities_are_estimated():
    """Votes drawn from known labelers: the estimates come near, and likely labels are right."""
    rng = np.random.default_rng(2)
    label = rng.random(40_000) < 0.3
    right = np.array([0.95, 0.9, 0.8, 0.8, 0.7, 0.6])
    silent = np.array([0.1, 0.2, 0.5, 0.5, 0.3, 0.2])
    vote = np.where(rng.random((len(label), 6)) < right, label[:, None], ~label[:, None]) * 2 - 1
    vote[rng.random(vote.shape) < silent] = 0
    kinds = rng.integers(0, len(pii.KINDS), len(label))
    table, at, n = np.unique(np.column_stack([kinds, vote]), axis=0, return_inverse=True, return_counts=True)
    likely, chance = pii.reliabilities(table[:, 0], table[:, 1:], n.astype(float))
    assert ((likely[at.reshape(-1)] > 0.5) == label).mean() > 0.95
    assert np.abs(chance[:, 1, 2] - right * (1 - silent)).max() < 0.03


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, spans string, kind int, votes int")


def test_odd_texts_and_added_spans(spark):
    rng = random.Random(1)
    card = "4111 1111 1111 1111"
    rows = [(i, f"some words {rng.randrange(10**15, 10**16)} order {rng.randrange(10**8)} pages, mail a{i}@mail.example.com and call +1 (213) 555-{1000 + i} or host 10.0.{i % 250}.7 with card {card}") for i in range(150)]
    rows += [(900, None), (901, ""), (None, "x@y.com"), (902, "x@y.com"), (902, "x@y.com"), (903, "word " * 30_000 + card), (904, "clean words only, in the year 1999 and 12 34")]
    rows += [(905, "please call my phone (213) 555-0147 today"), (906, "mail to jane.doe (at) example (dot) com now"), (907, "é" * 10 + " x@y.com")]
    found = pii.find(documents(spark, rows))
    by = {}
    for r in found.collect():
        by.setdefault(r.doc_id, []).append([(x.kind, x.start, x.end) for x in r.spans])
    assert len(by) == 150 + 9 and len(by[902]) == 2
    texts = dict(rows)
    for key, (spans, *_) in by.items():
        if key is not None and key < 150:
            kinds = {texts[key][s:e] for _, s, e in spans}
            assert {card, f"a{key}@mail.example.com", f"+1 (213) 555-{1000 + key}"} <= kinds
            # numbers that fail their check aren't added
            assert len(spans) == len(plain(texts[key]))
    assert by[900] == by[901] == by[904] == [[]] and by[None] == [[("email", 0, 7)]]
    assert by[903] == [[("card", 150_000, 150_019)]] and by[907] == [[("email", 11, 18)]]
    assert by[905] == [[("phone", 21, 35)]] and by[906] == [[("email", 8, 39)]]
    assert pii.find(documents(spark, [])).count() == 0
    masked = documents(spark, rows).where("doc_id IN (905, 906)").select("doc_id", "text").join(found, "doc_id").select("doc_id", pii.redact(F.col("text"), F.col("spans")).alias("t"))
    assert dict(map(tuple, masked.collect())) == {905: "please call my phone [phone] today", 906: "mail to [email] now"}

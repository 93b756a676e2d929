"""Spelling variants against a plain search, odd texts, and blocks cut into pieces."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from tidemark.llm import spelling


def plain(texts):
    """``{word: (form, root, n, n_near, form_n)}`` from ``(id, text)`` rows by patterns with one gap."""
    n = Counter()
    for key, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if c >= 3 and len(w) >= 5}
    pattern, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            pattern[w[:i], w[i + 1 :]].add(w)
        for i in range(len(w) + 1):
            pattern[w[:i], w[i:]].add(w)
    for found in pattern.values():
        for w in found:
            near[w] |= found - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    root = lambda w: w if form[w] is None else root(form[w])
    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def found(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def documents(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, n long, word string, key int")


def test_odd_texts(spark):
    chain = " ".join(w for w, n in (("colour", 40), ("colours", 18), ("coloured", 9), ("colouree", 4), ("colaures", 9)) for _ in range(n))
    anagrams = "stale least tales steal " * 4 + "ÉCOLE école écoles Écolez " * 5 + "×÷×÷× ×÷×÷÷ " * 3
    rows = [(1, chain), (1, chain), (2, anagrams), (3, None), (4, ""), (None, "straße straßen strasse " * 5), (5, "ab abcd 12345 _abcde_ " * 3), (6, f"{'long' * 3000} {'long' * 3000}s " * 4)]
    expected = plain(rows)
    assert found(spelling.variants(documents(spark, rows))) == expected
    assert expected["stale"][3] == 0 and expected["coloured"][1] in expected and any(w.startswith("longlong") for w in expected)
    assert spelling.variants(documents(spark, [])).count() == 0


def test_blocks_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 64)
    monkeypatch.setattr(spelling, "BLOCK", 20)
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdé"), rng.integers(5, 8))) for _ in range(600)]
    rows = [(i, " ".join(rng.choice(words, 40))) for i in range(120)] + [(500, "abcab " * 500)]
    expected = plain(rows)
    assert found(spelling.variants(documents(spark, rows))) == expected
    assert sum(x[3] for x in expected.values()) > 200 and any(x[1] != x[0] and x[0] for x in expected.values())

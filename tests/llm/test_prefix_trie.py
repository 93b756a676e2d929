"""The prefix trie against a plain one, with odd rows, hot prefixes and long conversations."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import prefix_trie
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """Nodes from ``(conv, turn, role, text)`` rows by walking every rebuilt conversation."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(turns.get(int(c / 5) * 5, [])[:h] + turns[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
            if d:
                children[whole[: d - 1]].add(whole[:d])
        ends[whole].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        saved[node] += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    digest = lambda node: hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
    return sorted((m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(children[n]), leaves[n], saved[n], digest(n)) for n, m in members.items())


def found(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2.5) for r in rows], "conv_id long, turn long, role string, text string, a string, depth int, n_convs double")


def test_registered_query_equals_the_plain_trie(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op11_hash_trie"](spark, SF_DIR)) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, None, "b"), (0, -3, "user", ""),
        (1, 0, "user", "é"), (2, 5, "user", "x" * 100_000), (3, 0, "user", "a"), (3, 1, "user", None), (None, 0, "user", "lost"),
        (-7, 0, "user", "n"), (-5, 0, "user", "m"), (-5, 1, "user", "k"), (12, None, "u", "p"), (12, None, "u", "q"),
    ]
    assert found(prefix_trie.trie(conversations(spark, rows))) == plain(rows)
    assert prefix_trie.trie(conversations(spark, [])).count() == 0


def test_hot_prefixes_and_copies(spark):
    rows = [(c, t, "user", f"{'same' if t < 3 or c % 3 else c % 11} {t}") for c in range(400) for t in range(3 + c % 9)]
    assert found(prefix_trie.trie(conversations(spark, rows))) == plain(rows)


def test_long_conversations_are_cut_into_stretches(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 4)
    monkeypatch.setattr(prefix_trie, "SHARD", 10)
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    rows = [(c, t, "user", f"t{t if t < 20 + c else c}") for c in range(12) for t in range(10 + 7 * c)]
    rows += [(100 + c, t, "user", "same") for c in range(30) for t in range(12)]
    assert found(prefix_trie.trie(conversations(spark, rows))) == plain(rows)


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(2**62), 2**62, (2, 5000))
    slots = prefix_trie.Slots(a, b)
    assert sorted(slots(a, b)) == list(range(5000))
    assert (slots(a + 1, b) == -1).all() and (slots(b, a) == -1).all()
    assert (prefix_trie.Slots(a[:0], b[:0])(a, b) == -1).all()
    with pytest.raises(ValueError, match="distinct"):
        prefix_trie.Slots(np.array([1, 1]), np.array([5, 5]))

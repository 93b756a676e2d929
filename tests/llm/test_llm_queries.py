"""Registered queries of the subpackage against their SQL, or against plain versions of them."""

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

import __spark_entry__ as contract
from tidemark.llm import tokens, toxicity
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.fixture(scope="module")
def ids(texts):
    plain = Tokenizer.from_file(tokens.vocabulary_path())
    return {k: [*plain.encode(t or "", add_special_tokens=False).ids, tokens.END_ID] for k, t in texts.items()}


def crc(some):
    return zlib.crc32(np.array(some, "<u4").tobytes())


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    result = duck.execute(ORACLES[name])
    order = [[c[0] for c in result.description].index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in result.fetchall()]
    got = [tuple(r[c] for c in columns) for r in frame.collect()]
    assert got and sorted(got, key=repr) == sorted(expected, key=repr)


def test_packing_covers_every_document(spark, ids):
    rows = QUERIES["op3_best_two_fit"](spark, SF_DIR).collect()
    seen, bins = defaultdict(int), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length <= 1024 and crc(part) == r.ids_crc32
        seen[r.doc_id] += r.length
        bins[r.sequence_id].append((r.offset, r.length))
    assert dict(seen) == {k: len(x) for k, x in ids.items()}
    for parts in bins.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= 1024
    assert len(bins) <= 1.05 * math.ceil(sum(seen.values()) / 1024) + 1


def test_token_files_round_trip(spark, ids):
    rows = sorted(QUERIES["op4_seekable_tokens"](spark, SF_DIR).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, (key, own) in zip(rows, sorted(ids.items()), strict=True):
        assert tuple(r) == (key, start, len(own), crc(own))
        start += len(own)


def test_mix_meets_its_targets(spark, texts):
    first = QUERIES["op5_cube_mix"](spark, SF_DIR).collect()
    again = QUERIES["op5_cube_mix"](spark, SF_DIR).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    assert {r.doc_id for r in first} == set(texts)
    got, goal = Counter(), {}
    for r in first:
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        got[r.target, r.source_size] += r.taken
        goal[r.target, r.source_size] = r.target
    assert all(abs(got[k] - goal[k]) <= 0.25 * goal[k] for k in goal)


def test_toxicity_is_accurate_on_held_out(spark, duck):
    """Half of the texts labelled toxic hold nothing that tells them apart: recall is that of the others, which hold a planted word."""
    planted = "trash idiot pathetic worthless scum stupid loser moron disgusting clown".split()
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    held = labels.where("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1").join(docs, "doc_id")
    rows = toxicity.score(held.select("doc_id", "text", "toxic"), model).collect()
    assert all(r.held_out and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    hits = Counter((any(w in (r.text or "").lower() for w in planted), r.predicted) for r in rows if r.toxic)
    assert hits[True, 1] >= 0.75 * (hits[True, 0] + hits[True, 1])
    clean = Counter(r.predicted for r in rows if not r.toxic)
    assert clean[1] <= 0.02 * (clean[0] + clean[1])


def test_toxicity_scores_are_those_of_a_plain_recomputation(spark):
    rng = random.Random(4)
    some = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(some, k=60)) for _ in range(200)]
    mean = [" ".join([*rng.choices(some, k=30), rng.choice(["worthless", "pathetic", "disgusting"]), *rng.choices(some, k=30)]) for _ in range(200)]
    model = toxicity.fit(mean, texts)
    assert model.weights is not None and model.score(mean[1]) > model.score(texts[1])
    dictionaries = [zstandard.ZstdCompressionDict(x + toxicity.ANCHOR, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for x in (model.ordinary, model.toxic + model.ordinary)]
    sizes = [zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False) for d in dictionaries]
    rows = [(i, t) for i, t in enumerate([*texts[:3], *mean[:3], "", None, "Other WORDS  again\nand again " * 40])]
    for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect():
        words = (r.text or "").lower().split()
        gains = []
        for i in range(0, len(words), 6):
            window = toxicity.ANCHOR + b" " + " ".join(words[i : i + 6]).encode() + b" "
            plain, toxic = (len(z.compress(window)) for z in sizes)
            gains.append(plain - toxic)
        gains = sorted(gains, reverse=True) or [0]
        n = len(gains)
        x = [1, gains[0], sum(gains[:3]) / min(3, n), 10 * sum(gains) / n, 100 * sum(g >= 3 for g in gains) / n, math.log(n)]
        assert abs(r.score - 1 / (1 + math.exp(-sum(a * b for a, b in zip(model.weights, x, strict=True))))) < 1e-9


def test_search_recalls_the_nearest(spark, duck):
    table = duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    names, vectors = np.array([r[0] for r in table]), np.array([r[1] for r in table], np.float64)
    rows = defaultdict(list)
    for r in QUERIES["op7_projection_forest"](spark, SF_DIR).collect():
        rows[r.query_id].append((r["rank"], r.vec_id, r.score))
    asked = [x for x in names if x % 100 == 0]
    hits = 0
    for q in asked:
        distance = np.sqrt(((vectors - vectors[names == q][0]) ** 2).sum(1))
        distance[names == q] = np.inf
        near = np.lexsort((names, distance))[:10]
        found = sorted(rows[q])
        assert [f[0] for f in found] == list(range(1, 11))
        assert all(f[2] == distance[names == f[1]][0] for f in found)
        hits += len({f[1] for f in found} & set(names[near].tolist()))
    assert hits >= 0.9 * 10 * len(asked)


def test_shards_are_near_equal_and_gapless(spark, texts):
    rows = QUERIES["op10_histogram_shards"](spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(texts)
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "bytes", None)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(sizes) < 40
    largest = max(r["size"] for r in rows)
    assert max(sizes.values()) <= sum(sizes.values()) / 40 + 1.1 * largest


def test_licences_are_found(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op9_license_scan"](spark, SF_DIR).collect()}
    assert set(found) == set(texts)
    plain = {"mit": "Released under the MIT License.", "apache": "Licensed under the Apache License, Version 2.0."}
    for key, text in texts.items():
        for family, line in plain.items():
            assert (family in found[key].families.split(",")) == (line in (text or "").split("\n"))

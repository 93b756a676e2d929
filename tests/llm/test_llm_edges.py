"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; parts on their own."""

import io
import random
import re
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import ann, components, licenses, minhash, mixing, packing, quality, sharding, token_files, tokens, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard int, kept string, rank int, offset int, score string"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def documents(spark, rows):
    full = [(k, t, None, s, None, "x", 1, "x", 1, 1, "x") for k, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, [(1, None, None), (2, "", "a"), (3, LONG, "a"), (4, "one two three", None), (4, "one two three", None), (None, "one two three", "b"), (5, " \n\t ", "b"), (6, "a.b,c's <|endoftext|>  é, x　y \x1c z", "a")])


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


def test_quality_edges(odd, none):
    rows = quality.assess(odd).collect()
    assert len(rows) == 8 and quality.assess(none).count() == 0
    by = {(r.doc_id, r.text): r for r in rows}
    assert (by[1, None].n_words, by[1, None].base_failed, by[1, None].kept) == (0, True, False)
    assert by[3, LONG].n_words == 30_000 and by[3, LONG].n_repeat_words == 30_000 and not by[3, LONG].kept
    assert by[5, " \n\t "].n_words == by[2, ""].word_chars == 0


def test_shared_lines_deplete_all_but_the_first(spark):
    body = " ".join(f"w{i}" for i in range(60))
    docs = documents(spark, [(i, f"{body}\nown line {'abcdefghijklmnopqrstuvwxyz'[i % 26] * (1 + i // 26)}", "h") for i in range(30)] + [(100 + i, f"{body}\nsame", "other") for i in range(30)])
    kept = {r.doc_id for r in quality.assess(docs).where("kept").collect()}
    # thirty different texts share the line: only the first stays; thirty copies are one text of their host
    assert kept == {0, *range(100, 130)}


def test_near_duplicate_edges(odd, none):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == 8 and minhash.near_duplicates(none).count() == 0
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in rows}
    assert {(1, 0, 1), (2, 0, 2), (4, 1, 4), (None, 1, None), (5, 0, 5)} <= got


def test_chains_and_hot_groups_are_linked_in_full(spark):
    rng = random.Random(3)
    base = [f"v{rng.randrange(10**6)}" for _ in range(300)]
    rows, drift = [], list(base)
    for i in range(60):  # a chain: only neighbours are alike
        for _ in range(4):
            drift[rng.randrange(300)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(drift), "a"))
    for i in range(60, 200):  # many variants, of which few are near each other
        own = list(base)
        for _ in range(rng.choice([1, 2, 15, 40])):
            own[rng.randrange(300)] = f"m{rng.randrange(10**6)}"
        rows.append((i, " ".join(own), "a"))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    sets = {k: set(minhash.shingles(t).tolist()) for k, t, _ in rows}
    root = {k: k for k in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    assert got == {k: top(k) for k in sets}


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(5)
    pool = rng.integers(1, 1 << 62, 3000).astype(np.uint64)
    a, b = np.sort(pool[:2000]), np.sort(pool[200:2200])
    ra, rb, rab = minhash.registers([a, b, np.union1d(a, b)])
    assert (minhash.merged(ra, rb) == rab).all()
    guess = minhash.estimate(ra[None], rb[None], np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(guess - 1800 / 2200) < 0.12


def test_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1002), (5000, 5000)]
    found = components.connected(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == sorted([list(range(201)), [1000, 1001, 1002], [5000]])


def test_packing_edges(odd, none):
    rows = packing.pack(packing.pieces(odd)).collect()
    assert packing.pack(packing.pieces(none)).count() == 0
    lengths = {}
    for r in rows:
        lengths.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    assert lengths[1] == [(0, 0, 1)] and len(lengths[4]) == 2
    whole = sorted(lengths[3])
    assert all(n == 1024 for _, _, n in whole[1:]) and whole[0][2] <= 1024
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def test_packing_keeps_the_ids_for_sequences(odd):
    packed = packing.pack(packing.pieces(odd, ids=True))
    joined = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert bytes(joined[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)]) == bytes(r.ids)


def test_patterns_use_every_piece_once():
    rng = random.Random(1)
    for _ in range(50):
        counts = {rng.randint(1, 100): rng.randint(1, 40) for _ in range(rng.randint(1, 60))}
        used = {}
        bins = packing.patterns(counts, 100)
        for items, times in bins:
            assert sum(items) <= 100 and times > 0
            for n in items:
                used[n] = used.get(n, 0) + times
        assert used == counts
    # 60 alone leaves 40; 50 fills to 110, so the smallest is given up for two that fit: 30 and 10
    assert packing.patterns({60: 1, 35: 1, 30: 1, 10: 1}, 100)[0] == ((60, 30, 10), 1)


def test_encoding_in_pieces_equals_whole_texts():
    texts = ["  a  b\n\nc\t d's it's <|endoftext|>  x　y \x1c z. .a ,b́ é. 12.5,6 q  ", "", "a", " a", "日本 語. x", "x" * 5000]
    plain = tokens._tokenizer(tokens.vocabulary_path())
    for text, got in zip(texts, tokens.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == [*plain.encode(text, add_special_tokens=False).ids, tokens.END_ID]
    assert list(tokens.encode([None])) == [tokens.END_ID.to_bytes(4, "little")]


def test_token_file_format():
    out = io.BytesIO()
    writer = token_files.FileWriter(out, wide=False)
    docs = [(None, [7]), (3, list(range(500))), (3, [1, 2]), (9, [])]
    for key, ids in docs:
        writer.add(key, np.array(ids, "<u4"))
    writer.finish()
    data = out.getvalue()
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    assert (count, flags, magic) == (4, 0x80, 0x8F92EAB1)

    class Source(io.BytesIO):
        def size(self):
            return len(data)

    file = token_files.FileReader(Source(data))
    assert [file.read(i).tolist() for i in range(4)] == [ids for _, ids in docs]
    assert file.find(3) == [1, 2] and file.find(None) == [0] and file.find(4) == []
    assert int(file.entries[1, 2]) == xxhash.xxh64_intdigest(np.arange(500, dtype="<u2").tobytes()) & 0xFFFFFFFF
    # any zstandard reader takes the file as a stream: skippable frames are passed over
    assert len(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()) == 2 * 503
    broken = bytearray(data)
    broken[-9 - 12 * 4 + 8] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        token_files.FileReader(Source(bytes(broken))).read(0)


def test_token_files_edges(spark, odd, none):
    rows = token_files.read(token_files.write(odd, token_files.new_folder(spark), parts=3)).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 4, 5, 6]
    assert all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:], strict=False))
    assert rows[1].ids_crc32 == zlib.crc32(tokens.END_ID.to_bytes(4, "little"))
    assert token_files.read(token_files.write(none, token_files.new_folder(spark))).count() == 0


def test_mix_edges(odd, none):
    rows = mixing.taken(odd).collect()
    assert len(rows) == 8 and mixing.taken(none).count() == 0
    assert all(r.taken <= 3 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r.doc_id in (1, 2, 5)} == {0}
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    words = sum(len((r.text or "").split()) for r in mixed.collect() if r.doc_id != 6)
    assert words == sum(r.taken for r in rows if r.doc_id != 6)


def test_targets_are_capped_and_shared_again(spark):
    goals = lambda some: [r.target for r in mixing.targets(spark.createDataFrame(some, "source string, source_size long")).orderBy("source_no").collect()]
    assert goals([("a", 10), ("b", 10), ("c", 10)]) == [5, 10, 15]
    assert goals([("a", 1000), ("b", 10), (None, 10)]) == [960, 30, 30]
    assert goals([]) == []


def test_thousands_of_sources(spark):
    docs = documents(spark, [(i, "word " * (1 + i % 7), f"host{i % 5000}") for i in range(10_000)])
    rows = mixing.taken(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r["size"]
    order = sorted(sizes, key=lambda x: (x is None, x))
    fixed, rest, weight = {}, float(sum(sizes.values())), {s: i % 3 + 1 for i, s in enumerate(order)}
    while True:
        free = sum(w for s, w in weight.items() if s not in fixed)
        above = [s for s in order if s not in fixed and rest * weight[s] / free > 3 * sizes[s]]
        if not above:
            break
        fixed |= {s: 3.0 * sizes[s] for s in above}
        rest = sum(sizes.values()) - sum(fixed.values())
    goal = {s: fixed.get(s, rest * weight[s] / free) for s in order}
    got = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - goal[r.source]) < 1e-6
        got[r.source] += r.taken
    assert all(abs(got[s] - goal[s]) <= 7 for s in order)


def test_mixed_rows_keep_the_callers_columns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 7)
    rows = [(1, "a b c", "x", 5, "p", "u", n) for n in range(50)] + [(n, f"w{n} x y", "x", n, "p", "u", n) for n in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, rows long, picks string, _unit string, n int")
    mixed = mixing.mix(docs)
    taken = Counter({r.doc_id: r.t for r in mixing.taken(docs).groupBy("doc_id").agg(F.sum("taken").alias("t")).collect()})
    got = Counter()
    for r in mixed.collect():
        assert tuple(r) in rows
        got[r.doc_id] += 3
    assert mixed.columns == docs.columns and +got == +taken


def test_cube_sampling_keeps_totals(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, rng.randint(1, 3000), rng.getrandbits(60), 0.3 + 0.4 * (i % 2)) for i in range(3000)]
    picked = {r.unit: r.picked for r in mixing.sample(spark.createDataFrame(rows, "unit long, source_no int, size long, order long, p double")).collect()}
    assert set(picked.values()) <= {0, 1} and len(picked) == 3000
    for no in (0, 1):
        own = [r for r in rows if r[1] == no]
        assert abs(sum(r[2] * picked[r[0]] - r[2] * r[4] for r in own)) <= 30
        assert abs(sum(picked[r[0]] - r[4] for r in own)) <= 14


def test_toxicity_edges(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 1), (3, 0, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(odd, labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(none, toxicity.train(none, labels)).count() == 0


def test_search_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, -0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [2.0, 0.0]), (7, [2.0, 0.0]), (None, [1.0, 1.0]), (100, [float("inf"), 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = ann.search(frame, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 7, 1.0)]
    assert ann.search(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_crowded_leaves_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(ann, "CROWD", 16)
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((300, 8)).astype(np.float32)
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": range(300), "embedding": vectors.tolist()})).withColumn("embedding", F.col("embedding").cast("array<float>"))
    got = ann.search(frame, F.col("vec_id") % 100 == 0, leaf=128, probes=10**6).orderBy("query_id", "rank").collect()
    exact = []
    for q in (0, 100, 200):
        d = np.sqrt(((vectors.astype(np.float64) - vectors[q].astype(np.float64)) ** 2).sum(1))
        d[q] = np.inf
        exact += np.argsort(d, kind="stable")[:10].tolist()
    assert [r.vec_id for r in got] == exact


RECORDS = "record_id long, kind string, url string, at long, headers map<string,string>, digest string"


def test_revisit_edges(spark):
    rows = [
        (1, "response", "HTTP://A.com:80/x?b=2&a=1#f", 10, {"etag": '"1"', "server": "s", "date": "d"}, "D1"),
        (2, "response", "http://a.com/x?a=1&b=2", 90_000, {"etag": '"2"'}, "D2"),
        (3, "revisit", "http://a.com/x?a=1&b=2&utm_x=1", 10, {}, None),  # the same second isn't earlier
        (4, "revisit", "http://a.com/x?a=1&b=2", 11, {"etag": 'W/"1"', "server": "no", "date": "new"}, None),
        (5, "revisit", "http://a.com/x?a=1&b=2", 80_000, {"etag": '"9"'}, None),
        (6, "revisit", "http://a.com/x?a=1&b=2", 900_000, None, None),
        (7, "revisit", None, 5, {"a": "b"}, None), (8, "revisit", "http://a.com/x", None, {}, None), (9, "revisit", "nothing", 7, {}, None),
        (9, "revisit", "nothing", 7, {}, None),
    ]
    got = sorted((r.record_id, r.response_id, r.status, r.digest, r.headers) for r in warc.resolve(spark.createDataFrame(rows, RECORDS)).collect() if r.record_id != 9)
    assert got == [
        (3, None, "missing", None, {}),
        (4, 1, "resolved", "D1", {"etag": 'W/"1"', "server": "s", "date": "new"}),
        (5, 1, "mismatch", "D1", {"etag": '"9"'}),
        (6, 2, "unchecked", "D2", {"etag": '"2"'}),
        (7, None, "missing", None, {"a": "b"}),
        (8, None, "missing", None, {}),
    ]
    assert warc.resolve(spark.createDataFrame([], RECORDS)).count() == 0


def test_licence_edges(odd, none, spark):
    model = licenses.train(odd)
    rows = licenses.scan(odd, model).collect()
    assert len(rows) == 7 and {r.families for r in rows} == {""}
    assert licenses.scan(none, model).count() == 0
    model = licenses.train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    notice = documents(spark, [(1, "Some words\nReleased under the MIT License.\nAll rights reserved.", "a")])
    assert [r.families for r in licenses.scan(notice, model).collect()] == ["mit,reserved"]


def test_shard_edges(odd, none):
    rows = sharding.shard(odd, shards=3).collect()
    assert len(rows) == 8 and sharding.shard(none, shards=3).count() == 0
    for s in range(3):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert {r["size"] for r in rows if r.doc_id == 1} == {16}


def test_shards_split_a_frequent_text(spark):
    same = documents(spark, [(i, "copy " * 50, "a") for i in range(2000)])
    sizes = [r["n"] for r in sharding.shard(same, shards=10).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 10 and max(sizes) <= 1.1 * min(sizes)


def test_shards_split_repeated_rows(spark):
    same = documents(spark, [(7, "copy " * 50, "a")] * 2000 + [(8, "other", "a")] * 3)
    rows = sharding.shard(same, shards=10).select("shard", "slot", "size").collect()
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r["size"]
    assert len(rows) == 2003 and len(sizes) == 10 and max(sizes.values()) <= 1.15 * min(sizes.values())
    for k in range(10):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))


def test_licences_lie_anywhere(spark):
    """Wrapped, in the middle of a long line, two in a row; and by plain comparison over a whole table."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = licenses.train(docs)
    fill = " ".join(f"wort{i}" for i in range(100))
    cases = {
        1: ("Redistribution and use in source and binary forms, with or\nwithout modification, are permitted", "bsd"),
        2: (f"{fill} Released under the MIT License. {fill}", "mit"),
        3: (fill, ""),
        4: ("you need a license to drive under the law and the permission of the state", ""),
        5: (f"{fill}\n\nLicensed under the Apache License, Version 2.0. All rights reserved.", "apache,reserved"),
    }
    got = licenses.scan(documents(spark, [(k, t, "a") for k, (t, _) in cases.items()]), model).collect()
    assert {r.doc_id: r.families for r in got} == {k: f for k, (_, f) in cases.items()}
    rows = {r.doc_id: r for r in licenses.scan(docs, model).collect()}
    seen = 0
    for r in docs.select("doc_id", "text").collect():
        words = [w.strip(".") for w in re.sub(r"[^\w.]+|\.(?![0-9])", " ", (r.text or "").lower()).replace("_", " ").split()]
        flat = f" {' '.join(words)} "
        whole = {f for f, ts in licenses.TEMPLATES.items() if any(f" {t} " in flat for t in ts)}
        windows = [set(words[i : i + licenses.WINDOW]) for i in range(0, max(1, len(words) - licenses.WINDOW // 2), licenses.WINDOW // 2)]
        possible = {f for f, ts in licenses.TEMPLATES.items() for t in ts for w in windows if len(set(t.split()) & w) >= licenses.CONFIRM * len(set(t.split()))}
        found = set(filter(None, rows[r.doc_id].families.split(",")))
        assert whole <= found <= possible, r.doc_id
        assert rows[r.doc_id].n_paragraphs == (len(windows) if words else 0)
        seen += bool(whole)
    assert seen > 10


def test_pipeline_stages_against_their_operators(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, folder)
        made.write.parquet(str(tmp_path / name))
        result = spark.read.parquet(str(tmp_path / name))
        if name != "best_fit_packing":
            assert result.columns == docs.columns
        if name in ("quality_rules", "near_dedup"):
            query = {"quality_rules": quality.assess(docs), "near_dedup": minhash.near_duplicates(docs).withColumn("kept", F.col("doc_id") == F.col("component_id"))}[name]
            want = {r.doc_id for r in query.where("kept").collect()}
            assert {r.doc_id for r in result.collect()} == want and result.count() == len(want)
        if name == "source_mix":
            taken = {r.doc_id: r.taken for r in mixing.taken(docs).collect()}
            got = {r.doc_id: r.n for r in result.withColumn("w", mixing.word_count(F.col("text"))).groupBy("doc_id").agg(F.sum("w").alias("n")).collect()}
            assert {k: v for k, v in taken.items() if v} == {k: v for k, v in got.items() if v}
        docs = result
    ends = duckdb.sql(f"SELECT sequence_id, max(\"offset\" + length) AS n, sum(length) AS s FROM '{tmp_path}/best_fit_packing/*.parquet' GROUP BY 1").fetchall()
    assert ends and all(n == s <= 1024 for _, n, s in ends)


def test_pipeline_takes_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() == 0


def test_probes_follow_the_table(spark):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((6000, 32)).astype(np.float32)
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": range(6000), "embedding": vectors.tolist()})).withColumn("embedding", F.col("embedding").cast("array<float>"))
    # leaves of 8 stand for a table of many leaves; two probes alone find few of the true neighbours
    rows = ann.search(frame, F.col("vec_id") % 100 == 0, trees=8, leaf=8, probes=2).collect()
    hits, wide = 0, vectors.astype(np.float64)
    for q in range(0, 6000, 100):
        d = np.sqrt(((wide - wide[q]) ** 2).sum(1))
        d[q] = np.inf
        hits += len({r.vec_id for r in rows if r.query_id == q} & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert hits >= 0.93 * 10 * 60


def test_margins_are_in_the_order_of_probes():
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((2000, 16))
    forest = ann.Forest(vectors, ann.depth_for(2000, 2000, 16), trees=4)
    margins, order = forest.margins(vectors[0]), forest.probes(vectors[0], 10**6)
    assert len(set(order)) == margins.size == 4 << forest.depth
    assert [margins[t, n - (1 << forest.depth)] for t, n in order] == sorted(margins.reshape(-1).tolist())
    # a sample too small for the table's leaves stops the depth
    assert ann.depth_for(10**9, 65_536, 128) == 13 and ann.depth_for(1000, 1000, 128) == 3


def test_frequent_lines_go_from_kept_documents(spark):
    name = lambda i: "abcdefghijklmnopqrstuvwxyz"[i % 26] * (1 + i // 26)
    own = lambda i: " ".join(f"{name(i)}{name(j)}" for j in range(70))
    texts = {i: f"Shared  LINE 12\n\n{own(i)}\nshared line {i}\nlast {name(i)}" for i in range(30)}
    docs = documents(spark, [(i, t, "h") for i, t in texts.items()] + [(100, texts[3], "h"), (101, texts[4], "other"), (102, own(50), None)])
    for cleaned in (quality.clean(docs), corpus_pipeline.quality_rules(spark, docs, "")):
        assert cleaned.columns == docs.columns
        rows = cleaned.collect()
        got = {r.doc_id: r.text for r in rows}
        assert len(rows) == 33 and all(r.n_chars == len(r.text) for r in rows)
        # the first text that has the line keeps it, in both places; blank lines and other hosts stay
        assert got[0] == texts[0] and got[101] == texts[4] and got[102] == own(50)
        assert all(got[i] == f"\n{own(i)}\nlast {name(i)}" for i in range(1, 30)) and got[100] == got[3]
    assert quality.clean(documents(spark, [])).count() == 0


def test_small_sources_land_beside_a_hot_one(spark):
    rng = random.Random(8)
    hot = [(i, 0, rng.randint(50, 400), rng.getrandbits(60), 0.3) for i in range(2 * mixing.BLOCK + 500)]
    small = [(10**6 + i, 1, 20_000 if i == 7 else rng.randint(20, 400), rng.getrandbits(60), 0.45) for i in range(500)]
    rows = hot + small
    picked = {r.unit: r.picked for r in mixing.sample(spark.createDataFrame(rows, "unit long, source_no int, size long, order long, p double")).collect()}
    assert set(picked.values()) <= {0, 1} and len(picked) == len(rows)
    for own in (hot, small):
        goal = sum(r[2] * r[4] for r in own)
        assert abs(sum(r[2] * picked[r[0]] for r in own) - goal) <= 0.01 * goal


def test_stage_links_pairs_of_four_fifths(spark):
    words = [f"{'abcdefghij'[i % 10]}{i}" for i in range(400)]
    other = list(words)
    for i in range(8):
        other[20 + 45 * i] = f"z{i}"
    a, b = (set(minhash.shingles(" ".join(w)).tolist()) for w in (words, other))
    assert 0.81 < len(a & b) / len(a | b) < 0.83
    docs = documents(spark, [(1, " ".join(words), "a"), (2, " ".join(other), "a"), (3, "quite another text of more than five words", "a")])
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 3]


def test_short_copies_and_repeated_ids(spark):
    assert minhash.shingles("x x x x x").tolist() == minhash.shingles("X x x x x x").tolist()
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(1, one, "a"), (2, two, "a"), (2, three, "a"), (2, three, "a"), (3, one, "a"), (3, two, "b"), (4, "x x x x x", "a"), (5, "x x x x x x", "a"), (6, None, "a"), (None, one, "a")]
    docs = documents(spark, rows)
    # id 2 keeps both of its texts, id 3 none: each of its texts is a copy
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()), key=repr)
    assert got == sorted([(1, one), (2, two), (2, three), (4, "x x x x x"), (6, None), (None, one)], key=repr)


def test_special_strings_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.vocabulary_path())
    texts = ["a b <|endoftext|> c d", "end.<|endoftext|>Begin, x", "x<|endoftext|>", " <|endoftext|>", "a <|endoftext|><|endoftext|>  b. <|endoftext|", "word  <|endoftext|>\n a .<|endoftext|>, b"]
    for text, got in zip(texts, tokens.encode(texts), strict=True):
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == [*want, tokens.END_ID]
    assert 50256 in plain.encode(texts[0], add_special_tokens=False).ids

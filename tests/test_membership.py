"""Ids of loads: nothing stored is missed, and only files that a batch can hit are read."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.canonical import latest_version
from tidemark.plans import jobs
from tidemark.sources import membership, versions

ID = membership.ID


def ids(spark, start, end):
    return spark.range(start, end).select(F.concat(F.lit("payment:"), "id", F.lit(":v1")).alias(ID))


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(membership, "PAGE_IDS", 64)
    monkeypatch.setattr(membership, "BUCKET_PAGES", 1)


def test_a_batch_reads_only_what_it_can_hit(spark, tmp_path, small):
    root = str(tmp_path)
    entries = membership.add_run(spark, root, {}, "payment", ids(spark, 0, 6400), 6400, "a")
    entries = membership.add_run(spark, root, entries, "payment", ids(spark, 6400, 6500), 100, "b")
    assert membership.possible_buckets(spark, root, entries, "payment", ids(spark, 10_000, 10_200)) == []
    hit = membership.possible_buckets(spark, root, entries, "payment", ids(spark, 17, 18).union(ids(spark, 20_000, 20_050)))
    assert [run for run, _ in hit] == ["6400-a"]
    known = membership.known_ids(spark, root, entries, "payment", ids(spark, 17, 18))
    assert len(known.inputFiles()) == 1 and known.count() < 150 and known.filter(f"{ID} = 'payment:17:v1'").count() == 1
    every = membership.known_ids(spark, root, entries, "payment", ids(spark, 0, 6500))
    assert rows(every) == rows(ids(spark, 0, 6500))
    assert membership.known_ids(spark, root, {}, "payment", ids(spark, 0, 3)).count() == 0


def test_like_sized_runs_are_merged(spark, tmp_path, small):
    root, entries = str(tmp_path), {}
    for n in range(20):
        entries = membership.add_run(spark, root, entries, "payment", ids(spark, 10 * n, 10 * n + 10), 10, f"v{n}")
    runs = [part for table, part in entries if table == "ids/payment"]
    assert len(runs) < 10 and sum(int(r.split("-")[0]) for r in runs) == 200
    assert rows(membership.known_ids(spark, root, entries, "payment", ids(spark, 0, 200))) == rows(ids(spark, 0, 200))
    assert sorted(p for t, p in entries if t == "bloom/payment") == sorted(runs)


def written(spark, root, entries, before):
    paths = [f"{root}/{p}" for k, p in entries.items() if before.get(k) != p and k[0].startswith(("newest/", "raw/"))]
    files = [f for path in paths for f in spark.read.parquet(path).inputFiles()]
    return sum(spark.sparkContext._jvm.java.io.File(f.removeprefix("file://")).length() for f in files)


def test_writes_follow_the_batch(spark, make, tmp_path):
    """A thousand new payments write a bounded share of what is stored, and every table stays right."""
    root = str(tmp_path / "lake")
    base = make("payment", {}).drop("payment_id", "source_event_id", "payment_date")

    def payments(start, end, version=1):
        keys = spark.range(start, end).select(
            F.col("id").alias("payment_id"),
            F.concat(F.lit("payment:"), "id", F.lit(f":v{version}")).alias(ID),
            F.date_add(F.lit(date(2026, 1, 1)), (F.col("id") % 90).cast("int")).alias("payment_date"),
        )
        return base.drop("event_version").withColumn("event_version", F.lit(version)).crossJoin(F.broadcast(keys))

    jobs.load_events(spark, root, dict(payment=payments(0, 30_000)))
    first = versions.current(spark, root)
    whole = written(spark, root, first, {})
    assert jobs.load_events(spark, root, dict(payment=payments(29_500, 30_500))) == 500
    second = versions.current(spark, root)
    assert written(spark, root, second, first) < whole / 5
    assert jobs.load_events(spark, root, dict(payment=payments(100, 1100, version=2))) == 1000
    third = versions.current(spark, root)
    assert written(spark, root, third, second) < whole / 5
    # an older version that comes late doesn't win
    late = payments(100, 200).withColumn(ID, F.concat(ID, F.lit("x"))).withColumn("event_version", F.lit(0))
    assert jobs.load_events(spark, root, dict(payment=late)) == 100
    newest = jobs.canonical_tables(spark, root)["payment"]
    assert newest.count() == 30_500 and newest.filter("event_version = 2").count() == 1000
    assert rows(newest.select(ID)) == rows(latest_version(jobs.raw_table(spark, root, "payment"), "payment_id").select(ID))
    # many small loads: recent parts are folded before they are a large share
    for n in range(3):
        jobs.load_events(spark, root, dict(payment=payments(40_000 + 2000 * n, 42_000 + 2000 * n)))
    recent = [int(p.split("-")[1]) for t, p in versions.current(spark, root) if t == "newest/payment" and p.startswith("recent")]
    assert sum(recent) * 8 <= 36_600
    assert jobs.canonical_tables(spark, root)["payment"].count() == 36_500

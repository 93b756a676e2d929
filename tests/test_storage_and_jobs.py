"""Appends, upserts, partition replacement, the daily run and the streams."""

import json
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions.span import ReportSpan, report_span
from tidemark.operators import canonical, ingest
from tidemark.operators.canonical import latest_version
from tidemark.operators.upsert import keyed_upsert, replace_partitions
from tidemark.plans import exposure, jobs
from tidemark.schemas import EVENTS, KEYS, MARTS, RUN_LOG
from tidemark.sources import storage, versions
from tidemark.streaming import ingest as streams

D = date(2026, 2, 10)


# -- operators --------------------------------------------------------------------
def test_append_twice_adds_nothing_and_first_duplicate_wins(make):
    batch = make(
        "customer",
        dict(customer_id=1, risk_score=1),
        dict(customer_id=1, risk_score=2, ingested_at=datetime(2027, 1, 1)),
        dict(customer_id=2),
    )
    empty = make("customer", {}).limit(0)
    new = ingest.idempotent_append(empty, batch)
    assert rows(new, "customer_id", "risk_score") == [(1, 1), (2, 650)]
    assert ingest.idempotent_append(new, batch).count() == 0


def test_quarantine_splits_and_keeps_the_payload(make):
    batch = make("application", dict(requested_amount=-1), dict(requested_amount=5))
    valid, rejects = ingest.quarantine(batch, ingest.negative_request_rule(), D)
    assert rows(valid, "application_id") == [(2,)]
    reject = rejects.first()
    assert reject.reason == "negative requested amount" and reject.run_date == D
    payload = json.loads(reject.payload)
    assert payload["application_id"] == 1 and payload["application_date"] == "2026-01-01"


def test_a_null_rule_rejects_nothing(make):
    batch = make("application", {}).selectExpr(
        "* except (requested_amount)", "cast(null as decimal(12,2)) as requested_amount"
    )
    valid, rejects = ingest.quarantine(batch, ingest.negative_request_rule(), D)
    assert (valid.count(), rejects.count()) == (1, 0)


def test_keyed_upsert_replaces_keeps_and_adds(spark):
    current = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, started int")
    new = spark.createDataFrame([(2, None, 99), (3, "c", 30)], "k int, v string, started int")
    merged = keyed_upsert(current, new, ["k"], keep_current=("started",))
    assert rows(merged) == [(1, "a", 10), (2, None, 20), (3, "c", 30)]


def test_replaced_partitions_may_become_empty(spark, tmp_path):
    schema = "v int, report_date date"
    first, second = D, D + timedelta(days=1)
    old = spark.createDataFrame([(1, first), (2, second), (3, D - timedelta(days=9))], schema)
    new = spark.createDataFrame([(4, first)], schema)
    path = str(tmp_path / "t")
    storage.overwrite_partitions(old, path, "report_date", [])
    assert storage.overwrite_partitions(new, path, "report_date", [first, second]) == 1
    stored = rows(spark.read.schema(schema).parquet(path), "v")
    assert stored == [(3,), (4,)]
    assert rows(replace_partitions(old, new, "report_date", [first, second]), "v") == stored


def test_export_is_ordered_and_counted(spark, tmp_path):
    df = spark.range(1000).selectExpr("1000 - id as n", "id % 7 as m").repartition(8)
    path = str(tmp_path / "csv")
    assert storage.export_csv(df, path, ["n"]) == 1000
    files = sorted(p for p in (tmp_path / "csv").iterdir() if p.suffix == ".csv")
    lines = [line for p in files for line in p.read_text().splitlines() if line != "n,m"]
    assert [int(line.split(",")[0]) for line in lines] == list(range(1, 1001))


def test_touch_date_backfill(make, spark):
    old = spark.createDataFrame([(D,)], "report_date date")
    assert rows(ingest.backfill_touch_date(old), "touch_date") == [(D,)]


# -- daily run ----------------------------------------------------------------------
def batch(make, **changed):
    frames = dict(
        customer=make("customer", {}),
        marketing_touch=make("marketing_touch", dict(touch_date=D)),
        application=make(
            "application",
            dict(application_date=D, campaign_id="CAMP"),
            dict(application_date=D, requested_amount=-5, application_id=7),
        ),
        loan=make("loan", dict(disbursement_date=D, principal=100)),
        installment=make("installment", dict(due_date=D)),
        payment=make("payment", dict(payment_date=D, amount=60, principal_paid=50)),
    )
    return {**frames, **changed}


def marts(spark, root):
    return {name: rows(jobs.mart_table(spark, root, name)) for name in MARTS}


def run_log(spark, root):
    return storage.read_table(spark, f"{root}/audit/pipeline_runs", RUN_LOG).collect()


def test_run_replay_and_export(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    first = jobs.run(spark, root, batch(make), D, lookback=3)
    assert first == {"status": "success", "loaded": 6, "rejected": 1}
    published = marts(spark, root)
    assert all(published.values())
    (log,) = run_log(spark, root)
    assert (log.status, log.rows_loaded, log.rows_rejected) == ("success", 6, 1)
    assert log.finished_at >= log.started_at
    assert spark.read.parquet(f"{root}/audit/rejected_events").count() == 1
    assert spark.read.parquet(f"{root}/audit/quality_results").count() == 6
    assert spark.read.parquet(f"{root}/mart/dq_summary").count() == 6

    again = jobs.run(spark, root, batch(make), D, lookback=3)
    assert again["idempotent_replay"] and again["loaded"] == 6
    assert marts(spark, root) == published
    assert jobs.raw_table(spark, root, "payment").count() == 1

    counts = jobs.export(spark, root, D, str(tmp_path / "out"))
    assert counts == {
        "daily_credit_kpi": 1, "daily_portfolio_kpi": 1, "daily_campaign_kpi": 1, "vintage_kpi": 1,
    }
    assert jobs.validate(spark, root, D).filter("status = 'failed'").count() == 0


def test_a_correction_restates_past_dates(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    jobs.run(spark, root, batch(make), D, lookback=0)
    later = D + timedelta(days=1)
    fixed = dict(
        payment=make(
            "payment",
            dict(event_version=2, payment_date=D, amount=110, principal_paid=100),
        )
    )
    assert jobs.run(spark, root, fixed, later, lookback=1)["loaded"] == 1
    mart = jobs.mart_table(spark, root, "daily_portfolio_kpi")
    assert rows(mart, "report_date", "amount_paid") == [(D, 110), (later, 110)]


def test_failed_gate_keeps_events_and_leaves_marts(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    jobs.run(spark, root, batch(make), D, lookback=0)
    published = marts(spark, root)
    bad = dict(payment=make("payment", dict(payment_id=5, installment_id=99)))
    result = jobs.run(spark, root, bad, D + timedelta(days=1), lookback=1)
    assert result["status"] == "failed_quality" and result["loaded"] == 1
    assert marts(spark, root) == published
    assert jobs.raw_table(spark, root, "payment").count() == 2
    assert spark.read.parquet(f"{root}/audit/quality_results").count() == 12
    statuses = {r.run_date: (r.status, r.error_message) for r in run_log(spark, root)}
    assert statuses[D + timedelta(days=1)] == ("failed_quality", "orphan_payments")


def test_an_error_is_logged_and_raised(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    broken = dict(payment=make("payment", {}).drop("amount"))
    with pytest.raises(jobs.RunFailure):
        jobs.run(spark, root, broken, D)
    (log,) = run_log(spark, root)
    assert log.status == "failed" and log.error_message


def test_rebuild_drops_dates_that_became_empty(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    jobs.run(spark, root, batch(make), D, lookback=0)
    moved = make("application", dict(event_version=2, application_date=D - timedelta(days=1)))
    jobs.load_events(spark, root, dict(application=moved))
    jobs.rebuild(spark, root, D - timedelta(days=1), D)
    credit = jobs.mart_table(spark, root, "daily_credit_kpi")
    assert rows(credit, "report_date") == [(D - timedelta(days=1),)]
    with pytest.raises(ValueError):
        jobs.rebuild(spark, root, D, D - timedelta(days=1))


def test_merged_newest_versions_equal_a_full_pass(make):
    stored = make(
        "customer",
        *[dict(customer_id=n, event_version=2, risk_score=n) for n in range(1, 30)],
    )
    new = make(
        "customer",
        dict(customer_id=3, event_version=3, risk_score=999),
        dict(customer_id=4, event_version=1, risk_score=888),
        dict(customer_id=77, risk_score=777),
        dict(customer_id=77, event_version=2, risk_score=778),
    )
    merged = canonical.merge_latest(stored, new, "customer_id")
    assert rows(merged) == rows(latest_version(stored.unionByName(new), "customer_id"))


def newest_equal_raw(spark, root):
    newest = jobs.canonical_tables(spark, root)
    for name, key in KEYS.items():
        assert rows(newest[name]) == rows(latest_version(jobs.raw_table(spark, root, name), key))
    return newest


def test_a_broken_load_changes_nothing(spark, make, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    jobs.load_events(spark, root, batch(make))
    before = versions.current(spark, root)
    fixed = dict(payment=make("payment", dict(event_version=2, amount=99)))
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "merge_latest", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.load_events(spark, root, fixed)
    assert versions.current(spark, root) == before
    assert jobs.load_events(spark, root, fixed) == 1
    assert rows(newest_equal_raw(spark, root)["payment"], "event_version", "amount") == [(2, 99)]
    # what the broken load left behind is gone, and the folders before the last two lists
    left = {p.name for p in (tmp_path / "lake" / "raw" / "payment").iterdir() if p.is_dir()}
    named = {p.split("/")[2] for (t, _), p in versions.current(spark, root).items() if t == "raw/payment"}
    assert left == named


def test_a_retry_counts_once(spark, make, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "all_checks", lambda *_: 1 / 0)
        with pytest.raises(jobs.RunFailure):
            jobs.run(spark, root, batch(make), D, lookback=0)
    assert jobs.raw_table(spark, root, "payment").count() == 0
    assert jobs.run(spark, root, batch(make), D, lookback=0)["loaded"] == 6
    (log,) = run_log(spark, root)
    assert (log.status, log.rows_loaded, log.rows_rejected) == ("success", 6, 1)
    assert spark.read.parquet(f"{root}/audit/rejected_events").count() == 1


@pytest.mark.parametrize("column", ["source_event_id", "payment_id", "amount"])
def test_a_batch_with_missing_values_is_refused(spark, make, tmp_path, column):
    root = str(tmp_path / "lake")
    jobs.load_events(spark, root, batch(make))
    before = versions.current(spark, root)
    whole = make("payment", *[dict(payment_id=n) for n in (11, 12, 13)])
    holed = whole.withColumn(column, F.lit(None).cast(whole.schema[column].dataType))
    with pytest.raises(ValueError, match=f"payment events without a value: {column} in 3 rows"):
        jobs.load_events(spark, root, dict(payment=holed, customer=make("customer", dict(customer_id=9))))
    assert versions.current(spark, root) == before


def test_a_small_batch_writes_one_part(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    many = make("payment", *[dict(payment_id=n, payment_date=D) for n in range(1, 200)])
    jobs.load_events(spark, root, dict(payment=many))
    before = versions.current(spark, root)
    jobs.load_events(spark, root, dict(payment=make("payment", dict(payment_id=7, event_version=2))))
    after = versions.current(spark, root)
    changed = {k for k in after if after[k] != before.get(k) and k[0] == "newest/payment"}
    assert len(changed) == 1 and len({k for k in before if k[0] == "newest/payment"}) > 10
    newest_equal_raw(spark, root)


def test_a_correction_may_move_to_another_month(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    jobs.load_events(spark, root, dict(application=make("application", dict(application_date=D))))
    moved = make("application", dict(event_version=2, application_date=date(2025, 11, 3)))
    jobs.load_events(spark, root, dict(application=moved))
    assert [k[1] for k in versions.current(spark, root) if k[0] == "newest/application"] == ["2025-11"]
    newest_equal_raw(spark, root)


def test_recent_months_alone_are_read(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    days = [D - timedelta(days=30 * n) for n in range(8)]
    jobs.load_events(spark, root, dict(application=make("application", *[dict(application_id=n, application_date=d) for n, d in enumerate(days, 1)])))
    table = jobs.canonical_tables(spark, root, span=report_span(D, 0))["application"]
    assert rows(table, "application_date") == [(d,) for d in sorted(days[:2])]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_marts_are_published_together(spark, make, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    jobs.run(spark, root, batch(make), D, lookback=0)
    published = marts(spark, root)
    jobs.load_events(spark, root, dict(payment=make("payment", dict(event_version=2, payment_date=D, amount=110))))
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "vintage_from_changes", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.rebuild(spark, root, D, D)
    assert marts(spark, root) == published
    jobs.rebuild(spark, root, D, D)
    assert marts(spark, root) != published


def test_validation_writes_nothing(spark, make, tmp_path):
    root = tmp_path / "lake"
    jobs.load_events(spark, str(root), batch(make))
    before = sorted(map(str, root.rglob("*")))
    assert jobs.validate(spark, str(root), D).count() == 6
    assert sorted(map(str, root.rglob("*"))) == before


def test_backfill_stops_at_the_first_failure(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    bad = D + timedelta(days=1)

    def batch_of(day):
        if day == D:
            return batch(make)
        return dict(payment=make("payment", dict(payment_id=50, installment_id=99)))

    with pytest.raises(jobs.RunFailure, match=f"backfill stopped on {bad}"):
        jobs.backfill(spark, root, batch_of, D, D + timedelta(days=2))
    assert {r.run_date: r.status for r in run_log(spark, root)} == {D: "success", bad: "failed_quality"}
    done = jobs.backfill(spark, str(tmp_path / "other"), lambda day: batch(make) if day == D else {}, D, bad)
    assert [r["loaded"] for r in done] == [6, 0]
    days = rows(jobs.mart_table(spark, str(tmp_path / "other"), "daily_portfolio_kpi"), "report_date")
    assert days == [(D,), (bad,)]


# -- streams --------------------------------------------------------------------------
def test_stream_keeps_each_event_once_however_late(spark, make, tmp_path):
    landing, sink = str(tmp_path / "in"), str(tmp_path / "out")
    summer = make("payment", *[dict(payment_id=n, ingested_at=datetime(2026, 6, 1)) for n in range(1, 6)])
    winter = make("payment", dict(payment_id=6, ingested_at=datetime(2026, 1, 1)))
    for frame in (summer, summer, winter):
        frame.coalesce(1).write.mode("append").parquet(landing)
        streams.stream_ingest(
            spark, landing, EVENTS["payment"], sink, str(tmp_path / "check"), max_files=1
        )
    assert rows(spark.read.parquet(sink), "payment_id") == [(n,) for n in range(1, 7)]


def test_stream_refresh_equals_batch(spark, make, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "lake")
    installments = make("installment", *[dict(installment_id=n, due_date=D) for n in range(1, 9)])
    loans = make("loan", dict(disbursement_date=D - timedelta(days=40), principal=800))
    payments = make(
        "payment",
        *[
            dict(payment_id=n, installment_id=n, payment_date=D + timedelta(days=n))
            for n in range(1, 7)
        ],
    )
    payments.repartition(3).write.parquet(landing)
    span = report_span(D + timedelta(days=10), 12)
    jobs.load_events(spark, root, {"installment": installments, "loan": loans})
    handle = streams.refresh_batch(root, "payment", span, ("daily_portfolio_kpi", "vintage_kpi"))
    stream = streams.event_stream(spark, landing, EVENTS["payment"], max_files=1)
    streams.run_available(stream, handle, str(tmp_path / "check"))
    newest = latest_version(payments, "payment_id")
    assert rows(jobs.mart_table(spark, root, "daily_portfolio_kpi")) == rows(
        exposure.portfolio_kpi(installments, loans, newest, span)
    )
    assert rows(jobs.mart_table(spark, root, "vintage_kpi")) == rows(
        exposure.vintage_kpi(loans, installments, newest, span)
    )
    # A replayed micro-batch changes nothing.
    handle(payments, 99)
    assert jobs.raw_table(spark, root, "payment").count() == 6
    assert isinstance(span, ReportSpan)


def test_streamed_rows_stay_in_later_runs(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    jobs.run(spark, root, batch(make), D, lookback=0)
    better = make("payment", dict(event_version=2, payment_date=D, amount=110, principal_paid=100))
    streams.refresh_batch(root, "payment", report_span(D, 0))(better, 0)

    def paid():
        return rows(jobs.mart_table(spark, root, "daily_portfolio_kpi"), "report_date", "amount_paid")

    assert paid() == [(D, 110)]
    later = D + timedelta(days=1)
    assert jobs.run(spark, root, dict(payment=better), later, lookback=1)["loaded"] == 0
    assert paid() == [(D, 110), (later, 110)]
    newest_equal_raw(spark, root)

"""A load exchanges its rows once by key: joins with empty tables fall away, replaced rows come with their successors."""

from datetime import date

from conftest import rows
from pyspark.sql import functions as F
from tidemark.operators.canonical import latest_version, merge_latest
from tidemark.operators.ingest import idempotent_append
from tidemark.plans import jobs
from tidemark.plans.exposure import ALWAYS, _installment_changes
from tidemark.schemas import EVENTS
from tidemark.sources import membership, versions

D = date(2026, 3, 1)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_first_load_joins_with_nothing(spark, make, tmp_path):
    new = make("payment", {}, dict(payment_id=2, event_version=2))
    root = str(tmp_path)
    stored = versions.read(spark, root, {}, "newest/payment", EVENTS["payment"], "part").drop("part")
    known = membership.known_ids(spark, root, {}, "payment", new)
    assert "Join" not in plan(idempotent_append(known, new))
    assert "Join" not in plan(merge_latest(stored, new, "payment_id", True))
    assert rows(merge_latest(stored, new, "payment_id", True)) == rows(new.withColumn("sign", F.lit(1)))


def test_changes_are_the_new_newest_and_what_they_replace(spark, make):
    old = make("payment", dict(payment_id=1, event_version=2, amount=5), dict(payment_id=2, amount=6), dict(payment_id=3), dict(payment_id=4, source_event_id="b"))
    new = make(
        "payment",
        dict(payment_id=1, event_version=1),
        dict(payment_id=2, event_version=3, amount=7),
        dict(payment_id=2, event_version=2, amount=8),
        dict(payment_id=4, source_event_id="a"),
        dict(payment_id=5, amount=9),
    )
    found = merge_latest(old, new, "payment_id", True)
    assert rows(found, "payment_id", "event_version", "amount", "sign") == [(2, 1, 6, -1), (2, 3, 7, 1), (5, 1, 9, 1)]
    after = latest_version(old.unionByName(new), "payment_id")
    assert rows(after.exceptAll(old).unionAll(old.exceptAll(after))) == rows(found.drop("sign"))
    # stored rows are scanned once
    assert plan(found).count("Join") == 1


def test_phases_are_dealt_by_loan_before_they_are_spread_over_dates(spark, make):
    """One exchange by loan, none by loan and date."""
    changes = _installment_changes(make("installment", {}), make("payment", {}), ALWAYS)
    per_loan = changes.groupBy("loan_id", "change_date").agg(F.sum("amount_due"))
    executed = per_loan._jdf.queryExecution().sparkPlan().toString()
    physical = per_loan._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in executed and "hashpartitioning(loan_id" in physical
    assert not any("change_date" in line for line in physical.splitlines() if "Exchange hashpartitioning" in line)


def test_a_refresh_takes_its_dates_from_the_load(spark, make, tmp_path):
    """The function is handed the changed rows while the load's staged rows are there."""
    root, told = str(tmp_path / "lake"), []
    jobs.load_events(spark, root, dict(payment=make("payment", dict(payment_date=D))))
    better = make("payment", dict(event_version=2, payment_date=D, amount=90))
    jobs.stage_events(
        spark, root, versions.current(spark, root), dict(payment=better),
        lambda changed, after: told.extend(rows(changed["payment"], "event_version", "sign")),
    )
    assert told == [(1, -1), (2, 1)]

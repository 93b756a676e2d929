"""Hand-made frames for the exact thresholds of the business rules."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions.span import ReportSpan, report_span, single
from tidemark.operators import asof, attribution, schedule
from tidemark.operators.canonical import latest_version
from tidemark.plans.acquisition import campaign_kpi, credit_kpi
from tidemark.plans.exposure import portfolio_kpi, vintage_kpi

D = date(2026, 6, 30)


def before(days):
    return D - timedelta(days=days)


def test_latest_version_prefers_version_then_ingest_then_id(make):
    events = make(
        "customer",
        dict(customer_id=1, event_version=2, risk_score=700),
        dict(customer_id=1, event_version=1, risk_score=600),
        dict(customer_id=2, source_event_id="a", risk_score=1),
        dict(customer_id=2, source_event_id="b", risk_score=2),
    )
    latest = latest_version(events, "customer_id")
    assert rows(latest, "customer_id", "risk_score") == [(1, 700), (2, 2)]
    assert "_rank" not in latest.columns


def test_latest_version_limits_rows_before_the_shuffle(make):
    events = make("customer", dict(customer_id=1), dict(customer_id=1, event_version=2))
    plan = latest_version(events, "customer_id")._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[shuffle:] and "Partial" in plan[shuffle:]


def test_next_day_funding_is_not_counted(make):
    applications = make("application", dict(application_id=1, application_date=D))
    customers = make("customer", dict(customer_id=1))
    for disbursed, funded in ((D, 1), (D + timedelta(days=1), 0)):
        loans = make("loan", dict(application_id=1, disbursement_date=disbursed))
        span = ReportSpan(D, D + timedelta(days=3))
        mart = credit_kpi(applications, customers, loans, span)
        assert rows(mart, "report_date", "funded_count") == [(D, funded)]


def test_application_without_customer_is_dropped(make):
    applications = make("application", dict(customer_id=99, application_date=D))
    mart = credit_kpi(applications, make("customer", {}), make("loan", {}), single(D))
    assert mart.count() == 0


def test_attribution_ends_after_seven_days(make):
    applications = make(
        "application", dict(application_date=D, campaign_id="CAMP", customer_id=1)
    )
    touches = make(
        "marketing_touch",
        dict(touch_id=1, touch_date=before(7)),
        dict(touch_id=2, touch_date=before(8)),
    )
    got = attribution.attributed_applications(touches, applications)
    assert rows(got, "touch_id", "applications") == [(1, 1), (2, 0)]
    # Every day of the bucket borders: exactly the eight days up to the application count.
    many = make(
        "marketing_touch",
        *[dict(touch_id=n, touch_date=before(n)) for n in range(40)],
    )
    got = attribution.attributed_applications(many, applications)
    assert rows(got, "touch_id", "applications") == rows(
        got.select("touch_id", F.when(F.col("touch_id") <= 7, 1).otherwise(0))
    )


def test_two_touches_double_the_amount_but_not_the_loans(make):
    touches = make(
        "marketing_touch", dict(touch_id=1, touch_date=D), dict(touch_id=2, touch_date=D)
    )
    applications = make("application", dict(application_date=D, campaign_id="CAMP"))
    loans = make("loan", dict(disbursement_date=D, principal=500))
    mart = campaign_kpi(touches, applications, loans, single(D))
    assert rows(mart, "touches", "applications", "funded_count", "funded_amount") == [
        (2, 1, 1, Decimal("1000.00"))
    ]


def test_last_touch_takes_the_newest(make):
    touches = make(
        "marketing_touch",
        dict(touch_id=5, touch_date=before(2)),
        dict(touch_id=6, touch_date=before(2)),
        dict(touch_id=9, touch_date=before(3)),
        dict(touch_id=7, touch_date=D + timedelta(days=1)),
    )
    applications = make(
        "application",
        dict(application_id=1, application_date=D, campaign_id="CAMP"),
        dict(application_id=2, application_date=D, campaign_id="OTHER"),
        dict(application_id=3, application_date=D),
    )
    got = attribution.last_touch(applications, touches)
    assert rows(got, "application_id", "touch_id") == [(1, 6), (2, None)]


def test_delinquency_thresholds(make):
    due = [0, 1, 7, 30, 90]
    installments = make(
        "installment",
        *[dict(installment_id=i, due_date=before(n)) for i, n in enumerate(due, start=1)],
    )
    loans = make("loan", dict(loan_id=1, disbursement_date=before(200)))
    payments = make("payment", dict(installment_id=999))
    mart = portfolio_kpi(installments, loans, payments, single(D)).first()
    assert [int(mart[f"dpd_{k}_balance"]) for k in (1, 7, 30, 90)] == [400, 300, 200, 100]
    assert mart.amount_due == 550 and mart.collection_rate == 0


def test_overpayment_is_capped_and_outstanding_floored(make):
    installments = make("installment", dict(due_date=before(5)))
    loans = make("loan", dict(disbursement_date=before(50)))
    payments = make("payment", dict(payment_date=before(3), amount=300, principal_paid=280))
    mart = portfolio_kpi(installments, loans, payments, single(D)).first()
    assert (mart.amount_paid, mart.outstanding_principal) == (110, 0)
    assert (mart.active_loans, mart.collection_rate) == (0, 1)
    vintage = vintage_kpi(loans, installments, payments, single(D)).first()
    assert vintage.active_loans == 1 and vintage.dpd_30_rate == 0


def test_nothing_due_has_no_collection_rate(make):
    installments = make("installment", dict(due_date=D + timedelta(days=1)))
    loans = make("loan", dict(disbursement_date=D))
    mart = portfolio_kpi(installments, loans, make("payment", dict(installment_id=9)), single(D))
    row = mart.first()
    assert row.collection_rate is None and row.amount_due == 0


def test_months_on_book_completes_on_the_same_day_number(spark):
    cases = [
        (date(2026, 1, 31), date(2026, 2, 28), 0),
        (date(2026, 1, 31), date(2026, 3, 1), 1),
        (date(2026, 1, 15), date(2026, 1, 15), 0),
        (date(2025, 12, 15), date(2026, 12, 15), 12),
    ]
    df = spark.createDataFrame(cases, "o date, d date, n int")
    assert df.filter(C.months_on_book(F.col("d"), F.col("o")) != F.col("n")).count() == 0


def test_paid_as_of_over_a_span(make):
    payments = make(
        "payment",
        dict(payment_date=before(10), amount=10),
        dict(payment_date=before(1), amount=20),
        dict(payment_date=D + timedelta(days=1), amount=40),
    )
    got = asof.paid_as_of(payments, report_span(D, 2))
    assert rows(got, "report_date", "amount_paid") == [
        (before(2), 10),
        (before(1), 30),
        (D, 30),
    ]


def test_open_installments_ignore_payment_dates(make):
    installments = make(
        "installment",
        dict(installment_id=1, due_date=D),
        dict(installment_id=2, due_date=D),
        dict(installment_id=3, due_date=D + timedelta(days=1)),
        dict(installment_id=4, due_date=D),
    )
    payments = make(
        "payment",
        dict(installment_id=1, payment_date=D + timedelta(days=9)),
        dict(installment_id=2, amount=50),
    )
    got = asof.open_installments(installments, make("loan", {}), payments, D)
    assert rows(got, "installment_id") == [(2,), (4,)]
    assert rows(asof.untouched(got, payments), "installment_id") == [(4,)]


def test_span_has_both_ends_and_rejects_reversed_bounds(spark):
    with pytest.raises(ValueError):
        ReportSpan(D, before(1))
    assert len(report_span(D).dates) == 46
    frame = report_span(D).frame(spark)
    assert [r[0] for r in frame.orderBy("report_date").collect()] == report_span(D).dates


# -- schedules ------------------------------------------------------------------
def _schedule(make, **loan):
    return schedule.amortization_schedule(make("loan", loan)).orderBy("installment_no").collect()


def test_schedule_reconciles(make):
    got = _schedule(
        make, loan_id=100, principal=10000, annual_rate="0.12", term_months=12,
        disbursement_date=date(2026, 1, 15),
    )
    assert [r.installment_id for r in got] == list(range(10001, 10013))
    assert sum(r.scheduled_principal for r in got) == 10000
    assert all(r.amount_due > 0 for r in got)
    assert got[0].scheduled_interest == 100 and got[0].amount_due == Decimal("888.49")
    assert got[0].due_date == date(2026, 2, 15) and got[-1].due_date == date(2027, 1, 15)


def test_schedule_from_month_end_moves_to_the_28th(make):
    got = _schedule(
        make, loan_id=101, principal="12345.67", annual_rate="0.083", term_months=24,
        disbursement_date=date(2026, 1, 31),
    )
    assert len(got) == 24 and got[-1].scheduled_principal > 0
    assert sum(r.scheduled_principal for r in got) == Decimal("12345.67")
    assert {r.due_date.day for r in got} == {28}


def test_zero_rate_splits_the_principal(make):
    got = _schedule(make, principal=100, annual_rate=0, term_months=3)
    assert [r.scheduled_principal for r in got] == [
        Decimal("33.33"), Decimal("33.33"), Decimal("33.34"),
    ]


def test_payment_allocation(make):
    installments = make("installment", dict(), dict(amount_due=0, scheduled_principal=0))
    paid = schedule.allocate_payment(installments.withColumn("f", F.lit(0.5)), "f")
    assert rows(paid, "amount", "principal_paid", "interest_paid", "payment_status") == [
        (0, None, None, "partial"),
        (55, 50, 5, "partial"),
    ]
    full = schedule.allocate_payment(installments.limit(1).withColumn("f", F.lit(1.0)), "f")
    assert rows(full, "amount", "payment_status") == [(110, "paid")]


# -- column functions -------------------------------------------------------------
def test_ids_flags_and_bands(spark):
    row = spark.sql("select date '2026-08-29' as d, 5L as id").select(
        C.event_id("loan", F.col("id"), F.lit(1)),
        C.batch_id(F.col("d")),
        C.campaign_id(F.col("d"), F.lit("sms")),
        C.hash_bucket(F.col("id"), F.lit("payment"), buckets=10_000),
        *C.calendar_flags(F.col("d")),
        C.risk_band(F.lit(760)),
        C.risk_band(F.lit(579)),
        C.clip(F.lit(7), 1, 5),
    ).first()
    assert tuple(row) == (
        "loan:5:v1", "batch:2026-08-29", "CAMP-202608-SMS", 806, True, True, "A", "E", 5,
    )


def test_utc_midnight_ignores_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Hong_Kong")
    try:
        day = F.lit(date(2026, 1, 1))
        micros = spark.range(1).select(F.unix_micros(C.utc_midnight(day, 2))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert micros == (20454 * 24 + 2) * 3_600_000_000

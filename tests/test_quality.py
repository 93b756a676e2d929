"""The six checks and the gate on hand-made tables."""

from datetime import date, timedelta

import pytest
from conftest import rows

from tidemark.functions.span import ReportSpan, single
from tidemark.operators import quality

D = date(2026, 6, 30)


def tables(make, **changed):
    frames = {
        name: make(name, {})
        for name in ("customer", "application", "loan", "installment", "payment")
    }
    frames["loan"] = make("loan", dict(principal=100))
    return {**frames, **changed}


def value(check, frames):
    return int(check(frames, D).first().value)


def test_clean_tables_pass(make):
    checks = quality.all_checks(tables(make), D)
    assert checks.count() == 6
    assert rows(checks.select("status").distinct()) == [("passed",)]
    assert rows(quality.gate(checks)) == [("success", 0, None)]


def test_orphan_counts_include_every_row_of_a_key(make):
    frames = tables(
        make,
        application=make("application", dict(customer_id=9), dict(customer_id=9), {}),
        payment=make("payment", dict(installment_id=7), dict(installment_id=7), {}),
    )
    assert value(quality.check_orphan_applications, frames) == 2
    assert value(quality.check_orphan_payments, frames) == 2


@pytest.mark.parametrize(
    "application, expected",
    [
        (dict(decision="rejected"), 1),
        (dict(offer_accepted=False), 1),
        (dict(decision="approved"), 0),
        (dict(application_id=2), 1),
    ],
)
def test_orphan_loans(make, application, expected):
    frames = tables(make, application=make("application", application))
    assert value(quality.check_orphan_loans, frames) == expected


def test_unknown_decision_of_an_accepted_application_is_not_counted(make):
    applications = make("application", {}).selectExpr(
        "application_id", "cast(null as string) as decision", "offer_accepted"
    )
    frames = tables(make, application=applications)
    assert value(quality.check_orphan_loans, frames) == 0


def test_negative_amounts(make):
    frames = tables(
        make,
        application=make("application", dict(requested_amount=-1)),
        payment=make("payment", dict(interest_paid=-1), dict(amount=-1, principal_paid=-1), {}),
    )
    assert value(quality.check_negative_amounts, frames) == 3


@pytest.mark.parametrize("principal, expected", [("100.02", 0), ("100.03", 1), ("99.97", 1)])
def test_schedule_tolerance(make, principal, expected):
    frames = tables(make, loan=make("loan", dict(principal=principal), dict(loan_id=5)))
    assert value(quality.check_schedule_reconciliation, frames) == expected


@pytest.mark.parametrize(
    "history, today, expected",
    [
        ({}, 9, 0),  # no baseline
        ({1: 1, 7: 3}, 10, 0),  # exactly five times the average of the days present
        ({1: 1, 7: 3}, 11, 1),
        ({8: 1}, 9, 0),  # outside the baseline week
        ({1: 1}, 0, 0),  # nothing today
    ],
)
def test_volume_spike(make, history, today, expected):
    days = [(D - timedelta(days=n), count) for n, count in history.items()] + [(D, today)]
    events = [dict(application_date=d) for d, count in days for _ in range(count)]
    numbered = [dict(row, application_id=n) for n, row in enumerate(events, start=1)]
    frames = tables(make, application=make("application", *numbered))
    assert value(quality.check_volume_spike, frames) == expected
    spikes = quality.volume_spikes(frames["application"], ReportSpan(D - timedelta(days=20), D))
    on_day = {r.report_date: int(r.value) for r in spikes.collect()}
    assert on_day.get(D, 0) == expected
    assert set(on_day) == {d for d, count in days if count}
    assert quality.volume_spikes(frames["application"], single(D)).count() == min(today, 1)


def test_gate_names_hard_failures_in_check_order(make):
    frames = tables(
        make,
        loan=make("loan", dict(principal=500)),
        application=make("application", dict(customer_id=9, requested_amount=-5)),
    )
    verdict = quality.gate(quality.all_checks(frames, D)).first()
    assert verdict.status == "failed_quality"
    assert verdict.error_message == (
        "orphan_applications; negative_amounts; schedule_reconciliation"
    )


def test_a_warning_does_not_stop_the_gate(make):
    days = [D - timedelta(days=1)] + [D] * 6
    applications = make(
        "application",
        *[dict(application_id=n, application_date=d) for n, d in enumerate(days, start=1)],
    )
    checks = quality.all_checks(tables(make, application=applications), D)
    assert checks.filter("status = 'failed'").first().severity == "warning"
    assert quality.gate(checks).first().status == "success"

"""A refresh of the changed dates alone: equal to a rebuild, other dates keep their folders."""

from datetime import date, timedelta

from conftest import rows
from tidemark.functions.span import ReportSpan
from tidemark.plans import jobs
from tidemark.plans.acquisition import campaign_kpi, credit_kpi
from tidemark.plans.exposure import portfolio_kpi, vintage_kpi
from tidemark.schemas import MARTS
from tidemark.sources import versions

D = date(2026, 3, 1)
SPAN = ReportSpan(D, D + timedelta(days=45))


def day(n):
    return D + timedelta(days=n)


def first_batch(make):
    n = range(1, 7)
    return dict(
        customer=make("customer", *[dict(customer_id=i) for i in n]),
        marketing_touch=make("marketing_touch", *[dict(touch_id=i, customer_id=i, touch_date=day(3 * i - 8)) for i in n]),
        application=make("application", *[dict(application_id=i, customer_id=i, campaign_id="CAMP", application_date=day(3 * i - 5)) for i in n]),
        loan=make("loan", *[dict(loan_id=i, application_id=i, customer_id=i, disbursement_date=day(3 * i - 5 + i % 2), principal=100 * i) for i in n]),
        installment=make("installment", *[dict(installment_id=i, loan_id=i, due_date=day(4 * i)) for i in n]),
        payment=make("payment", *[dict(payment_id=i, loan_id=i, installment_id=i, payment_date=day(4 * i + 2)) for i in n if i % 2]),
    )


def whole(t):
    return dict(
        daily_credit_kpi=credit_kpi(t["application"], t["customer"], t["loan"], SPAN),
        daily_campaign_kpi=campaign_kpi(t["marketing_touch"], t["application"], t["loan"], SPAN),
        daily_portfolio_kpi=portfolio_kpi(t["installment"], t["loan"], t["payment"], SPAN),
        vintage_kpi=vintage_kpi(t["loan"], t["installment"], t["payment"], SPAN),
    )


def folders(entries):
    return {k: p for k, p in entries.items() if k[0].startswith("mart/")}


def test_only_changed_dates_are_written(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    done = jobs.refresh_changed(spark, root, first_batch(make), SPAN)
    assert all(done[m] == SPAN.dates for m in MARTS)
    changes = [
        # a payment in the past alters balances from its date on
        (dict(payment=make("payment", dict(payment_id=20, loan_id=2, installment_id=2, payment_date=day(30)))), dict(daily_portfolio_kpi=30, vintage_kpi=30)),
        # a correction takes an application to another day; a customer gets another grade
        (
            dict(
                application=make("application", dict(application_id=3, event_version=2, customer_id=3, campaign_id="CAMP", application_date=day(40))),
                customer=make("customer", dict(customer_id=1, event_version=2, risk_grade="A")),
            ),
            dict(daily_credit_kpi=[4, 40], daily_campaign_kpi=[*range(4, 35), *range(40, 46)]),
        ),
        # a touch before the span that still shows, a loan and an installment
        (dict(marketing_touch=make("marketing_touch", dict(touch_id=30, customer_id=2, touch_date=day(-20)))), dict(daily_campaign_kpi=list(range(11)))),
        (
            dict(
                loan=make("loan", dict(loan_id=4, event_version=2, application_id=4, customer_id=4, disbursement_date=day(38), principal=77)),
                installment=make("installment", dict(installment_id=41, loan_id=5, due_date=day(20), scheduled_principal=9)),
            ),
            dict(daily_portfolio_kpi=7, vintage_kpi=7, daily_credit_kpi=[7], daily_campaign_kpi=list(range(7, 38))),
        ),
    ]
    for batch, expected in changes:
        before = folders(versions.current(spark, root))
        done = jobs.refresh_changed(spark, root, batch, SPAN)
        after = folders(versions.current(spark, root))
        for mart in MARTS:
            numbers = expected.get(mart, [])
            days = [d for d in SPAN.dates if d >= day(numbers)] if isinstance(numbers, int) else [day(n) for n in numbers]
            assert done[mart] == days, mart
            for d in SPAN.dates:
                if d not in days:
                    key = (f"mart/{mart}", d.isoformat())
                    assert after.get(key) == before.get(key)
        for mart, frame in whole(jobs.canonical_tables(spark, root)).items():
            assert rows(jobs.mart_table(spark, root, mart)) == rows(frame), mart
    before = versions.current(spark, root)
    assert not any(jobs.refresh_changed(spark, root, changes[0][0], SPAN).values())
    assert versions.current(spark, root) == before
    # events loaded without a refresh leave marts that have to be built anew
    jobs.load_events(spark, root, dict(payment=make("payment", dict(payment_id=50, loan_id=6, installment_id=6, payment_date=day(1)))))
    assert jobs.refresh_changed(spark, root, {}, SPAN)["vintage_kpi"] == SPAN.dates
    for mart, frame in whole(jobs.canonical_tables(spark, root)).items():
        assert rows(jobs.mart_table(spark, root, mart)) == rows(frame), mart

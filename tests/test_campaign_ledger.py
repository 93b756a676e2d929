"""Any-touch credit kept up by the touches and applications that a load changes."""

import random
from datetime import date, timedelta

from conftest import rows

from tidemark.functions.span import ReportSpan
from tidemark.plans import jobs
from tidemark.plans.acquisition import CAMPAIGN_LEDGER, campaign_changes, campaign_kpi
from tidemark.sources import signed, versions

D = date(2026, 3, 1)
SPAN = ReportSpan(D + timedelta(days=12), D + timedelta(days=45))
MART = ("daily_campaign_kpi",)
NAMES = ("marketing_touch", "application", "loan")


def day(n):
    return D + timedelta(days=n)


def equal_whole(spark, root):
    """The ledger, and the mart from it, as all rows give them; returns the mart."""
    t = jobs.canonical_tables(spark, root)
    given = [t[n] for n in NAMES]
    whole = CAMPAIGN_LEDGER.totals(campaign_changes(*given))
    kept = CAMPAIGN_LEDGER.totals(signed.read(spark, root, versions.current(spark, root), CAMPAIGN_LEDGER))
    assert rows(kept, *whole.columns) == rows(whole)
    mart = rows(campaign_kpi(*given, SPAN))
    assert rows(jobs.mart_table(spark, root, "daily_campaign_kpi")) == mart
    return mart


def touch(n, customer, when, campaign="A", **more):
    return dict(touch_id=n, customer_id=customer, campaign_id=campaign, touch_date=day(when), **more)


def applied(n, customer, when, campaign="A", **more):
    return dict(application_id=n, customer_id=customer, campaign_id=campaign, application_date=day(when), **more)


def lent(n, application, when, principal=100, **more):
    return dict(loan_id=n, application_id=application, disbursement_date=day(when), principal=principal, **more)


def batches(make):
    return [
        dict(
            marketing_touch=make("marketing_touch", touch(1, 1, 10), touch(2, 1, 10, opened=True), touch(3, 1, 14), touch(4, 2, 28)),
            application=make("application", applied(1, 1, 15), applied(2, 2, 30), applied(3, 3, 20), applied(4, 1, 16, None)),
            loan=make("loan", lent(1, 1, 18), lent(2, 2, 29)),
        ),
        # a late touch of an old application, a touch taken to another campaign, one over the end of a month
        dict(marketing_touch=make("marketing_touch", touch(5, 3, 13), touch(3, 1, 14, "B", event_version=2), touch(6, 2, 35))),
        # an application moved by days and one to a campaign, a new one beside stored touches
        dict(application=make("application", applied(1, 1, 17, event_version=2), applied(4, 1, 16, "B", event_version=2), applied(5, 2, 36))),
        # loans alone: a new one, one of another amount, one taken to another application
        dict(loan=make("loan", lent(3, 3, 22), lent(1, 1, 19, 150, event_version=2), lent(2, 5, 40, event_version=2))),
        # all at once, and versions that are older than the stored ones
        dict(
            marketing_touch=make("marketing_touch", touch(7, 4, 30), touch(7, 4, 31, event_version=2), touch(3, 1, 2, source_event_id="old")),
            application=make("application", applied(6, 4, 38), applied(1, 9, 1, source_event_id="older")),
            loan=make("loan", lent(6, 6, 39)),
        ),
    ]


def test_every_change_leaves_what_the_full_join_gives(spark, make, tmp_path):
    root, seen = str(tmp_path / "lake"), []
    for batch in batches(make):
        jobs.refresh_changed(spark, root, batch, SPAN, MART)
        seen.append(equal_whole(spark, root))
    assert all(a != b for a, b in zip(seen, seen[1:]))
    before = versions.current(spark, root)
    jobs.refresh_changed(spark, root, batch, SPAN, MART)
    assert versions.current(spark, root) == before
    jobs.rebuild(spark, root, SPAN.start, SPAN.end)
    assert rows(jobs.mart_table(spark, root, "daily_campaign_kpi")) == seen[-1]


def test_random_changes(spark, make, tmp_path):
    root, rng, made = str(tmp_path / "lake"), random.Random(5), {}

    def some(n, build):
        found = {}
        for _ in range(n):
            row = build()
            key = (build, next(iter(row.values())))
            made[key] = row["event_version"] = made.get(key, 0) + 1
            found[key] = row
        return list(found.values())

    def a_touch():
        return touch(rng.randrange(40), rng.randrange(4), rng.randrange(40), rng.choice("AB"), clicked=rng.random() < 0.5)

    def an_application():
        return applied(rng.randrange(25), rng.randrange(4), rng.randrange(40), rng.choice(["A", "B", None]))

    def a_loan():
        return lent(rng.randrange(15), rng.randrange(25), rng.randrange(50), rng.randrange(1, 300))

    for size in (30, 6):
        batch = {n: make(n, *some(size, b)) for n, b in zip(NAMES, (a_touch, an_application, a_loan))}
        jobs.refresh_changed(spark, root, batch, SPAN, MART)
        assert equal_whole(spark, root)


def test_a_root_without_the_ledger_gets_it(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    first, second = batches(make)[:2]
    jobs.refresh_changed(spark, root, first, SPAN, MART)
    old = {k: p for k, p in versions.current(spark, root).items() if k[0] != CAMPAIGN_LEDGER.table}
    versions.publish(spark, root, old)
    jobs.refresh_changed(spark, root, second, SPAN, MART)
    equal_whole(spark, root)


def test_a_payment_alone_leaves_the_campaign_ledger(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    jobs.refresh_changed(spark, root, batches(make)[0], SPAN, MART)
    kept = {k: p for k, p in versions.current(spark, root).items() if k[0] == CAMPAIGN_LEDGER.table}
    jobs.load_events(spark, root, dict(payment=make("payment", dict(payment_id=1))))
    assert kept and kept.items() <= versions.current(spark, root).items()

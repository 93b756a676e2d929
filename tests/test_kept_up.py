"""The stored ledger and the reference counts follow changed rows and equal a whole computation."""

from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions.span import ReportSpan
from tidemark.operators.quality import all_checks
from tidemark.operators.references import CHECKED
from tidemark.plans import jobs
from tidemark.plans.exposure import LEDGER, exposure_ledger, ledger_within, portfolio_kpi, vintage_kpi
from tidemark.sources import signed, versions

D = date(2026, 3, 1)
SPAN = ReportSpan(D + timedelta(days=10), D + timedelta(days=30))


def day(n):
    return D + timedelta(days=n)


def first_batch(make):
    n = range(1, 9)
    return dict(
        customer=make("customer", *[dict(customer_id=i) for i in n]),
        application=make("application", *[dict(application_id=i, customer_id=i, application_date=day(i)) for i in n]),
        loan=make("loan", *[dict(loan_id=i, application_id=i, customer_id=i, disbursement_date=day(2 * i), principal=200, risk_grade="AB"[i % 2]) for i in n]),
        installment=make("installment", *[dict(installment_id=10 * i + k, loan_id=i, due_date=day(3 * i + 9 * k)) for i in n for k in (1, 2)]),
        payment=make("payment", *[dict(payment_id=i, loan_id=i, installment_id=10 * i + 1, payment_date=day(3 * i + 8)) for i in n if i % 2]),
    )


def changes(make):
    return [
        # a part payment, one taken to another installment, one with the loan id of another loan
        dict(payment=make(
            "payment",
            dict(payment_id=20, loan_id=2, installment_id=21, payment_date=day(18), amount=60, principal_paid=50),
            dict(payment_id=1, event_version=2, loan_id=1, installment_id=32, payment_date=day(12)),
            dict(payment_id=21, loan_id=7, installment_id=42, payment_date=day(20)),
        )),
        # a loan disbursed on another day with another grade, an installment taken to another loan
        dict(
            loan=make("loan", dict(loan_id=4, event_version=2, application_id=4, customer_id=4, disbursement_date=day(27), principal=210, risk_grade="E")),
            installment=make("installment", dict(installment_id=51, event_version=2, loan_id=6, due_date=day(1))),
        ),
        # orphans and a rejected application
        dict(
            application=make("application", dict(application_id=3, event_version=2, customer_id=99, decision="rejected", requested_amount=-5)),
            payment=make("payment", dict(payment_id=30, loan_id=50, installment_id=501, amount=-1)),
            loan=make("loan", dict(loan_id=50, application_id=77, customer_id=1)),
        ),
        # their parents, and an older version that changes nothing
        dict(
            customer=make("customer", dict(customer_id=99)),
            application=make("application", dict(application_id=77, customer_id=99), dict(application_id=3, event_version=3, customer_id=99)),
            installment=make("installment", dict(installment_id=501, loan_id=50, due_date=day(15), scheduled_principal=1000)),
            loan=make("loan", dict(loan_id=4, event_version=1, source_event_id="late", principal=1)),
        ),
    ]


def equal_whole(spark, root):
    t = jobs.canonical_tables(spark, root)
    entries = versions.current(spark, root)
    whole = LEDGER.totals(exposure_ledger(t["installment"], t["loan"], t["payment"], SPAN))
    kept = LEDGER.totals(ledger_within(signed.read(spark, root, entries, LEDGER), SPAN))
    assert rows(kept, *LEDGER.schema.names) == rows(whole, *LEDGER.schema.names)
    checks = {r.check_name: int(r.observed_value) for r in all_checks(t, day(20)).collect()}
    assert jobs.check_values(entries) == {name: checks[name] for name in CHECKED}
    assert rows(all_checks(t, day(20), jobs.check_values(entries))) == rows(all_checks(t, day(20)))
    return checks


def test_every_change_leaves_what_a_whole_computation_gives(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    jobs.refresh_changed(spark, root, first_batch(make), SPAN)
    assert not any(equal_whole(spark, root).values())
    seen = set()
    for batch in changes(make):
        jobs.refresh_changed(spark, root, batch, SPAN)
        seen |= {name for name, n in equal_whole(spark, root).items() if n}
    assert seen >= set(CHECKED)
    before = versions.current(spark, root)
    assert jobs.load_events(spark, root, batch) == 0
    assert versions.current(spark, root) == before
    t = jobs.canonical_tables(spark, root)
    kept = {n: rows(jobs.mart_table(spark, root, n)) for n in ("daily_portfolio_kpi", "vintage_kpi")}
    assert kept["daily_portfolio_kpi"] == rows(portfolio_kpi(t["installment"], t["loan"], t["payment"], SPAN))
    assert kept["vintage_kpi"] == rows(vintage_kpi(t["loan"], t["installment"], t["payment"], SPAN))
    jobs.rebuild(spark, root, SPAN.start, SPAN.end)
    assert kept == {n: rows(jobs.mart_table(spark, root, n)) for n in kept}


def test_a_root_without_ledger_and_counts_gets_them(spark, make, tmp_path):
    root = str(tmp_path / "lake")
    jobs.load_events(spark, root, first_batch(make))
    kinds = ("ledger/", "counts/", jobs.CHECK_VALUE)
    old = {k: p for k, p in versions.current(spark, root).items() if not k[0].startswith(kinds)}
    versions.publish(spark, root, old)
    jobs.load_events(spark, root, changes(make)[0])
    equal_whole(spark, root)


def test_one_loan_reads_its_own_parts(spark, make, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    loans = spark.range(400)
    base = {
        "loan": make("loan", {}).drop("loan_id", "source_event_id").crossJoin(loans.selectExpr("id AS loan_id")),
        "installment": make("installment", {}).drop("installment_id", "loan_id", "source_event_id").crossJoin(spark.range(2400).selectExpr("id AS installment_id", "id DIV 6 AS loan_id")),
        "payment": make("payment", {}).drop("payment_id", "installment_id", "loan_id", "source_event_id").crossJoin(spark.range(2400).selectExpr("id AS payment_id", "id AS installment_id", "id DIV 6 AS loan_id")),
    }
    jobs.load_events(spark, root, {n: f.withColumn("source_event_id", F.expr(f"concat('{n}:', {n}_id)")) for n, f in base.items()})
    entries = versions.current(spark, root)
    parents = {
        "loan": spark.createDataFrame([(7,)], "loan_id long"),
        "installment": spark.createDataFrame([(7,)], "loan_id long"),
        "payment": spark.createDataFrame([(42,)], "installment_id long"),
    }
    for name, one in parents.items():
        found = jobs.rows_under(spark, root, name, entries, one)
        stored = jobs.canonical_tables(spark, root)[name]
        assert len(found.inputFiles()) * 10 < len(stored.inputFiles())
        expected = rows(stored.join(one, one.columns, "left_semi").select(*found.columns))
        assert len(expected) in (1, 6) and rows(found) == expected
        with monkeypatch.context() as patched:
            patched.setattr(jobs, "NAMED_KEYS", 0)
            joined = jobs.rows_under(spark, root, name, entries, one)
            assert rows(joined.select(*found.columns)) == expected
    jobs.load_events(spark, root, dict(payment=make("payment", dict(payment_id=5000, loan_id=7, installment_id=42))))
    equal_whole(spark, root)


@pytest.mark.parametrize("bucketed", [False, True])
def test_signed_runs_add_up_and_fold(spark, tmp_path, bucketed):
    kind = signed.Signed("t", ("k long",), ("n",), bucketed)
    entries, expected = {}, {}
    for step in range(12):
        change = [(k, k + step) for k in range(step, step + 3)] + [(100, 1 if step % 2 else -1)]
        for k, n in change:
            expected[k] = expected.get(k, 0) + n
        entries = signed.add(spark, str(tmp_path), entries, kind, spark.createDataFrame(change, "k long, n long"), f"v{step}")
    found = kind.totals(signed.read(spark, str(tmp_path), entries, kind))
    assert rows(found) == sorted(((k, n) for k, n in expected.items() if n), key=repr)
    assert len({part.split("/")[0] for _, part in entries}) <= 3
    if bucketed:
        one = spark.createDataFrame([(2,)], "k long")
        near = signed.read(spark, str(tmp_path), entries, kind, signed.buckets_of(kind, one))
        assert kind.totals(near).filter("k = 2").first().n == expected[2]

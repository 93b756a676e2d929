"""Marts against plain-Python recomputation of every report date on random books.

The books contain hot customers and loans, loans sharing an application, dates
before the disbursement, overpayments, refunds and payments without installment.
"""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest

from tidemark.functions.span import ReportSpan, single
from tidemark.plans.acquisition import campaign_kpi, credit_kpi
from tidemark.plans.exposure import (
    exposure_ledger,
    portfolio_from_changes,
    portfolio_kpi,
    vintage_from_changes,
    vintage_kpi,
)

START = date(2026, 3, 1)
SPAN = ReportSpan(START, START + timedelta(days=20))
CENT, MICRO = Decimal("0.01"), Decimal("0.000001")


def day(rng, low, high):
    return START + timedelta(days=rng.randint(low, high))


def book(rng):
    customers = [dict(customer_id=i, risk_grade=rng.choice("ABC")) for i in range(1, 8)]
    applications = [
        dict(
            application_id=i,
            customer_id=1 if rng.random() < 0.4 else rng.randint(1, 9),
            application_date=day(rng, -20, 25),
            channel=rng.choice(["sms", "organic"]),
            campaign_id=rng.choice([None, "C1", "C1", "C2"]),
            requested_amount=rng.randint(1, 9999) / 100,
            decision=rng.choice(["approved", "rejected"]),
            offer_accepted=rng.random() < 0.5,
        )
        for i in range(1, 81)
    ]
    loans = [
        dict(
            loan_id=i,
            application_id=1 if rng.random() < 0.1 else rng.randint(1, 80),
            disbursement_date=day(rng, -100, 25),
            principal=rng.randint(1, 99999) / 100,
            risk_grade=rng.choice("ABC"),
        )
        for i in range(1, 41)
    ]
    touches = [
        dict(
            touch_id=i,
            customer_id=1 if rng.random() < 0.4 else rng.randint(1, 9),
            campaign_id=rng.choice(["C1", "C2"]),
            channel=rng.choice(["sms", "organic"]),
            touch_date=day(rng, -40, 25),
            opened=rng.random() < 0.5,
            clicked=rng.random() < 0.3,
        )
        for i in range(1, 121)
    ]
    installments = [
        dict(
            installment_id=i,
            loan_id=1 if rng.random() < 0.33 else rng.randint(1, 42),
            due_date=day(rng, -120, 60),
            scheduled_principal=rng.choice([0, 100, 250.5]),
            amount_due=rng.choice([0, 110, 260.25]),
        )
        for i in range(1, 121)
    ]
    payments = [
        dict(
            payment_id=i,
            installment_id=1 if rng.random() < 0.2 else rng.randint(1, 125),
            payment_date=day(rng, -60, 30),
            amount=rng.choice([110, 55, 260.25, -20, 400]),
            principal_paid=rng.choice([100, 50, 250.5, -20, 380]),
        )
        for i in range(1, 161)
    ]
    return dict(
        customer=customers, application=applications, loan=loans, marketing_touch=touches,
        installment=installments, payment=payments,
    )


def dec(value):
    return Decimal(str(value)).quantize(CENT)


def over(a, b):
    return None if not b else (Decimal(a) / Decimal(b)).quantize(MICRO, "ROUND_HALF_UP")


def state_rows(b, d):
    loans = {x["loan_id"]: x for x in b["loan"] if x["disbursement_date"] <= d}
    for i in b["installment"]:
        loan = loans.get(i["loan_id"])
        if not loan:
            continue
        mine = [
            p for p in b["payment"]
            if p["installment_id"] == i["installment_id"] and p["payment_date"] <= d
        ]
        paid = sum((dec(p["amount"]) for p in mine), Decimal(0))
        principal = sum((dec(p["principal_paid"]) for p in mine), Decimal(0))
        yield dict(
            loan=loan,
            scheduled=dec(i["scheduled_principal"]),
            due=dec(i["amount_due"]),
            due_by_now=i["due_date"] <= d,
            dpd=max((d - i["due_date"]).days, 0),
            paid=paid,
            principal=principal,
            left=max(dec(i["scheduled_principal"]) - principal, Decimal(0)),
        )


def expected_portfolio(b, d):
    groups = defaultdict(list)
    for s in state_rows(b, d):
        groups[s["loan"]["risk_grade"]].append(s)
    for grade, ss in groups.items():
        due = sum(s["due"] for s in ss if s["due_by_now"])
        paid = sum(min(s["paid"], s["due"]) for s in ss if s["due_by_now"])
        late = [
            sum(s["left"] for s in ss if s["dpd"] >= k and s["paid"] < s["due"])
            for k in (1, 7, 30, 90)
        ]
        active = {s["loan"]["loan_id"] for s in ss if s["scheduled"] - s["principal"] > 0}
        yield (
            d, grade, len(active), sum(s["left"] for s in ss), due, paid, over(paid, due), *late
        )


def expected_vintage(b, d):
    groups = defaultdict(list)
    for s in state_rows(b, d):
        o = s["loan"]["disbursement_date"]
        months = (d.year - o.year) * 12 + d.month - o.month - (d.day < o.day)
        groups[o.replace(day=1), months].append(s)
    for (month, months), ss in groups.items():
        left = sum(s["left"] for s in ss)
        late = sum(s["left"] for s in ss if s["dpd"] >= 30 and s["paid"] < s["due"])
        loans = {s["loan"]["loan_id"] for s in ss}
        yield d, month, months, len(loans), left, late, over(late, left) or 0


def expected_credit(b, d):
    grades = {c["customer_id"]: c["risk_grade"] for c in b["customer"]}
    groups = defaultdict(list)
    for a in b["application"]:
        if a["application_date"] != d or a["customer_id"] not in grades:
            continue
        loans = [
            x for x in b["loan"]
            if x["application_id"] == a["application_id"] and x["disbursement_date"] <= d
        ]
        groups[a["channel"], "personal_installment", grades[a["customer_id"]]] += [
            (a, x) for x in loans or [None]
        ]
    for key, pairs in groups.items():
        approved = sum(a["decision"] == "approved" for a, _ in pairs)
        accepted = sum(a["offer_accepted"] for a, _ in pairs)
        yield (
            d, *key, len({a["customer_id"] for a, _ in pairs}), len(pairs), approved, accepted,
            sum(x is not None for _, x in pairs),
            sum(dec(a["requested_amount"]) for a, _ in pairs),
            sum((dec(x["principal"]) for _, x in pairs if x), Decimal(0)),
            over(approved, len(pairs)), over(accepted, approved),
        )


def expected_campaign(b, d):
    groups = defaultdict(list)
    for t in b["marketing_touch"]:
        if not d - timedelta(days=30) <= t["touch_date"] <= d:
            continue
        matches = [
            a for a in b["application"]
            if a["customer_id"] == t["customer_id"] and a["campaign_id"] == t["campaign_id"]
            and t["touch_date"] <= a["application_date"] <= t["touch_date"] + timedelta(days=7)
            and a["application_date"] <= d
        ]
        for a in matches or [None]:
            loans = [
                x for x in b["loan"]
                if a and x["application_id"] == a["application_id"]
                and x["disbursement_date"] <= d
            ]
            groups[t["touch_date"], t["campaign_id"], t["channel"]] += [
                (t, a, x) for x in loans or [None]
            ]
    for key, triples in groups.items():
        distinct = lambda picked: len(set(picked))
        yield (
            d, *key,
            distinct(t["touch_id"] for t, _, _ in triples),
            distinct(t["touch_id"] for t, _, _ in triples if t["opened"]),
            distinct(t["touch_id"] for t, _, _ in triples if t["clicked"]),
            distinct(a["application_id"] for _, a, _ in triples if a),
            distinct(x["loan_id"] for _, _, x in triples if x),
            sum((dec(x["principal"]) for _, _, x in triples if x), Decimal(0)),
        )


EXPECTED = {
    "credit": expected_credit,
    "campaign": expected_campaign,
    "portfolio": expected_portfolio,
    "vintage": expected_vintage,
}


def compute(name, f, span):
    if name == "credit":
        return credit_kpi(f["application"], f["customer"], f["loan"], span)
    if name == "campaign":
        return campaign_kpi(f["marketing_touch"], f["application"], f["loan"], span)
    if name == "portfolio":
        return portfolio_kpi(f["installment"], f["loan"], f["payment"], span)
    return vintage_kpi(f["loan"], f["installment"], f["payment"], span)


def compare(df, expected):
    got = sorted((tuple(r) for r in df.collect()), key=lambda r: [str(x) for x in r])
    want = sorted(expected, key=lambda r: [str(x) for x in r[:4]])
    got.sort(key=lambda r: [str(x) for x in r[:4]])
    assert got == want


@pytest.mark.parametrize("seed", [1, 2])
def test_span_matches_brute_force(make, seed):
    b = book(random.Random(seed))
    frames = {name: make(name, *rows).cache() for name, rows in b.items()}
    for name, expected in EXPECTED.items():
        compare(
            compute(name, frames, SPAN),
            [row for d in SPAN.dates for row in expected(b, d)],
        )


def test_single_date_equals_span_date(make):
    b = book(random.Random(3))
    frames = {name: make(name, *rows).cache() for name, rows in b.items()}
    for name, expected in EXPECTED.items():
        compare(compute(name, frames, single(SPAN.end)), list(expected(b, SPAN.end)))


def test_marts_from_the_shared_ledger(make):
    b = book(random.Random(4))
    ledger = exposure_ledger(
        make("installment", *b["installment"]),
        make("loan", *b["loan"]),
        make("payment", *b["payment"]),
        SPAN,
    ).cache()
    for name, roll_up in (
        ("portfolio", portfolio_from_changes),
        ("vintage", vintage_from_changes),
    ):
        compare(
            roll_up(ledger, SPAN), [row for d in SPAN.dates for row in EXPECTED[name](b, d)]
        )

"""Portfolio and vintage marts from dated balance changes.

Joining every installment with every report date would multiply the largest table
by the length of the look-back. Here each installment instead emits the few dates
on which one of its measures changes (disbursed, due, 1/7/30/90 days late, paid),
with the signed change. Changes before the span collapse onto its first day.
Summed per loan and then per grade or disbursement date they are small; running
sums over them give the snapshot of every report date, so a rebuild of years costs
one pass over the installments, like a single day.

The changes can also be stored for all time (:data:`LEDGER`). They are a sum over loans, so a
change of events adds what its loans give now less what they gave before.
"""

from datetime import date
from itertools import pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import cents, from_cents, month_start, months_on_book, ratio
from tidemark.functions.span import ReportSpan
from tidemark.operators.asof import payment_steps
from tidemark.schemas import MARTS, conform
from tidemark.sources.signed import Signed

BUCKETS = (1, 7, 30, 90)
DPD = [f"dpd_{days}" for days in BUCKETS]
BALANCES = ["outstanding", "amount_due", "amount_paid", *DPD]
COUNTS = ["loans", "active_loans"]
# All dates: no change is moved to the first day of the span or left out after the last.
ALWAYS = ReportSpan(date(1, 1, 1), date(9999, 12, 31))
LEDGER = Signed(
    "ledger/exposure",
    ("risk_grade string", "disbursement_date date", "change_date date"),
    (*COUNTS, *BALANCES),
)


def _sums(columns):
    return [F.sum(c).alias(c) for c in columns]


def _installment_phases(
    installments: DataFrame, payments: DataFrame, span: ReportSpan
) -> DataFrame:
    """Stretches of constant paid totals per installment, in cents.

    The opening phase starts with the span and includes what was paid by then;
    each later one starts at a payment and knows the totals before it.
    """
    steps = payment_steps(payments, span).drop("next_step_date")
    book = installments.selectExpr(
        "installment_id",
        "loan_id",
        "due_date",
        f"{cents('scheduled_principal')} AS scheduled",
        f"{cents('amount_due')} AS due",
    ).join(steps, "installment_id", "left")

    # Kinds of phase: 0 opens unpaid, 1 starts at a payment, 2 opens with payments.
    kinds = f"""explode(CASE WHEN step_date IS NULL THEN array(0)
        WHEN step_no > 1 THEN array(1)
        WHEN step_date = {span.first_sql} THEN array(2)
        ELSE array(0, 1) END) AS kind"""
    return book.selectExpr("*", kinds).selectExpr(
        "loan_id",
        "due_date",
        "scheduled",
        "due",
        "kind <> 1 AS opening",
        f"IF(kind = 1, step_date, {span.first_sql}) AS since",
        "IF(kind = 0, 0L, paid) AS paid",
        "IF(kind = 0, 0L, principal) AS principal",
        "paid_before",
        "principal_before",
    )


def _installment_changes(
    installments: DataFrame, payments: DataFrame, span: ReportSpan
) -> DataFrame:
    """(loan_id, change_date) rows with the change of every measure on that date."""
    # dealt by loan before each phase becomes several rows, which then needn't be exchanged
    phases = _installment_phases(installments, payments, span).repartition("loan_id")
    levels = phases.selectExpr(
        "loan_id",
        "since",
        "opening",
        "due",
        "greatest(since, due_date) AS falls_due",
        *[f"greatest(since, date_add(due_date, {k})) AS late_{k}" for k in BUCKETS],
        "least(paid, due) AS capped",
        "least(paid_before, due) AS capped_before",
        "greatest(scheduled - principal, 0L) AS remaining",
        "greatest(scheduled - principal_before, 0L) AS remaining_before",
        "paid < due AS short",
        "paid_before < due AS short_before",
    )
    late_dates = [f"late_{k}" for k in BUCKETS]
    # The dates never decrease, so a repeated one equals its predecessor.
    ordered = ["since", "falls_due", *late_dates]
    moments = ", ".join(
        [ordered[0], *[f"IF({b} > {a}, {b}, NULL)" for a, b in pairwise(ordered)]]
    )
    signed = levels.selectExpr(
        "loan_id",
        "since",
        "falls_due",
        *late_dates,
        "CAST(remaining > 0 AS BIGINT) - CAST(NOT opening AND remaining_before > 0 AS BIGINT) "
        "AS open_value",
        "remaining - IF(opening, 0L, remaining_before) AS remaining_value",
        "IF(opening, due, 0L) AS due_value",
        "capped - IF(opening, 0L, capped_before) AS paid_value",
        "IF(short, remaining, 0L) - IF(NOT opening AND short_before, remaining_before, 0L) "
        "AS late_value",
        f"explode(array({moments})) AS change_date",
    ).filter(f"change_date <= {span.last_sql}")

    def on(day, value, name):
        return f"IF(change_date = {day}, {value}, 0L) AS {name}"

    return signed.selectExpr(
        "loan_id",
        "change_date",
        on("since", "open_value", "open_installments"),
        on("since", "remaining_value", "outstanding"),
        on("falls_due", "due_value", "amount_due"),
        on("falls_due", "paid_value", "amount_paid"),
        *[on(f"late_{k}", "late_value", f"dpd_{k}") for k in BUCKETS],
    )


def loan_changes(
    installments: DataFrame, loans: DataFrame, payments: DataFrame, span: ReportSpan
) -> DataFrame:
    """Changes per loan and date with the loan's grade and disbursement date.

    ``loans`` is 1 where a loan appears, ``active_loans`` +1 or -1 where it gains
    or loses its last installment with principal left; balances are in cents. A
    loan has at most one row per span date before it meets the loan table.
    """
    per_loan = (
        _installment_changes(installments, payments, span)
        .groupBy("loan_id", "change_date")
        .agg(*_sums(["open_installments", *BALANCES]))
    )
    disbursed = loans.filter(f"disbursement_date <= {span.last_sql}").select(
        "loan_id", "risk_grade", "disbursement_date"
    )
    by_date = "OVER (PARTITION BY loan_id ORDER BY change_date"
    tracked = per_loan.join(disbursed, "loan_id").selectExpr(
        "*",
        f"sum(open_installments) {by_date} ROWS UNBOUNDED PRECEDING) AS open_now",
        f"row_number() {by_date}) = 1 AS appears",
    )
    return tracked.selectExpr(
        "risk_grade",
        "disbursement_date",
        # A loan's changes dated before its disbursement appear with it.
        "greatest(change_date, disbursement_date) AS change_date",
        "CAST(appears AS BIGINT) AS loans",
        "CAST(open_now > 0 AS BIGINT) "
        "- CAST(NOT appears AND open_now - open_installments > 0 AS BIGINT) AS active_loans",
        *BALANCES,
    )


def exposure_ledger(
    installments: DataFrame, loans: DataFrame, payments: DataFrame, span: ReportSpan
) -> DataFrame:
    """Changes per (risk_grade, disbursement_date, change_date), for both marts."""
    return (
        loan_changes(installments, loans, payments, span)
        .groupBy("risk_grade", "disbursement_date", "change_date")
        .agg(*_sums([*COUNTS, *BALANCES]))
    )


def ledger_difference(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """What the stored ledger lacks when the rows of some loans change.

    Both hold the loans, their installments and the payments of these, whole.
    """
    was, now = (
        exposure_ledger(t["installment"], t["loan"], t["payment"], ALWAYS) for t in (before, after)
    )
    keys = LEDGER.key_names
    taken = was.select(*keys, *[(-F.col(m)).alias(m) for m in LEDGER.measures])
    return now.select(*taken.columns).unionAll(taken)


def ledger_within(ledger: DataFrame, span: ReportSpan) -> DataFrame:
    """The ledger of a span from the one of all time; earlier changes fall on its first day."""
    return ledger.filter(f"change_date <= {span.last_sql}").withColumn(
        "change_date", F.expr(span.clamp("change_date"))
    )


def _daily_levels(changes: DataFrame, key: str, measures: list[str], span) -> DataFrame:
    """Running totals of the changes per key, repeated for every report date."""
    daily = changes.groupBy(key, "change_date").agg(*_sums(measures))
    # Where changes have been taken back, a key can be left without any loan.
    by_date = f"OVER (PARTITION BY {key} ORDER BY change_date"
    levels = daily.selectExpr(
        key,
        "change_date",
        f"lead(change_date) {by_date}) AS next_change",
        *[f"sum({m}) {by_date} ROWS UNBOUNDED PRECEDING) AS {m}" for m in measures],
    )
    return levels.filter("loans > 0").selectExpr(
        f"{span.days('change_date', 'date_sub(next_change, 1)')} AS report_date", key, *measures
    )


def portfolio_from_changes(changes: DataFrame, span: ReportSpan) -> DataFrame:
    levels = _daily_levels(changes, "risk_grade", [*COUNTS, *BALANCES], span)
    return conform(
        levels.selectExpr(
            "report_date",
            "risk_grade",
            "active_loans",
            f"{from_cents('outstanding')} AS outstanding_principal",
            f"{from_cents('amount_due')} AS amount_due",
            f"{from_cents('amount_paid')} AS amount_paid",
            f"{ratio('amount_paid', 'amount_due')} AS collection_rate",
            *[f"{from_cents(c)} AS {c}_balance" for c in DPD],
        ),
        MARTS["daily_portfolio_kpi"],
    )


def vintage_from_changes(changes: DataFrame, span: ReportSpan) -> DataFrame:
    # Months on book depend on the day of disbursement, so levels are kept per
    # disbursement date (bounded by the calendar) and rolled up per report date.
    measures = ["loans", "outstanding", "dpd_30"]
    rolled = (
        _daily_levels(changes, "disbursement_date", measures, span)
        .groupBy(
            "report_date",
            month_start(F.col("disbursement_date")).alias("origination_month"),
            months_on_book(F.col("report_date"), F.col("disbursement_date")).alias(
                "months_on_book"
            ),
        )
        .agg(*_sums(measures))
    )
    return conform(
        rolled.selectExpr(
            "report_date",
            "origination_month",
            "months_on_book",
            "loans AS active_loans",
            f"{from_cents('outstanding')} AS outstanding_principal",
            f"{from_cents('dpd_30')} AS dpd_30_balance",
            f"coalesce({ratio('dpd_30', 'outstanding')}, 0) AS dpd_30_rate",
        ),
        MARTS["vintage_kpi"],
    )


def portfolio_kpi(installments, loans, payments, span: ReportSpan) -> DataFrame:
    """Balances, collections and delinquency per report date and loan grade."""
    return portfolio_from_changes(loan_changes(installments, loans, payments, span), span)


def vintage_kpi(loans, installments, payments, span: ReportSpan) -> DataFrame:
    """Balances and 30-day delinquency per origination month and months on book."""
    return vintage_from_changes(loan_changes(installments, loans, payments, span), span)

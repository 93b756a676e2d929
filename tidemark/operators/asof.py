"""State of the loan book as of report dates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import cents, days_past_due, from_cents, month_start, months_on_book
from tidemark.functions.span import ReportSpan


def customer_state(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        F.col("monthly_income").cast("double").alias("monthly_income"),
        F.col("existing_debt").cast("double").alias("existing_debt"),
        "risk_score",
        "risk_grade",
        "acquisition_channel",
    )


def open_installments(
    installments: DataFrame, loans: DataFrame, payments: DataFrame, as_of
) -> DataFrame:
    """Installments due by ``as_of`` and not fully covered by all payments so far.

    Payments are not limited by date here.
    """
    paid = payments.groupBy("installment_id").agg(F.sum("amount").alias("amount_paid"))
    due = installments.filter(F.col("due_date") <= F.lit(as_of)).select(
        "installment_id",
        "loan_id",
        "installment_no",
        "due_date",
        "scheduled_principal",
        "scheduled_interest",
        "amount_due",
    )
    unpaid = (
        due.join(paid, "installment_id", "left")
        .filter(F.coalesce("amount_paid", F.lit(0)) < F.col("amount_due"))
        .drop("amount_paid")
    )
    return unpaid.join(loans.select("loan_id", "risk_grade"), "loan_id").select(
        *due.columns, "risk_grade"
    )


def paid_installments(payments: DataFrame) -> DataFrame:
    return payments.select("installment_id").distinct()


def untouched(open_rows: DataFrame, payments: DataFrame) -> DataFrame:
    """Open installments that never received any payment."""
    return open_rows.join(paid_installments(payments), "installment_id", "left_anti")


def payment_steps(payments: DataFrame, span: ReportSpan) -> DataFrame:
    """Running paid totals (in cents) per installment at each date they change.

    Payments before the span fall on its first day, so an installment has at
    most one row per span date however many payments it received. The totals
    before and after each step are given.
    """
    daily = (
        payments.filter(f"payment_date <= {span.last_sql}")
        .selectExpr(
            "installment_id",
            f"{span.clamp('payment_date')} AS step_date",
            f"{cents('amount')} AS step_paid",
            f"{cents('principal_paid')} AS step_principal",
        )
        .groupBy("installment_id", "step_date")
        .agg(F.sum("step_paid").alias("step_paid"), F.sum("step_principal").alias("step_principal"))
    )
    by_date = "OVER (PARTITION BY installment_id ORDER BY step_date"
    running = f"{by_date} ROWS UNBOUNDED PRECEDING)"
    return daily.selectExpr(
        "installment_id",
        "step_date",
        f"row_number() {by_date}) AS step_no",
        f"lead(step_date) {by_date}) AS next_step_date",
        f"sum(step_paid) {running} AS paid",
        f"sum(step_principal) {running} AS principal",
        f"sum(step_paid) {running} - step_paid AS paid_before",
        f"sum(step_principal) {running} - step_principal AS principal_before",
    )


def paid_as_of(payments: DataFrame, span: ReportSpan) -> DataFrame:
    """Paid totals per (report date, installment), counting payments up to that date."""
    if span.start == span.end:
        totals = (
            payments.filter(f"payment_date <= {span.last_sql}")
            .selectExpr(
                "installment_id",
                f"{cents('amount')} AS paid",
                f"{cents('principal_paid')} AS principal",
            )
            .groupBy("installment_id")
            .agg(F.sum("paid").alias("paid"), F.sum("principal").alias("principal"))
            .withColumn("report_date", span.last)
        )
    else:
        totals = payment_steps(payments, span).selectExpr(
            "*", f"{span.days('step_date', 'date_sub(next_step_date, 1)')} AS report_date"
        )
    return totals.selectExpr(
        "report_date",
        "installment_id",
        f"{from_cents('paid', 18)} AS amount_paid",
        f"{from_cents('principal', 18)} AS principal_paid",
    )


def _state(
    installments: DataFrame, loans: DataFrame, payments: DataFrame, span: ReportSpan
) -> DataFrame:
    book = (
        installments.select(
            "installment_id", "loan_id", "due_date", "amount_due", "scheduled_principal"
        )
        .join(
            loans.filter(f"disbursement_date <= {span.last_sql}").select(
                "loan_id", "risk_grade", "disbursement_date"
            ),
            "loan_id",
        )
        .selectExpr("*", f"{span.days('disbursement_date')} AS report_date")
    )
    return book.join(paid_as_of(payments, span), ["report_date", "installment_id"], "left").select(
        "report_date",
        "installment_id",
        "loan_id",
        "risk_grade",
        "disbursement_date",
        "due_date",
        "amount_due",
        "scheduled_principal",
        F.coalesce("amount_paid", F.lit(0)).alias("amount_paid"),
        F.coalesce("principal_paid", F.lit(0)).alias("principal_paid"),
        days_past_due(F.col("report_date"), F.col("due_date")).alias("days_past_due"),
    )


def installment_state(installments, loans, payments, span: ReportSpan) -> DataFrame:
    """One row per report date and installment of a loan disbursed by that date."""
    return _state(installments, loans, payments, span).drop("disbursement_date")


def vintage_state(installments, loans, payments, span: ReportSpan) -> DataFrame:
    """Installment state with origination month and months on book."""
    disbursed = F.col("disbursement_date")
    return (
        _state(installments, loans, payments, span)
        .withColumn("origination_month", month_start(disbursed))
        .withColumn("months_on_book", months_on_book(F.col("report_date"), disbursed))
        .withColumnRenamed("days_past_due", "dpd")
        .drop("disbursement_date", "risk_grade")
    )

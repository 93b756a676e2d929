"""Data-quality checks and the gate in front of mart publication.

Every check is a one-row frame with a ``value`` column. Child rows are counted
per parent key before they meet the parent table, so a key holding a large share
of the rows arrives as one row.
"""

from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.span import ReportSpan, single
from tidemark.schemas import OBSERVED


def _total(df: DataFrame, column: str = "n") -> DataFrame:
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).cast(OBSERVED).alias("value"))


def _per_key(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def check_orphan_applications(frames, report_date=None) -> DataFrame:
    per_customer = _per_key(frames["application"], "customer_id")
    known = frames["customer"].select("customer_id")
    return _total(per_customer.join(known, "customer_id", "left_anti"))


def check_orphan_loans(frames, report_date=None) -> DataFrame:
    """Loans without an application, or whose application was not approved and accepted.

    An unknown decision of an accepted application is not counted.
    """
    per_application = _per_key(frames["loan"], "application_id").alias("l")
    applications = (
        frames["application"].select("application_id", "decision", "offer_accepted").alias("a")
    )
    joined = per_application.join(
        applications, F.col("l.application_id") == F.col("a.application_id"), "left"
    )
    broken = (
        F.col("a.application_id").isNull()
        | (F.col("a.decision") != "approved")
        | ~F.col("a.offer_accepted")
    )
    return _total(joined.filter(broken))


def check_orphan_payments(frames, report_date=None) -> DataFrame:
    per_installment = _per_key(frames["payment"], "installment_id")
    known = frames["installment"].select("installment_id")
    return _total(per_installment.join(known, "installment_id", "left_anti"))


def check_negative_amounts(frames, report_date=None) -> DataFrame:
    negative = frames["application"].agg(
        F.count_if(F.col("requested_amount") < 0).alias("n")
    ).unionAll(
        frames["payment"].agg(
            F.count_if(
                (F.col("amount") < 0)
                | (F.col("principal_paid") < 0)
                | (F.col("interest_paid") < 0)
            ).alias("n")
        )
    )
    return _total(negative)


def unreconciled_loans(loans: DataFrame, installments: DataFrame, tolerance="0.02") -> DataFrame:
    scheduled = installments.groupBy("loan_id").agg(
        F.sum("scheduled_principal").alias("scheduled")
    )
    return (
        loans.select("loan_id", "principal")
        .join(scheduled, "loan_id")
        .withColumn("difference", F.abs(F.col("principal") - F.col("scheduled")))
        .filter(F.col("difference") > F.lit(Decimal(tolerance)))
    )


def check_schedule_reconciliation(frames, report_date=None, tolerance="0.02") -> DataFrame:
    broken = unreconciled_loans(frames["loan"], frames["installment"], tolerance)
    return broken.agg(F.count(F.lit(1)).cast(OBSERVED).alias("value"))


def volume_spikes(applications: DataFrame, span: ReportSpan, factor="5") -> DataFrame:
    """Per report date with applications: 1 when its count exceeds ``factor`` times
    the average over those of the previous seven days that had any, else 0."""
    daily = (
        applications.filter(
            F.col("application_date").between(F.date_sub(span.first, 7), span.last)
        )
        .groupBy("application_date")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # A day's count is its own volume and part of the baseline of the next seven days.
    spread = daily.select(
        "n",
        F.posexplode(
            F.sequence("application_date", F.date_add("application_date", 7))
        ).alias("offset", "report_date"),
    ).filter(F.col("report_date").between(span.first, span.last))
    per_date = spread.groupBy("report_date").agg(
        F.max(F.when(F.col("offset") == 0, F.col("n"))).alias("volume"),
        F.sum(F.when(F.col("offset") > 0, F.col("n"))).alias("base_total"),
        F.count_if(F.col("offset") > 0).alias("base_days"),
    )
    limit = F.col("base_total") * F.lit(Decimal(factor))
    spiked = (F.col("base_total") > 0) & (F.col("volume") * F.col("base_days") > limit)
    return per_date.filter("volume is not null").select(
        "report_date", F.when(spiked, 1).otherwise(0).cast(OBSERVED).alias("value")
    )


def check_volume_spike(frames, report_date: date, factor="5") -> DataFrame:
    # a caller may hand in the recent applications alone, which a pruned scan yields
    recent = frames.get("recent_application", frames["application"])
    spikes = volume_spikes(recent, single(report_date), factor)
    return _total(spikes, "value")


# Check name -> (severity, details).
CHECKS = {
    "orphan_applications": (
        "hard",
        "Every application must reference a canonical customer.",
    ),
    "orphan_loans": (
        "hard",
        "Every loan must be funded from an accepted approved application.",
    ),
    "orphan_payments": ("hard", "Every payment must reference an installment."),
    "negative_amounts": ("hard", "Monetary amounts must be non-negative."),
    "schedule_reconciliation": (
        "hard",
        "Installment principal must reconcile to the disbursed principal.",
    ),
    "daily_application_volume_spike": (
        "warning",
        "A large volume spike is recorded as a warning, not a hard failure.",
    ),
}

_RULES = {
    "orphan_applications": check_orphan_applications,
    "orphan_loans": check_orphan_loans,
    "orphan_payments": check_orphan_payments,
    "negative_amounts": check_negative_amounts,
    "schedule_reconciliation": check_schedule_reconciliation,
    "daily_application_volume_spike": check_volume_spike,
}


def all_checks(
    frames: dict[str, DataFrame], report_date: date, known: dict[str, int] | None = None
) -> DataFrame:
    """One row per check with its severity, status, observed value and details.

    Checks whose value is ``known`` are not computed.
    """

    def value(name):
        if known is None or name not in known:
            return _RULES[name](frames, report_date)
        spark = frames["application"].sparkSession
        return spark.range(1).select(F.lit(known[name]).cast(OBSERVED).alias("value"))

    def row(name):
        severity, details = CHECKS[name]
        return value(name).select(
            F.lit(name).alias("check_name"),
            F.lit(severity).alias("severity"),
            F.when(F.col("value") > 0, "failed").otherwise("passed").alias("status"),
            F.col("value").alias("observed_value"),
            F.lit(details).alias("details"),
        )

    return reduce(DataFrame.unionAll, [row(name) for name in CHECKS])


def gate(checks: DataFrame) -> DataFrame:
    """Whether the marts may be published; names of failed hard checks in check order."""
    order = F.array(*[F.lit(name) for name in CHECKS])
    failed = F.when(
        (F.col("severity") == "hard") & (F.col("status") == "failed"), F.col("check_name")
    )
    names = F.filter(order, lambda name: F.array_contains(F.col("failed"), name))
    return checks.agg(F.collect_set(failed).alias("failed")).select(
        F.when(F.size("failed") > 0, "failed_quality").otherwise("success").alias("status"),
        F.size("failed").alias("hard_failures"),
        F.when(F.size("failed") > 0, F.array_join(names, "; ")).alias("error_message"),
    )


def dq_summary(checks: DataFrame, report_date: date) -> DataFrame:
    return checks.select(F.lit(report_date).alias("report_date"), "*")

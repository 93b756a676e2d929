"""Reporting frames over published marts.

Every report takes the mart frames by table name. ``report_date=None`` means the
newest date of the credit and portfolio marts together, so a lagging mart yields
an empty panel instead of an older day.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CREDIT, PORTFOLIO = "daily_credit_kpi", "daily_portfolio_kpi"
CAMPAIGN, VINTAGE = "daily_campaign_kpi", "vintage_kpi"


def latest_report_date(marts: dict[str, DataFrame]) -> DataFrame:
    newest = [
        marts[name].agg(F.max("report_date").alias("latest_date")) for name in (CREDIT, PORTFOLIO)
    ]
    return newest[0].unionAll(newest[1]).agg(F.max("latest_date").alias("latest_date"))


def _on_date(marts: dict[str, DataFrame], name: str, report_date) -> DataFrame:
    mart = marts[name]
    if report_date is not None:
        return mart.filter(F.col("report_date") == F.lit(report_date))
    latest = latest_report_date(marts)
    return mart.join(latest, mart.report_date == latest.latest_date).drop("latest_date")


def _totals(columns):
    return [F.sum(c).alias(c) for c in columns]


def report_overview(marts, report_date=None) -> DataFrame:
    return (
        _on_date(marts, CREDIT, report_date)
        .agg(*_totals(["applications", "approvals", "funded_amount", "funded_count"]))
        # a day without rows counts as zeros, not as NULLs
        .na.fill(0)
        .select(
            "applications",
            (F.col("approvals") / F.greatest("applications", F.lit(1))).alias("approval_rate"),
            F.col("funded_amount").cast("decimal(18,2)").alias("funded_amount"),
            F.col("funded_count").alias("funded_loans"),
        )
    )


def report_acquisition_trend(marts) -> DataFrame:
    return (
        marts[CREDIT]
        .groupBy("report_date")
        .agg(
            F.sum("applications").alias("applications"),
            F.sum("funded_amount").cast("decimal(18,2)").alias("funded_amount"),
        )
        .orderBy("report_date")
    )


def report_outstanding_by_grade(marts, report_date=None) -> DataFrame:
    return _on_date(marts, PORTFOLIO, report_date).select("risk_grade", "outstanding_principal")


def report_funnel(marts, report_date=None) -> DataFrame:
    return (
        _on_date(marts, CREDIT, report_date)
        .groupBy("channel")
        .agg(
            *_totals(["applications", "approvals", "accepted", "funded_count"]),
            F.sum("funded_amount").cast("decimal(18,2)").alias("funded_amount"),
        )
    )


def report_portfolio_trend(marts) -> DataFrame:
    columns = ["outstanding_principal", "dpd_30_balance", "amount_due", "amount_paid"]
    return (
        marts[PORTFOLIO]
        .groupBy("report_date")
        .agg(*[F.sum(c).cast("decimal(18,2)").alias(c) for c in columns])
        .orderBy("report_date")
    )


def report_vintage_rates(marts, report_date=None) -> DataFrame:
    """Mean 30-day rate per origination month and months on book."""
    vintage = _on_date(marts, VINTAGE, report_date)
    return vintage.groupBy("origination_month", "months_on_book").agg(
        F.avg(F.col("dpd_30_rate").cast("double")).alias("mean_dpd_30_rate")
    )


def report_vintage_heatmap(marts, report_date=None) -> DataFrame:
    """The same rates with a column per months on book.

    Columns run up to the highest value present, which the calendar bounds.
    """
    rates = report_vintage_rates(marts, report_date)
    highest = rates.agg(F.max("months_on_book")).first()[0]
    months = list(range((highest or 0) + 1))
    wide = (
        rates.groupBy("origination_month")
        .pivot("months_on_book", months)
        .agg(F.first("mean_dpd_30_rate"))
    )
    return wide.select(
        "origination_month", *[F.col(f"`{m}`").alias(f"mob_{m}") for m in months]
    )


def report_campaign_summary(marts, report_date=None) -> DataFrame:
    return (
        _on_date(marts, CAMPAIGN, report_date)
        .groupBy("campaign_id", "channel")
        .agg(
            *_totals(["touches", "opens", "clicks", "applications"]),
            F.sum("funded_amount").cast("decimal(18,2)").alias("funded_amount"),
        )
        .withColumn("click_rate", F.try_divide("clicks", "touches"))
        .withColumn("application_rate", F.try_divide("applications", "touches"))
    )


def report_dq_list(dq_summary: DataFrame, rows: int = 100) -> DataFrame:
    return dq_summary.orderBy(F.col("report_date").desc(), "check_name").limit(rows)


def report_dq_failed(dq_summary: DataFrame, marts, report_date=None) -> DataFrame:
    failed = F.col("status") == "failed"
    if report_date is not None:
        return dq_summary.agg(
            F.count_if(failed & (F.col("report_date") == F.lit(report_date))).alias(
                "failed_checks"
            )
        )
    latest = latest_report_date(marts)
    on_latest = dq_summary.filter(failed).join(
        latest, dq_summary.report_date == latest.latest_date
    )
    return on_latest.agg(F.count(F.lit(1)).alias("failed_checks"))

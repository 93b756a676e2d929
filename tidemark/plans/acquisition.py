"""Credit-funnel and campaign marts, and rates derived from them."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import cents, from_cents, ratio
from tidemark.functions.span import ReportSpan
from tidemark.operators.attribution import CUSTOMER_CAMPAIGN, join_within_days
from tidemark.schemas import MARTS, conform
from tidemark.sources.signed import Signed


def _sums(columns):
    return [F.sum(c).alias(c) for c in columns]


def credit_kpi(
    applications: DataFrame, customers: DataFrame, loans: DataFrame, span: ReportSpan
) -> DataFrame:
    """Applications, approvals, acceptances and same-day funding per report date.

    The report date is the application date, the grade the customer's current one.
    An application with several loans counts once per loan. Rows shrink to one per
    customer, date, channel and product before customers are joined, which also
    makes the distinct applicants a plain count.
    """
    dated = applications.filter(
        f"application_date BETWEEN {span.first_sql} AND {span.last_sql}"
    ).selectExpr(
        "application_id",
        "customer_id",
        "application_date",
        "channel",
        "product_code",
        f"{cents('requested_amount')} AS requested",
        "coalesce(decision = 'approved', false) AS approved",
        "coalesce(offer_accepted, false) AS taken",
    )
    # Loans of an application by disbursement date, one row each.
    funded = (
        loans.filter(f"disbursement_date <= {span.last_sql}")
        .groupBy("application_id", "disbursement_date")
        .agg(F.count(F.lit(1)).alias("loans"), F.expr(f"sum({cents('principal')}) AS loan_cents"))
    )
    joined = dated.join(
        funded,
        (dated.application_id == funded.application_id)
        & (funded.disbursement_date <= dated.application_date),
        "left",
    ).selectExpr(
        "application_date",
        "channel",
        "product_code",
        "customer_id",
        "coalesce(loans, 1L) AS applications",
        "IF(approved, coalesce(loans, 1L), 0L) AS approvals",
        "IF(taken, coalesce(loans, 1L), 0L) AS accepted",
        "coalesce(loans, 0L) AS funded_count",
        "requested * coalesce(loans, 1L) AS requested",
        "coalesce(loan_cents, 0L) AS funded",
    )
    grain = ["application_date", "channel", "product_code"]
    measures = ["applications", "approvals", "accepted", "funded_count", "requested", "funded"]
    grouped = (
        joined.groupBy(*grain, "customer_id")
        .agg(*_sums(measures))
        .join(customers.select("customer_id", "risk_grade"), "customer_id")
        .groupBy(*grain, "risk_grade")
        .agg(F.count(F.lit(1)).alias("unique_applicants"), *_sums(measures))
    )
    return conform(
        grouped.selectExpr(
            "application_date AS report_date",
            "channel",
            "product_code",
            "risk_grade",
            "unique_applicants",
            "applications",
            "approvals",
            "accepted",
            "funded_count",
            f"{from_cents('requested')} AS requested_amount",
            f"{from_cents('funded')} AS funded_amount",
            f"{ratio('approvals', 'applications')} AS approval_rate",
            f"{ratio('accepted', 'approvals')} AS acceptance_rate",
        ),
        MARTS["daily_credit_kpi"],
    )


# Days after a touch on which an application is credited to it, and on which it is reported.
ATTRIBUTION_DAYS = 7
TOUCH_DAYS = 30

_GROUP = ["touch_date", "campaign_id", "channel"]
_COUNTS = ["touches", "opens", "clicks", "applications", "funded_count"]

#: The campaign mart's changes of all time: per touch date, campaign, channel and day.
CAMPAIGN_LEDGER = Signed(
    "ledger/campaign",
    ("touch_date date", "campaign_id string", "channel string", "change_date date"),
    (*_COUNTS, "loan_cents"),
)


def _outcomes(applications: DataFrame, loans: DataFrame) -> DataFrame:
    """Campaign applications and their loans per customer, campaign and day.

    ``visible_date`` is the day from which a count belongs in a report: the
    application date, or the later disbursement date of a loan.
    """
    applied = applications.filter("campaign_id IS NOT NULL").select(
        "application_id", *CUSTOMER_CAMPAIGN, "application_date"
    )
    key = [*CUSTOMER_CAMPAIGN, "application_date"]
    submitted = (
        applied.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("applications"))
        .selectExpr(
            *key,
            "application_date AS visible_date",
            "applications",
            "0L AS funded_count",
            "0L AS loan_cents",
        )
    )
    disbursed = loans.selectExpr(
        "application_id", "disbursement_date", f"{cents('principal')} AS loan_cents"
    )
    funded = (
        applied.join(disbursed, "application_id")
        .selectExpr(
            *key, "greatest(application_date, disbursement_date) AS visible_date", "loan_cents"
        )
        .groupBy(*key, "visible_date")
        .agg(F.count(F.lit(1)).alias("funded_count"), F.sum("loan_cents").alias("loan_cents"))
        .selectExpr(*key, "visible_date", "0L AS applications", "funded_count", "loan_cents")
    )
    return submitted.unionByName(funded)


def campaign_changes(
    touches: DataFrame,
    applications: DataFrame,
    loans: DataFrame,
    attribution_days: int = ATTRIBUTION_DAYS,
    touch_days: int = TOUCH_DAYS,
) -> DataFrame:
    """What touches and the outcomes credited to them add to their group, and from which day on.

    Both sides meet as one row per customer and day, so a customer or campaign with
    very many touches stays bounded by the calendar. Rows aren't added up yet.
    """
    per_customer = touches.groupBy(*_GROUP, "customer_id").agg(
        F.count(F.lit(1)).alias("touches"),
        F.count_if("opened").alias("opens"),
        F.count_if("clicked").alias("clicks"),
    )
    credited = join_within_days(
        per_customer,
        _outcomes(applications, loans),
        CUSTOMER_CAMPAIGN,
        "touch_date",
        "application_date",
        attribution_days,
    )
    activity = per_customer.selectExpr(
        *_GROUP,
        "touch_date AS change_date",
        "touches",
        "opens",
        "clicks",
        "0L AS applications",
        "0L AS funded_count",
        "0L AS loan_cents",
    )
    results = credited.filter(f"visible_date <= date_add(touch_date, {touch_days})").selectExpr(
        *_GROUP,
        "visible_date AS change_date",
        "0L AS touches",
        "0L AS opens",
        "0L AS clicks",
        "applications",
        "funded_count",
        "loan_cents * touches AS loan_cents",
    )
    return activity.unionByName(results)


def touch_days_of(
    changed: dict[str, DataFrame], applications: DataFrame, days: int = ATTRIBUTION_DAYS
) -> DataFrame | None:
    """Customer, campaign and touch date of every touch whose credit changed rows can alter.

    ``changed`` holds what the rows were and what they are, by table: touches stand for themselves,
    an application for the days before it, a loan for its application among ``applications``.
    None if no table has any.
    """
    found, applied = [], []
    if "marketing_touch" in changed:
        found.append(changed["marketing_touch"].select(*CUSTOMER_CAMPAIGN, "touch_date"))
    if "application" in changed:
        applied.append(changed["application"].select(*CUSTOMER_CAMPAIGN, "application_date"))
    if "loan" in changed:
        keys = changed["loan"].select("application_id").distinct()
        own = applications.join(keys, "application_id", "left_semi")
        applied.append(own.select(*CUSTOMER_CAMPAIGN, "application_date"))
    before = f"explode(sequence(date_sub(application_date, {days}), application_date))"
    found += [
        rows.filter("campaign_id IS NOT NULL")
        .distinct()
        .selectExpr(*CUSTOMER_CAMPAIGN, f"{before} AS touch_date")
        for rows in applied
    ]
    return reduce(DataFrame.unionAll, found).distinct() if found else None


def campaign_difference(
    before: dict[str, DataFrame], after: dict[str, DataFrame], touch_days: DataFrame
) -> DataFrame:
    """What the stored ledger lacks when the credit of the touches on ``touch_days`` changes.

    Only touches of these customers, campaigns and days meet applications: new touches all
    of them, stored touches those around a changed one. What they were credited with before is taken
    back. Both dicts must hold every row that the touch days can reach.
    """
    customers = touch_days.select(*CUSTOMER_CAMPAIGN).distinct()

    def changes(t):
        touches = t["marketing_touch"].join(
            touch_days, [*CUSTOMER_CAMPAIGN, "touch_date"], "left_semi"
        )
        applied = t["application"].join(customers, CUSTOMER_CAMPAIGN, "left_semi")
        return CAMPAIGN_LEDGER.totals(campaign_changes(touches, applied, t["loan"]))

    keys = CAMPAIGN_LEDGER.key_names
    taken = changes(before).select(*keys, *[(-F.col(m)).alias(m) for m in CAMPAIGN_LEDGER.measures])
    return changes(after).select(*taken.columns).unionAll(taken)


def campaign_from_ledger(ledger: DataFrame, span: ReportSpan) -> DataFrame:
    """The campaign mart of a span from the stored ledger, runs not added up."""
    since = f"date_sub({span.first_sql}, {TOUCH_DAYS})"
    near = ledger.filter(
        f"touch_date BETWEEN {since} AND {span.last_sql} AND change_date <= {span.last_sql}"
    )
    return _campaign_mart(CAMPAIGN_LEDGER.totals(near), span, TOUCH_DAYS)


def campaign_kpi(
    touches: DataFrame,
    applications: DataFrame,
    loans: DataFrame,
    span: ReportSpan,
    attribution_days: int = ATTRIBUTION_DAYS,
    touch_days: int = TOUCH_DAYS,
) -> DataFrame:
    """Touches of the last ``touch_days`` days and what followed them, per report date.

    Any touch within ``attribution_days`` before an application is credited, so two
    touches of one customer in a group double the funded amount while applications
    and loans stay distinct. Outcomes become visible from the day they happen: the
    join runs once for the whole span and the report dates come from running sums.
    """
    within = f"BETWEEN date_sub({span.first_sql}, {touch_days}) AND {span.last_sql}"
    changes = campaign_changes(
        touches.filter(f"touch_date {within}"),
        applications.filter(f"application_date {within}"),
        loans.filter(f"disbursement_date <= {span.last_sql}"),
        attribution_days,
        touch_days,
    )
    return _campaign_mart(changes, span, touch_days)


def _campaign_mart(changes: DataFrame, span: ReportSpan, touch_days: int) -> DataFrame:
    daily = (
        changes.withColumn("change_date", F.expr(span.clamp("change_date")))
        .groupBy(*_GROUP, "change_date")
        .agg(*_sums([*_COUNTS, "loan_cents"]))
    )
    until = f"date_add(touch_date, {touch_days})"
    by_date = f"OVER (PARTITION BY {', '.join(_GROUP)} ORDER BY change_date"
    levels = daily.selectExpr(
        *_GROUP,
        "change_date",
        f"least(date_sub(lead(change_date) {by_date}), 1), {until}) AS holds_until",
        *[
            f"sum({m}) {by_date} ROWS UNBOUNDED PRECEDING) AS {m}"
            for m in [*_COUNTS, "loan_cents"]
        ],
    )
    return conform(
        levels.selectExpr(
            f"{span.days('change_date', 'holds_until')} AS report_date",
            *_GROUP,
            *_COUNTS,
            f"{from_cents('loan_cents')} AS funded_amount",
        ),
        MARTS["daily_campaign_kpi"],
    )


def funding_rate(credit_mart: DataFrame) -> DataFrame:
    """Funded over accepted per report date and channel."""
    return (
        credit_mart.groupBy("report_date", "channel")
        .agg(
            F.sum("accepted").cast("int").alias("accepted"),
            F.sum("funded_count").cast("int").alias("funded_count"),
        )
        .selectExpr("*", f"{ratio('funded_count', 'accepted')} AS funding_rate")
    )

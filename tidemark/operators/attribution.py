"""Matching campaign touches with applications in the days after them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_within_days(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_date: str,
    right_date: str,
    days: int,
    how: str = "inner",
) -> DataFrame:
    """Equi join on ``keys`` with ``right_date`` in [left_date, left_date + days].

    Both sides also join on a calendar bucket of ``days + 1`` days. A left row
    lies in at most two buckets and a right row in one, so a busy key is spread
    over its buckets and only neighbouring dates are ever compared.
    """
    # DIV rounds towards zero: the bucket around 1970 is twice as wide, no pair is lost.
    bucket = lambda day: f"unix_date({day}) DIV {days + 1}"
    last_day = f"date_add({left_date}, {days})"
    lhs = left.selectExpr(
        "*", f"explode(sequence({bucket(left_date)}, {bucket(last_day)})) AS _bucket"
    ).alias("lhs")
    rhs = right.selectExpr("*", f"{bucket(right_date)} AS _bucket").alias("rhs")
    on = F.col(f"rhs.{right_date}").between(
        F.col(f"lhs.{left_date}"), F.date_add(F.col(f"lhs.{left_date}"), days)
    )
    for key in [*keys, "_bucket"]:
        on = on & (F.col(f"lhs.{key}") == F.col(f"rhs.{key}"))
    shared = set(keys) | {"_bucket"}
    return lhs.join(rhs, on, how).select(
        *[F.col(f"lhs.{c}") for c in left.columns],
        *[F.col(f"rhs.{c}") for c in right.columns if c not in shared],
    )


CUSTOMER_CAMPAIGN = ["customer_id", "campaign_id"]


def attributed_applications(
    touches: DataFrame, applications: DataFrame, as_of=None, days: int = 7
) -> DataFrame:
    """Applications credited to each touch (any-touch); touches without one stay."""
    candidates = applications.filter("campaign_id is not null")
    if as_of is not None:
        candidates = candidates.filter(F.col("application_date") <= F.lit(as_of))
    per_day = candidates.groupBy(*CUSTOMER_CAMPAIGN, "application_date").agg(
        F.count(F.lit(1)).alias("n")
    )
    pairs = join_within_days(
        touches.select("touch_id", *CUSTOMER_CAMPAIGN, "touch_date"),
        per_day,
        CUSTOMER_CAMPAIGN,
        "touch_date",
        "application_date",
        days,
        "left",
    )
    return pairs.groupBy("touch_id").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("applications"),
        F.min("application_date").alias("first_application_date"),
        F.max("application_date").alias("last_application_date"),
    )


def last_touch(applications: DataFrame, touches: DataFrame, days: int = 7) -> DataFrame:
    """Each campaign application with the newest touch in the days up to it.

    Ties on the date go to the higher touch id. Both sides shrink to one row per
    customer, campaign and day before they meet.
    """
    daily_touch = touches.groupBy(*CUSTOMER_CAMPAIGN, "touch_date").agg(
        F.max("touch_id").alias("touch_id")
    )
    tagged = applications.filter("campaign_id is not null").select(
        "application_id", *CUSTOMER_CAMPAIGN, "application_date"
    )
    days_applied = tagged.select(*CUSTOMER_CAMPAIGN, "application_date").distinct()
    newest = (
        join_within_days(
            daily_touch, days_applied, CUSTOMER_CAMPAIGN, "touch_date", "application_date", days
        )
        .groupBy(*CUSTOMER_CAMPAIGN, "application_date")
        # One touch per date is left, so the newest date has a single touch.
        .agg(
            F.max_by("touch_id", "touch_date").alias("touch_id"),
            F.max("touch_date").alias("touch_date"),
        )
    )
    return tagged.join(newest, [*CUSTOMER_CAMPAIGN, "application_date"], "left").select(
        "application_id", "application_date", "touch_id", "touch_date"
    )

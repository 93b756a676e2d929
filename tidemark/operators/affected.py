"""Report dates whose marts a change of event rows can alter.

A changed row counts with what it was and what it is. Payments, installments and loans move
balances from a date on; touches, applications and customers only reach the dates around
their own. Dates that aren't named here have the same mart rows before and after.
"""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.span import ReportSpan

EXPOSURE = ("daily_portfolio_kpi", "vintage_kpi")
CREDIT, CAMPAIGN = "daily_credit_kpi", "daily_campaign_kpi"
# A touch is reported for so many days after its own.
TOUCH_DAYS = 30


def changed_images(before: DataFrame, after: DataFrame, id_col: str = "source_event_id") -> DataFrame:
    """Rows that were the newest of their key and aren't any more, and those that are now."""
    gone = before.join(after.select(id_col), id_col, "left_anti")
    come = after.join(before.select(id_col), id_col, "left_anti")
    return gone.unionByName(come)


def _ranges(rows: DataFrame, mart: str, first: Column, last: Column | None = None) -> DataFrame:
    """(mart, first, last) of rows; without ``last`` to the end of time. Few, as they are dates."""
    end = F.lit(date(9999, 12, 31)) if last is None else last
    return rows.select(F.lit(mart).alias("mart"), first.alias("first"), end.alias("last")).distinct()


def affected_ranges(images: dict[str, DataFrame], tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Date ranges per mart from changed rows by table; ``tables`` are all newest versions."""
    found = []
    if "payment" in images:
        found += [_ranges(images["payment"], m, F.col("payment_date")) for m in EXPOSURE]
    if "installment" in images:
        # an installment counts from the disbursement of its loan on
        keys = images["installment"].select("loan_id").distinct()
        loans = tables["loan"].join(keys, "loan_id", "left_semi")
        found += [_ranges(loans, m, F.col("disbursement_date")) for m in EXPOSURE]
    if "loan" in images:
        found += [_ranges(images["loan"], m, F.col("disbursement_date")) for m in EXPOSURE]
        keys = images["loan"].select("application_id").distinct()
        found += _by_application(tables["application"].join(keys, "application_id", "left_semi"))
    if "application" in images:
        found += _by_application(images["application"])
    if "customer" in images:
        keys = images["customer"].select("customer_id").distinct()
        own = tables["application"].join(keys, "customer_id", "left_semi")
        found.append(_ranges(own, CREDIT, F.col("application_date"), F.col("application_date")))
    if "marketing_touch" in images:
        day = F.col("touch_date")
        found.append(_ranges(images["marketing_touch"], CAMPAIGN, day, F.date_add(day, TOUCH_DAYS)))
    return found


def _by_application(applications: DataFrame) -> list[DataFrame]:
    """Credit on the day of an application; campaigns until the last touch before it is out of sight."""
    day = F.col("application_date")
    return [
        _ranges(applications, CREDIT, day, day),
        _ranges(applications, CAMPAIGN, day, F.date_add(day, TOUCH_DAYS)),
    ]


def affected_dates(
    images: dict[str, DataFrame], tables: dict[str, DataFrame], span: ReportSpan
) -> dict[str, list[date]]:
    """Dates of the span per mart that the changed rows can alter, at most the span for each mart."""
    ranges = affected_ranges(images, tables)
    if not ranges:
        return {}
    every = ranges[0]
    for one in ranges[1:]:
        every = every.unionByName(one)
    first, last = F.greatest("first", F.lit(span.start)), F.least("last", F.lit(span.end))
    within = every.select("mart", first.alias("first"), last.alias("last")).filter("first <= last")
    days = within.distinct().select("mart", F.explode(F.sequence("first", "last")).alias("day"))
    dates: dict[str, list[date]] = {}
    for row in days.distinct().orderBy("mart", "day").collect():
        dates.setdefault(row["mart"], []).append(row["day"])
    return dates

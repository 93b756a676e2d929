"""Column expressions shared by the operators. Everything stays on the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# -- money ------------------------------------------------------------------
# These return SQL text for selectExpr and F.expr: the marts use them on many
# columns, and one parsed expression is cheaper to build than many Column calls.
def cents(amount: str) -> str:
    """A two-decimal amount as whole cents.

    Sums over cents keep fixed-width long buffers in hash aggregates; ANSI mode
    raises on overflow instead of returning a wrong total.
    """
    return f"CAST(({amount}) * 100 AS BIGINT)"


def from_cents(amount: str, precision: int = 16) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(18,0)) * 0.01BD AS DECIMAL({precision},2))"


def ratio(numerator: str, denominator: str) -> str:
    """numerator / denominator rounded to the stored ratio type; NULL over zero."""
    parts = ", ".join(f"CAST({part} AS DECIMAL(18,2))" for part in (numerator, denominator))
    return f"CAST(try_divide({parts}) AS DECIMAL(10,6))"


# -- dates ------------------------------------------------------------------
def utc_midnight(day: Column, lag_hours=0) -> Column:
    """Timestamp of ``day`` 00:00 UTC plus a lag, whatever the session time zone."""
    lag = lag_hours if isinstance(lag_hours, Column) else F.lit(lag_hours)
    return F.timestamp_seconds(F.unix_date(day) * F.lit(86400) + lag * F.lit(3600))


def utc_text(stamp: str) -> str:
    """SQL: a timestamp as UTC text, whatever the session time zone."""
    return (
        "CAST(TIMESTAMP_NTZ '1970-01-01 00:00:00' "
        f"+ make_dt_interval(0, 0, 0, unix_seconds({stamp})) AS STRING)"
    )


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def months_on_book(report_date: Column, origination: Column) -> Column:
    """Completed months between two dates; a month completes on the same day number."""
    whole = (F.year(report_date) - F.year(origination)) * 12 + (
        F.month(report_date) - F.month(origination)
    )
    unfinished = F.dayofmonth(report_date) < F.dayofmonth(origination)
    return (whole - unfinished.cast("int")).cast("int")


def days_past_due(report_date: Column, due_date: Column) -> Column:
    return F.greatest(F.datediff(report_date, due_date), F.lit(0))


def installment_due_date(disbursed: Column, number: Column) -> Column:
    """Same day ``number`` months later, with days 29-31 moved to the 28th."""
    day = F.least(F.dayofmonth(disbursed), F.lit(28))
    return F.date_add(F.add_months(F.trunc(disbursed, "MM"), number), day - 1)


def calendar_flags(day: Column) -> tuple[Column, Column]:
    """(is_weekend, is_month_end) flags."""
    return F.weekday(day) >= 5, F.dayofmonth(day) >= 25


# -- identifiers ------------------------------------------------------------
def event_id(table: str, business_id: Column, version: Column) -> Column:
    return F.concat(
        F.lit(f"{table}:"), business_id.cast("string"), F.lit(":v"), version.cast("string")
    )


def batch_id(day: Column) -> Column:
    return F.concat(F.lit("batch:"), F.date_format(day, "yyyy-MM-dd"))


def campaign_id(day: Column, channel: Column) -> Column:
    return F.concat_ws("-", F.lit("CAMP"), F.date_format(day, "yyyyMM"), F.upper(channel))


def hash_bucket(*parts: Column, buckets: int) -> Column:
    """Stable bucket from the leading 64 bits of SHA-256 over the '|'-joined parts."""
    digest = F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
    leading = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
    return (leading % F.lit(buckets)).cast("long")


# -- scoring ----------------------------------------------------------------
# Lowest score of each grade; anything below the last is E.
GRADE_FLOORS = {"A": 760, "B": 700, "C": 640, "D": 580}


def risk_band(score: Column) -> Column:
    band = F
    for grade, floor in GRADE_FLOORS.items():
        band = band.when(score >= floor, grade)
    return band.otherwise("E")


def clip(value: Column, low, high) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def dti(debt: Column, requested: Column, income: Column) -> Column:
    """Debt plus a twelfth of the requested amount over income (income floored at 1)."""
    return (debt.cast("double") + requested.cast("double") / F.lit(12.0)) / F.greatest(
        income.cast("double"), F.lit(1.0)
    )


def approval_probability(score: Column, debt_to_income: Column) -> Column:
    # Intercept -0.4, score centre 650 and scale 220, DTI slope 1.5 above 0.55.
    logit = (
        F.lit(-0.4)
        + (score.cast("double") - F.lit(650.0)) / F.lit(220.0)
        - F.lit(1.5) * F.greatest(debt_to_income - F.lit(0.55), F.lit(0.0))
    )
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))

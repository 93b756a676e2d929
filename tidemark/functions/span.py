"""A contiguous range of report dates."""

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ReportSpan:
    """Report dates ``start``..``end``, both included.

    Operators clamp and expand against the two bounds, so no frame is ever
    joined with a table of dates.
    """

    start: date
    end: date

    def __post_init__(self):
        if self.end < self.start:
            raise ValueError("the end of a report span must not precede its start")

    @property
    def first(self) -> Column:
        return F.lit(self.start)

    @property
    def last(self) -> Column:
        return F.lit(self.end)

    @property
    def dates(self) -> list[date]:
        days = (self.end - self.start).days
        return [self.start + timedelta(days=n) for n in range(days + 1)]

    @property
    def first_sql(self) -> str:
        return f"DATE '{self.start.isoformat()}'"

    @property
    def last_sql(self) -> str:
        return f"DATE '{self.end.isoformat()}'"

    def clamp(self, day: str) -> str:
        """SQL: days before the span count as its first day."""
        return f"greatest({day}, {self.first_sql})"

    def days(self, since: str, until: str | None = None) -> str:
        """SQL generator: every span date from ``since`` up to ``until``.

        A NULL ``until`` means the end of the span.
        """
        begin = self.clamp(since)
        stop = self.last_sql if until is None else f"least({until}, {self.last_sql})"
        # sequence() counts downwards when its bounds cross, so guard them.
        return f"explode(CASE WHEN {begin} <= {stop} THEN sequence({begin}, {stop}) END)"

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.range(1).select(
            F.explode(F.sequence(self.first, self.last)).alias("report_date")
        )


def report_span(end: date, lookback: int = 45) -> ReportSpan:
    """The report date and the ``lookback`` days before it."""
    return ReportSpan(end - timedelta(days=lookback), end)


def single(day: date) -> ReportSpan:
    return ReportSpan(day, day)

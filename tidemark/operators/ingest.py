"""Appending events once, setting invalid rows aside, upgrading old layouts."""

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def idempotent_append(
    existing: DataFrame,
    incoming: DataFrame,
    id_col: str = "source_event_id",
    arrival: tuple[str, ...] = ("ingested_at",),
) -> DataFrame:
    """Rows of ``incoming`` whose id is not stored yet; the first arrival of an id wins.

    The stored side is reduced to the ids the batch also has by a semi join in
    which the batch is the build side. For a day's batch over a long history
    Spark broadcasts the batch ids (when their size allows) or prunes the history
    with a runtime filter, and only the id column of the history is read.
    """
    order = [F.col(c) for c in arrival] + [F.xxhash64(*incoming.columns)]
    first = (
        incoming.withColumn(
            "_arrival", F.row_number().over(Window.partitionBy(id_col).orderBy(*order))
        )
        .filter("_arrival = 1")
        .drop("_arrival")
    )
    known = existing.select(id_col).join(incoming.select(id_col).distinct(), id_col, "left_semi")
    return first.join(known, id_col, "left_anti").select(*incoming.columns)


def quarantine(
    rows: DataFrame,
    rules: dict[str, Column],
    run_date: date,
    id_col: str = "source_event_id",
    rejected_id: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split rows into (valid, rejects); the first broken rule names the reason.

    A rule that evaluates to NULL is not broken.
    """
    reason = F
    for text, broken in rules.items():
        reason = reason.when(broken, F.lit(text))
    reason = reason.otherwise(F.lit(None).cast("string"))
    payload = F.to_json(F.struct(*rows.columns))
    rejects = rows.withColumn("reason", reason).filter("reason is not null").select(
        F.lit(run_date).alias("run_date"),
        (F.col(id_col) if rejected_id is None else rejected_id).alias("source_event_id"),
        "reason",
        payload.alias("payload"),
    )
    valid = rows.filter(reason.isNull())
    return valid, rejects


def negative_request_rule() -> dict[str, Column]:
    return {"negative requested amount": F.col("requested_amount") < 0}


def null_counts(rows: DataFrame, columns: list[str]) -> dict[str, int]:
    """Columns of the list that hold NULLs, with how many; one aggregate for all of them."""
    missing = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return {c: missing[c] for c in columns if missing[c]}


def backfill_touch_date(campaign_mart: DataFrame) -> DataFrame:
    """Campaign rows written before the touch date existed take their report date."""
    if "touch_date" not in campaign_mart.columns:
        return campaign_mart.withColumn("touch_date", F.col("report_date"))
    return campaign_mart.withColumn("touch_date", F.coalesce("touch_date", "report_date"))


def batch_event_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """Events per batch over all event tables."""
    per_table = [
        df.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")) for df in tables.values()
    ]
    return (
        reduce(DataFrame.unionByName, per_table)
        .groupBy("batch_id")
        .agg(F.sum("n").alias("total_events"))
    )


def late_affected_dates(events: DataFrame, business_date: str) -> DataFrame:
    """Business dates touched by events that were ingested after their own day."""
    day = F.col(business_date)
    # Whole days since the epoch in UTC, independent of the session time zone.
    ingested = F.date_from_unix_date(
        F.floor(F.unix_micros("ingested_at") / F.lit(86_400_000_000)).cast("int")
    )
    late = events.select(
        day.alias("affected_date"), F.datediff(ingested, day).alias("late_days")
    ).filter("late_days > 0")
    return late.groupBy("affected_date").agg(
        F.count(F.lit(1)).alias("late_events"), F.max("late_days").alias("max_late_days")
    )

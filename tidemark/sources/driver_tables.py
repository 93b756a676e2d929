"""Lending events derived from the TPC-H-like tables (customer, orders, lineitem).

Orders act as applications and touches, finished orders as loans, their line
items as installments and payments. Keys ending in 3 also get an older, wrong
version that the canonical views must drop. The modulo rules give the rows their
roles (channel, opened, corrected); none leaves a row out. Only finished orders become loans,
and only returned lines are never paid.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import batch_id, event_id, risk_band, utc_midnight
from tidemark.schemas import EVENTS, MONEY, conform
from tidemark.sources.storage import stored_once

# Closed sets in the order the modulo mappings use them.
CHANNELS = ["organic", "paid_search", "referral", "partner", "sms"]
REGIONS = ["Hong_Kong_Island", "Kowloon", "New_Territories"]
TERMS = [6, 12, 24, 36]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(values: list, number: Column) -> Column:
    """values[number % len(values)] as literal branches."""
    chosen = F
    for position, value in enumerate(values):
        chosen = chosen.when(number % len(values) == position, F.lit(value))
    return chosen


def _money(column: str) -> Column:
    return F.col(column).cast(MONEY)


def _envelope(table: str, key: str, day: str, version: Column) -> list[Column]:
    return [
        event_id(table, F.col(key), version).alias("source_event_id"),
        version.cast("int").alias("event_version"),
        utc_midnight(F.col(day)).alias("event_time"),
        utc_midnight(F.col(day), (version - 1) * 24).alias("ingested_at"),
        batch_id(F.col(day)).alias("batch_id"),
    ]


def _versions(
    table: str, key: str, day: str, rows: DataFrame, corrected: Column, wrong: dict
) -> DataFrame:
    """Current rows, plus a superseded first version of the corrected ones."""
    version = F.when(corrected, F.lit(2)).otherwise(F.lit(1))
    current = rows.select(*_envelope(table, key, day, version), *rows.columns)
    first = rows.filter(corrected).select(
        *_envelope(table, key, day, F.lit(1)),
        *[wrong.get(c, F.col(c)).alias(c) for c in rows.columns],
    )
    return conform(current.unionByName(first), EVENTS[table])


def _score(key: Column) -> Column:
    """The customer's current score: the second version exists for keys ending in 0."""
    first = 350 + (key * 37) % 501
    return F.when(key % 10 == 0, 350 + (key * 91 + 17) % 501).otherwise(first)


def customer_events(spark, sf_dir) -> DataFrame:
    key = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").select(
        key.alias("customer_id"),
        F.date_add(F.lit("1995-01-01").cast("date"), (key % 365).cast("int")).alias("signup_date"),
        _pick(REGIONS, key).alias("region"),
        _pick(CHANNELS, key).alias("acquisition_channel"),
        (6000 + F.abs(_money("c_acctbal"))).cast(MONEY).alias("monthly_income"),
        (F.abs(_money("c_acctbal")) * F.lit("0.5").cast("decimal(2,1)"))
        .cast(MONEY)
        .alias("existing_debt"),
        (6 + key % 175).alias("employment_tenure_months"),
    )

    def version(number, score):
        return rows.filter("customer_id % 10 = 0" if number == 2 else "true").select(
            *_envelope("customer", "customer_id", "signup_date", F.lit(number)),
            *rows.columns,
            score.alias("risk_score"),
            risk_band(score).alias("risk_grade"),
        )

    customer = F.col("customer_id")
    first = version(1, 350 + (customer * 37) % 501)
    second = version(2, 350 + (customer * 91 + 17) % 501)
    return conform(first.unionByName(second), EVENTS["customer"])


def _orders(spark, sf_dir) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        _money("o_totalprice").alias("amount"),
        day.alias("day"),
        F.concat_ws(
            "-", F.lit("CAMP"), F.year(day).cast("string"), (F.col("o_orderkey") % 5).cast("string")
        ).alias("campaign"),
    )


def application_events(spark, sf_dir) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    rows = _orders(spark, sf_dir).select(
        key.alias("application_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("day").alias("application_date"),
        F.lit("personal_installment").alias("product_code"),
        _pick(CHANNELS, key).alias("channel"),
        F.when(key % 3 != 0, F.col("campaign")).alias("campaign_id"),
        F.col("amount").alias("requested_amount"),
        F.when(status.isin("F", "O"), "approved").otherwise("rejected").alias("decision"),
        F.col("day").alias("decision_date"),
        (status == "F").alias("offer_accepted"),
        F.when(status == "F", F.col("day")).alias("accepted_date"),
    )
    wrong = {
        "requested_amount": F.col("requested_amount") * 2,
        "decision": F.lit("rejected"),
        "offer_accepted": F.lit(False),
        "accepted_date": F.lit(None).cast("date"),
    }
    corrected = F.col("application_id") % 10 == 3
    return _versions("application", "application_id", "application_date", rows, corrected, wrong)


def marketing_touch_events(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    rows = (
        _orders(spark, sf_dir)
        .select(
            (key * 10 + 2).alias("touch_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("campaign").alias("campaign_id"),
            _pick(CHANNELS, key).alias("channel"),
            F.date_sub("day", (key % 11).cast("int")).alias("touch_date"),
            (key % 3 != 0).alias("opened"),
            (key % 7 == 0).alias("clicked"),
        )
    )
    # The last digit of a touch id is always 2; the order key comes before it.
    corrected = F.col("touch_id") % 100 == 32
    wrong = {"opened": ~F.col("opened"), "clicked": F.lit(False)}
    return _versions("marketing_touch", "touch_id", "touch_date", rows, corrected, wrong)


def _disbursed(key: Column) -> Column:
    return F.date_add("day", (key % 3).cast("int"))


def _loan_rows(spark, sf_dir) -> DataFrame:
    """Accepted applications that have line items."""
    principal = (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum(_money("l_extendedprice")).cast(MONEY).alias("principal"))
    )
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    return (
        _orders(spark, sf_dir)
        .filter("o_orderstatus = 'F'")
        .join(principal, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            (key * 10 + 1).alias("loan_id"),
            key.alias("application_id"),
            customer.alias("customer_id"),
            _disbursed(key).alias("disbursement_date"),
            # Keys ending in 9 carry 5 cents too much and fail reconciliation.
            (F.col("principal") + F.when(key % 10 == 9, F.lit("0.05")).otherwise("0").cast(MONEY))
            .cast(MONEY)
            .alias("principal"),
            _pick(TERMS, key).cast("int").alias("term_months"),
            (F.lit("0.06").cast("decimal(8,5)") + ((key % 25) / F.lit(100)).cast("decimal(8,5)"))
            .cast("decimal(8,5)")
            .alias("annual_rate"),
            risk_band(_score(customer)).alias("risk_grade"),
            F.lit("active").alias("status"),
        )
    )


def _loans(spark, sf_dir) -> DataFrame:
    return stored_once(spark, sf_dir, "loan_rows", lambda: _loan_rows(spark, sf_dir))


def loan_events(spark, sf_dir) -> DataFrame:
    rows = _loans(spark, sf_dir)
    corrected = F.col("loan_id") % 100 == 31
    wrong = {"principal": (F.col("principal") + 1000).cast(MONEY)}
    return _versions("loan", "loan_id", "disbursement_date", rows, corrected, wrong)


#: Lines are counted by this many hash buckets of their order; a bucket with so many lines more than
#: twice the mean may hold a very long order.
LINE_BUCKETS, LONG_ORDER = 4096, 1_000_000


def _line_numbers(lines: DataFrame) -> DataFrame:
    """Lines with ``installment_no``, their number within the order; lines without a ship date are counted but left out.

    One exchange by order serves nearly all. Orders in buckets that may hold a very long one are
    numbered by many tasks, see :func:`_long_order_numbers`. The driver sees only such buckets.
    """
    bucket = F.pmod(F.xxhash64("l_orderkey"), F.lit(LINE_BUCKETS))
    sizes = lines.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
    most = LONG_ORDER + 2 * sum(r["n"] for r in sizes) / LINE_BUCKETS
    crowded = [r["bucket"] for r in sizes if r["n"] > most]
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "price"]
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order))
    usual = lines.filter(~bucket.isin(crowded)) if crowded else lines
    numbered = usual.withColumn("installment_no", number).filter("l_shipdate is not null")
    if not crowded:
        return numbered
    return numbered.unionByName(_long_order_numbers(lines.filter(bucket.isin(crowded))))


def _long_order_numbers(lines: DataFrame) -> DataFrame:
    """Numbers as :func:`_line_numbers` gives them, with a very long order dealt to many tasks.

    Numbers are counted within (order, ship date) and shifted by the rows of the
    order's earlier dates.
    """
    earlier = Window.partitionBy("l_orderkey").orderBy("l_shipdate")
    offsets = (
        lines.groupBy("l_orderkey", "l_shipdate")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "l_orderkey",
            "l_shipdate",
            (
                F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
            ).alias("before"),
        )
    )
    same_day = Window.partitionBy("l_orderkey", "l_shipdate").orderBy(
        "l_partkey", "l_suppkey", "l_linenumber", "price"
    )
    number = (F.col("before") + F.col("same_day_no")).cast("int")
    return (
        lines.withColumn("same_day_no", F.row_number().over(same_day))
        .join(offsets, ["l_orderkey", "l_shipdate"])
        .withColumn("installment_no", number)
        .select(*lines.columns, "installment_no")
    )


def _installment_rows(spark, sf_dir) -> DataFrame:
    """Line items of the accepted applications, numbered within their order."""
    lines = (
        read(spark, sf_dir, "lineitem")
        .filter("l_orderkey is not null")
        .select(
            "l_orderkey",
            "l_shipdate",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            _money("l_extendedprice").alias("price"),
            "l_returnflag",
        )
    )
    key = F.col("o_orderkey")
    # an order with a line is a loan, so the loans' principal isn't needed here
    loans = (
        _orders(spark, sf_dir)
        .filter("o_orderstatus = 'F'")
        .select(
            (key * 10 + 1).alias("loan_id"),
            key.alias("l_orderkey"),
            _disbursed(key).alias("disbursement_date"),
        )
    )
    number = F.col("installment_no")
    return (
        _line_numbers(lines)
        .join(loans, "l_orderkey")
        .select(
            (F.col("loan_id") * 100 + number).alias("installment_id"),
            "loan_id",
            "installment_no",
            F.date_add("disbursement_date", number * 30).alias("due_date"),
            F.col("price").alias("scheduled_principal"),
            (F.col("price") * F.lit("0.01").cast("decimal(3,2)"))
            .cast(MONEY)
            .alias("scheduled_interest"),
            "l_returnflag",
            "l_partkey",
        )
        .withColumn(
            "amount_due",
            (F.col("scheduled_principal") + F.col("scheduled_interest")).cast(MONEY),
        )
    )


def _numbered(spark, sf_dir) -> DataFrame:
    return stored_once(
        spark, sf_dir, "installment_rows", lambda: _installment_rows(spark, sf_dir)
    )


def installment_events(spark, sf_dir) -> DataFrame:
    rows = _numbered(spark, sf_dir).drop("l_returnflag", "l_partkey")
    wrong = {
        "scheduled_principal": (F.col("scheduled_principal") + 10).cast(MONEY),
        "amount_due": (F.col("amount_due") + 10).cast(MONEY),
    }
    corrected = F.col("installment_id") % 10 == 3
    return _versions("installment", "installment_id", "due_date", rows, corrected, wrong)


def payment_events(spark, sf_dir) -> DataFrame:
    """Flag N pays in full on the due date, A half of it 1-30 days late, R never."""
    in_full = F.col("l_returnflag") == "N"
    share = F.when(in_full, F.lit("1.0")).otherwise("0.5").cast("decimal(2,1)")
    rows = (
        _numbered(spark, sf_dir)
        .filter("l_returnflag in ('N', 'A')")
        .select(
            (F.col("installment_id") * 10 + 1).alias("payment_id"),
            "loan_id",
            "installment_id",
            F.when(in_full, F.col("due_date"))
            .otherwise(F.date_add("due_date", (1 + F.col("l_partkey") % 30).cast("int")))
            .alias("payment_date"),
            (F.col("amount_due") * share).cast(MONEY).alias("amount"),
            (F.col("scheduled_principal") * share).cast(MONEY).alias("principal_paid"),
            F.when(in_full, "paid").otherwise("partial").alias("payment_status"),
        )
        .withColumn("interest_paid", (F.col("amount") - F.col("principal_paid")).cast(MONEY))
    )
    corrected = F.col("payment_id") % 100 == 31
    wrong = {
        "amount": (F.col("amount") + 1).cast(MONEY),
        "interest_paid": (F.col("interest_paid") + 1).cast(MONEY),
    }
    return _versions("payment", "payment_id", "payment_date", rows, corrected, wrong)


_BUILDERS = {
    "customer": customer_events,
    "marketing_touch": marketing_touch_events,
    "application": application_events,
    "loan": loan_events,
    "installment": installment_events,
    "payment": payment_events,
}


def events(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw event table as a frame, for queries that read it once; it isn't stored."""
    return conform(_BUILDERS[name](spark, sf_dir), EVENTS[name])


def event_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw event table, loaded from the given tables once per application."""
    return stored_once(
        spark, sf_dir, f"raw_{name}", lambda: _BUILDERS[name](spark, sf_dir), EVENTS[name]
    )


def event_tables(spark: SparkSession, sf_dir: str, names=tuple(_BUILDERS)) -> dict[str, DataFrame]:
    return {name: event_table(spark, sf_dir, name) for name in names}

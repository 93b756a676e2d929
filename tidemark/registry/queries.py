"""Registered queries: every operator over the whole given tables."""

from datetime import date, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C
from tidemark.functions.span import ReportSpan, report_span, single
from tidemark.operators import asof, attribution, ingest, quality, schedule, upsert
from tidemark.operators.canonical import latest_version
from tidemark.plans import acquisition, exposure, jobs, reports
from tidemark.schemas import DQ_SUMMARY, EVENTS, KEYS, MARTS, MONEY
from tidemark.sources import layouts, storage, versions
from tidemark.sources.driver_tables import event_table, event_tables, events, read
from tidemark.streaming import ingest as streams
from tidemark.streaming import keyed

REPORT_DATE = date(1998, 6, 30)
LOOKBACK = report_span(REPORT_DATE)
ONE_DAY = single(REPORT_DATE)
REBUILD = ReportSpan(date(1998, 1, 1), REPORT_DATE)

MONEY18 = "decimal(18,2)"
FULL = {
    "credit": "daily_credit_kpi",
    "portfolio": "daily_portfolio_kpi",
    "campaign": "daily_campaign_kpi",
    "vintage": "vintage_kpi",
}


class OnDemand(dict):
    """Frames by name, each built when it is first asked for."""

    def __init__(self, **builders):
        super().__init__()
        self._builders = builders

    def __missing__(self, name: str) -> DataFrame:
        self[name] = frame = self._builders[name]()
        return frame


class Tables:
    """Newest versions of the event tables, built when a query asks for them.

    Like a daily run, queries read them as tables written once. Joins then see a
    plain scan on both sides, so adaptive execution can split a skewed key, and
    filters and column pruning reach the Parquet scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def newest(self, name: str) -> DataFrame:
        return latest_version(events(self.spark, self.sf_dir, name), KEYS[name])

    def __getattr__(self, name: str) -> DataFrame:
        if name not in KEYS:
            raise AttributeError(name)
        return storage.stored_once(
            self.spark, self.sf_dir, f"latest_{name}", lambda: self.newest(name), EVENTS[name]
        )

    def all(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in KEYS}

    def mart(self, name: str, span: ReportSpan) -> DataFrame:
        """A mart from the newest versions, of which only the columns it needs are exchanged.

        Credit, portfolio and vintage read each table once, so these aren't stored first. Campaign
        reads touches and applications twice; those that its reports can reach are stored.
        """
        loan = self.newest("loan")
        if name == "credit":
            return acquisition.credit_kpi(
                self.newest("application"), self.newest("customer"), loan, span
            )
        if name == "campaign":
            shared = ["customer_id", "campaign_id"]
            seen = ["channel", "opened", "clicked", "touch_date"]
            touches = self.reached("marketing_touch", span, *shared, *seen)
            applied = ["application_id", "application_date"]
            applications = self.reached("application", span, *shared, *applied)
            return acquisition.campaign_kpi(touches, applications, loan, span)
        installment, payment = self.newest("installment"), self.newest("payment")
        if name == "portfolio":
            return exposure.portfolio_kpi(installment, loan, payment, span)
        return exposure.vintage_kpi(loan, installment, payment, span)

    def reached(self, name: str, span: ReportSpan, *columns: str) -> DataFrame:
        """Newest versions from the days that a campaign mart reads, by the last column; stored."""
        days = f"{columns[-1]} BETWEEN date_sub({span.first_sql}, {jobs.REACH}) AND {span.last_sql}"
        return storage.stored_once(
            self.spark,
            self.sf_dir,
            f"reached_{name}_{span.start}_{span.end}",
            lambda: self.newest(name).select(*columns).filter(days),
        )

    def published(self, *names: str) -> dict[str, DataFrame]:
        """Look-back marts written once per application, as the reports read them."""
        return {
            FULL[name]: storage.stored_once(
                self.spark,
                self.sf_dir,
                f"mart_{name}",
                lambda: self.mart(name, LOOKBACK),
                MARTS[FULL[name]],
            )
            for name in names
        }

    def with_defects(self) -> dict[str, DataFrame]:
        """Newest versions with broken rows added for the checks to find.

        Every row of the clean tables stays: applications and payments without a parent, loans
        without an accepted application and a loan with a short schedule come on top. A table is
        built when it is asked for.
        """

        def applications():
            negated = F.when(
                F.col("application_id") % 200 == 0, -F.col("requested_amount")
            ).otherwise(F.col("requested_amount"))
            orphans = self.application.filter("application_id % 50 = 1").withColumns(
                {
                    "source_event_id": F.concat(F.lit("orphan:"), "source_event_id"),
                    "application_id": -F.col("application_id"),
                    "customer_id": -F.col("customer_id"),
                }
            )
            changed = self.application.withColumn("requested_amount", negated.cast(MONEY))
            return changed.unionByName(orphans)

        def homeless():
            return self.loan.agg(F.max("loan_id").alias("last")).select(
                (F.col("last") + 10).alias("loan_id"),
                F.lit(-1).cast("long").alias("application_id"),
                F.lit(1000).cast(MONEY).alias("principal"),
            )

        def loans():
            rejected = self.application.filter("decision = 'rejected' and application_id % 300 = 7")
            extra = rejected.select(
                (F.col("application_id") * 10 + 1).alias("loan_id"),
                "application_id",
                F.col("requested_amount").alias("principal"),
            )
            own = self.loan.select("loan_id", "application_id", "principal")
            return own.unionByName(extra).unionByName(homeless())

        def installments():
            short = homeless().select(
                (F.col("loan_id") * 100).alias("installment_id"),
                "loan_id",
                F.lit(400).cast(MONEY).alias("scheduled_principal"),
            )
            schedule = self.installment.select("installment_id", "loan_id", "scheduled_principal")
            return schedule.unionByName(short)

        def payments():
            amounts = ["amount", "principal_paid", "interest_paid"]
            rows = self.payment.select("payment_id", "installment_id", *amounts)
            lost = rows.filter("installment_id % 97 = 0").withColumns(
                {"payment_id": -F.col("payment_id"), "installment_id": -F.col("installment_id")}
            )
            return rows.unionByName(lost)

        return OnDemand(
            customer=lambda: self.customer,
            application=applications,
            loan=loans,
            installment=installments,
            payment=payments,
        )

    def dq_summary(self) -> DataFrame:
        """Summary of three days: clean, and with defects from the report date on."""

        def build():
            day = timedelta(days=1)
            clean = [
                quality.dq_summary(quality.all_checks(self.all(), d), d)
                for d in (REPORT_DATE - day, REPORT_DATE)
            ]
            broken = [
                quality.dq_summary(quality.all_checks(self.with_defects(), d), d)
                for d in (REPORT_DATE, REPORT_DATE + day)
            ]
            return upsert.keyed_upsert(
                clean[0].unionAll(clean[1]),
                broken[0].unionAll(broken[1]),
                ["report_date", "check_name"],
            )

        return storage.stored_once(self.spark, self.sf_dir, "dq_summary", build, DQ_SUMMARY)


QUERIES = {}


def query(function):
    QUERIES[function.__name__] = lambda spark, sf_dir: function(Tables(spark, sf_dir))
    return function


def _folder(t: Tables, name: str) -> str:
    return storage.app_folder(t.spark, "out", f"{name}-{uuid4().hex[:8]}")


# -- sources and sinks ----------------------------------------------------------
@query
def idempotent_append(t):
    """The first half of the month is stored; the whole month is delivered twice."""
    events = read(t.spark, t.sf_dir, "events").select(
        F.concat(F.lit("event:"), F.col("event_id").cast("string")).alias("source_event_id"),
        "user_id",
        "event_type",
        "value",
        F.col("ts").alias("arrived_at"),
    )
    stored = events.filter("arrived_at < timestamp_ntz '2024-01-16'")
    again = events.withColumn("value", F.col("value") + 1).withColumn(
        "arrived_at", F.col("arrived_at") + F.expr("interval 1 hour")
    )
    return ingest.idempotent_append(stored, again.unionByName(events), arrival=("arrived_at",))


@query
def param_scan(t):
    return storage.param_scan(
        t.application,
        "select application_id, customer_id, requested_amount from {source} "
        "where application_date = :report_date",
        report_date=REPORT_DATE,
    )


def _exported(t, df, order):
    path = _folder(t, "csv")
    storage.export_csv(df, path, order)
    return t.spark.read.schema(df.schema).option("header", True).csv(path)


@query
def export_csv(t):
    return _exported(t, asof.customer_state(t.customer), ["customer_id"])


@query
def quarantine_rejects(t):
    _, rejects = ingest.quarantine(
        t.with_defects()["application"], ingest.negative_request_rule(), REPORT_DATE
    )
    return rejects.drop("payload")


@query
def quarantine_valid(t):
    valid, _ = ingest.quarantine(
        t.with_defects()["application"], ingest.negative_request_rule(), REPORT_DATE
    )
    return valid.select("source_event_id", "application_id", "requested_amount")


@query
def dq_results(t):
    path = _folder(t, "quality_results")
    checks = quality.all_checks(t.with_defects(), REPORT_DATE)
    storage.append(checks.select(F.lit(REPORT_DATE).alias("run_date"), "*"), path)
    return t.spark.read.parquet(path)


@query
def dq_summary_upsert(t):
    return t.dq_summary()


@query
def run_log_upsert(t):
    """Runs started on application dates are completed with the loaded row counts."""
    events = event_tables(t.spark, t.sf_dir)
    day = F.to_date(F.substring("batch_id", 7, 10))

    def rows(frame, status, started, finished, loaded):
        return frame.select(
            day.alias("run_date"),
            F.lit(status).alias("status"),
            "batch_id",
            C.utc_midnight(day, started).alias("started_at"),
            finished.alias("finished_at"),
            loaded.cast("int").alias("rows_loaded"),
            F.lit(0).alias("rows_rejected"),
            F.lit(None).cast("string").alias("error_message"),
        )

    none = F.lit(None).cast("timestamp")
    running = rows(
        events["application"].select("batch_id").distinct(), "running", 0, none, F.lit(0)
    )
    done = rows(
        ingest.batch_event_totals(events),
        "success",
        1,
        C.utc_midnight(day, 2),
        F.col("total_events"),
    )
    merged = upsert.keyed_upsert(running, done, ["run_date"], keep_current=("started_at",))
    return merged.selectExpr(
        *[f"{C.utc_text(c)} AS {c}" if c.endswith("_at") else c for c in merged.columns]
    )


@query
def replace_partitions(t):
    """A table of shifted, stale dates gets the look-back replaced, empty dates included."""
    path = _folder(t, "credit")
    mart = t.published("credit")["daily_credit_kpi"]
    stale = mart.withColumn("report_date", F.date_add("report_date", 1))
    stale.write.partitionBy("report_date").parquet(path)
    storage.overwrite_partitions(mart, path, "report_date", LOOKBACK.dates)
    return t.spark.read.schema(MARTS["daily_credit_kpi"]).parquet(path)


@query
def backfill_touch_date(t):
    mart = t.published("campaign")["daily_campaign_kpi"]
    older = F.col("report_date") < F.date_sub(F.lit(REPORT_DATE), 20)
    return ingest.backfill_touch_date(
        mart.withColumn("touch_date", F.when(~older, F.col("touch_date")))
    )


@query
def migrate_touch_date(t):
    """The campaign mart with its older days stored before the touch date existed, upgraded at read."""
    root, table = _folder(t, "migrate_touch_date"), "mart/daily_campaign_kpi"
    steps = jobs.MART_LAYOUTS["daily_campaign_kpi"]
    mart = t.published("campaign")["daily_campaign_kpi"]
    older = F.col("report_date") < F.date_sub(F.lit(REPORT_DATE), 20)
    entries = {}
    for version, frame in (
        ("first", mart.filter(older).drop("touch_date")),
        (steps.mark("second"), mart.filter(~older)),
    ):
        _, parts = versions.stage(frame, root, table, version, "report_date")
        entries |= {(table, part): path for part, path in parts.items()}
    return layouts.read(t.spark, root, entries, table, steps)


@query
def batch_event_totals(t):
    return ingest.batch_event_totals(event_tables(t.spark, t.sf_dir))


# -- canonical tables -----------------------------------------------------------
def _latest(alias, name):
    hidden = ("event_time", "ingested_at", "batch_id")

    def run(t):
        return t.newest(name).select(*[c for c in EVENTS[name].names if c not in hidden])

    run.__name__ = f"latest_{alias}"
    query(run)


for _alias, _name in {
    "customer": "customer",
    "touch": "marketing_touch",
    "application": "application",
    "loan": "loan",
    "installment": "installment",
    "payment": "payment",
}.items():
    _latest(_alias, _name)


# -- state ----------------------------------------------------------------------
@query
def customer_state(t):
    return asof.customer_state(t.customer)


@query
def open_installments(t):
    return asof.open_installments(t.installment, t.loan, t.payment, REPORT_DATE)


@query
def paid_installments(t):
    return asof.paid_installments(t.payment)


@query
def untouched_due_installments(t):
    return asof.untouched(open_installments(t), t.payment)


def _money(df, *names):
    return df.withColumns({c: F.col(c).cast(MONEY18) for c in names})


@query
def paid_as_of(t):
    return _money(asof.paid_as_of(t.payment, LOOKBACK), "amount_paid", "principal_paid")


@query
def installment_state(t):
    state = asof.installment_state(t.installment, t.loan, t.payment, ONE_DAY)
    return _money(state, "amount_paid", "principal_paid")


@query
def vintage_state(t):
    state = asof.vintage_state(t.installment, t.loan, t.payment, ONE_DAY)
    return _money(state, "amount_paid", "principal_paid")


# -- marts ----------------------------------------------------------------------
def _mart(prefix, name, build):
    build.__name__ = f"{prefix}_{name}"
    query(build)


for _name in FULL:
    _mart("mart", _name, lambda t, n=_name: t.mart(n, ONE_DAY))
    _mart("refresh", _name, lambda t, n=_name: t.mart(n, LOOKBACK))
    _mart(
        "export",
        _name,
        lambda t, n=_name: _exported(t, t.mart(n, ONE_DAY), jobs.EXPORT_ORDER[FULL[n]]),
    )


@query
def rebuild_range(t):
    return t.mart("portfolio", REBUILD)


for _name in ("credit", "campaign", "vintage"):
    _mart("rebuild", _name, lambda t, n=_name: t.mart(n, REBUILD))


@query
def last_touch_attribution(t):
    return attribution.last_touch(t.application, t.marketing_touch)


@query
def funding_rate(t):
    return acquisition.funding_rate(t.published("credit")["daily_credit_kpi"])


# -- joins ----------------------------------------------------------------------
@query
def join_inner_customer(t):
    return t.application.join(t.customer.select("customer_id", "risk_grade"), "customer_id").select(
        "application_id", "customer_id", "risk_grade"
    )


@query
def join_left_asof_loan(t):
    a, loans = t.application.alias("a"), t.loan.alias("l")
    on = (F.col("a.application_id") == F.col("l.application_id")) & (
        F.col("l.disbursement_date") <= F.col("a.application_date")
    )
    return a.join(loans, on, "left").select(
        "a.application_id", "a.application_date", "l.loan_id", "l.principal"
    )


@query
def join_interval_attribution(t):
    return attribution.attributed_applications(t.marketing_touch, t.application, REPORT_DATE)


@query
def join_installment_loan(t):
    loans = t.loan.select("loan_id", "risk_grade", "disbursement_date")
    return t.installment.select("installment_id", "loan_id").join(loans, "loan_id").select(
        "installment_id", "loan_id", "risk_grade", "disbursement_date"
    )


@query
def join_left_paid(t):
    paid = t.payment.groupBy("installment_id").agg(
        F.sum("amount").cast(MONEY18).alias("amount_paid")
    )
    return t.installment.select("installment_id", "amount_due").join(paid, "installment_id", "left")


# -- aggregates -----------------------------------------------------------------
@query
def agg_counts(t):
    loans = t.loan.groupBy("application_id").agg(F.count(F.lit(1)).alias("n"))
    copies = F.coalesce("n", F.lit(1))
    return (
        t.application.join(loans, "application_id", "left")
        .groupBy("channel")
        .agg(
            F.sum(copies).alias("applications"),
            F.coalesce(F.sum(F.when(F.col("campaign_id").isNotNull(), copies)), F.lit(0)).alias(
                "with_campaign"
            ),
            F.coalesce(F.sum("n"), F.lit(0)).alias("loans"),
        )
    )


@query
def agg_distinct(t):
    return t.marketing_touch.groupBy("channel").agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("campaign_id").alias("campaigns"),
        F.count_distinct("touch_id").alias("touches"),
    )


@query
def agg_filtered(t):
    return t.application.groupBy("channel").agg(
        F.count_if(F.col("decision") == "approved").alias("approvals"),
        F.count_if("offer_accepted").alias("accepted"),
    )


@query
def agg_distinct_filtered(t):
    customer = F.col("customer_id")
    return t.marketing_touch.groupBy("campaign_id").agg(
        F.count_distinct(F.when(F.col("opened"), customer)).alias("openers"),
        F.count_distinct(F.when(F.col("clicked"), customer)).alias("clickers"),
    )


@query
def agg_sum_filtered(t):
    known = F.col("payment_date") <= F.lit(REPORT_DATE)
    return t.payment.groupBy("payment_status").agg(
        F.sum("amount").cast(MONEY18).alias("amount"),
        F.sum(F.when(known, F.col("amount"))).cast(MONEY18).alias("amount_by_date"),
        F.sum(F.when(known, F.col("principal_paid"))).cast(MONEY18).alias("principal_by_date"),
    )


@query
def agg_ratios(t):
    counts = t.application.groupBy("product_code", "channel").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("decision") == "approved").alias("approvals"),
        F.count_if("offer_accepted").alias("accepted"),
    )
    return counts.selectExpr(
        "product_code",
        "channel",
        f"{C.ratio('approvals', 'n')} AS approval_rate",
        f"{C.ratio('accepted', 'approvals')} AS acceptance_rate",
    )


# -- checks ---------------------------------------------------------------------
def _check(name, check):
    def run(t):
        return check(t.with_defects(), REPORT_DATE)

    run.__name__ = f"dq_{name}"
    query(run)


_check("orphan_applications", quality.check_orphan_applications)
_check("orphan_loans", quality.check_orphan_loans)
_check("orphan_payments", quality.check_orphan_payments)
_check("negative_amounts", quality.check_negative_amounts)
_check("schedule_reconciliation", quality.check_schedule_reconciliation)


@query
def dq_volume_spike(t):
    return quality.volume_spikes(t.application, LOOKBACK, "1.3")


@query
def dq_all(t):
    return quality.all_checks(t.with_defects(), REPORT_DATE)


@query
def dq_gate(t):
    return quality.gate(dq_all(t))


# -- reports over published marts -------------------------------------------------
@query
def latest_report_date(t):
    return reports.latest_report_date(t.published("credit", "portfolio"))


@query
def report_overview(t):
    return reports.report_overview(t.published("credit", "portfolio"))


@query
def report_overview_empty(t):
    """The overview of a day before the first event."""
    return reports.report_overview(t.published("credit", "portfolio"), date(1990, 1, 1))


@query
def report_acquisition_trend(t):
    return reports.report_acquisition_trend(t.published("credit"))


@query
def report_outstanding_by_grade(t):
    return reports.report_outstanding_by_grade(t.published("credit", "portfolio"))


@query
def report_funnel(t):
    return reports.report_funnel(t.published("credit"), REPORT_DATE - timedelta(days=1))


@query
def report_portfolio_trend(t):
    return reports.report_portfolio_trend(t.published("portfolio"))


@query
def report_vintage_heatmap(t):
    """The heat-map's cells, one row each, so that no month on book is left out."""
    return reports.report_vintage_rates(t.published("credit", "portfolio", "vintage"))


@query
def report_vintage_wide(t):
    """The heat-map with a column for each month on book up to the highest."""
    return reports.report_vintage_heatmap(t.published("credit", "portfolio", "vintage"))


@query
def report_campaign_summary(t):
    return reports.report_campaign_summary(t.published("credit", "portfolio", "campaign"))


@query
def report_dq_top100(t):
    return reports.report_dq_list(t.dq_summary())


@query
def report_dq_failed(t):
    return reports.report_dq_failed(t.dq_summary(), t.published("credit", "portfolio"))


# -- appended row sets -------------------------------------------------------------
@query
def union_state(t):
    columns = ["customer_id", "risk_score", "risk_grade"]
    joined_on = F.lit("1995-12-01").cast("date")
    older = t.customer.filter(F.col("signup_date") < joined_on).select(*columns)
    newer = t.customer.filter(F.col("signup_date") >= joined_on).select(*columns)
    return older.withColumn("is_new", F.lit(False)).unionByName(
        newer.withColumn("is_new", F.lit(True))
    )


# -- functions ---------------------------------------------------------------------
@query
def fn_date_between(t):
    day = F.lit(REPORT_DATE)
    return t.marketing_touch.filter(F.col("touch_date").between(F.date_sub(day, 30), day)).select(
        "touch_id", "touch_date"
    )


@query
def fn_date_arith(t):
    return t.marketing_touch.select(
        "touch_id",
        F.date_add("touch_date", 7).alias("window_end"),
        F.date_sub("touch_date", 30).alias("window_start"),
    )


@query
def fn_days_past_due(t):
    late = C.days_past_due(F.lit(REPORT_DATE), F.col("due_date"))
    return t.installment.select("installment_id", late.alias("days_past_due"))


@query
def fn_month_trunc(t):
    return t.loan.select(
        "loan_id", C.month_start(F.col("disbursement_date")).alias("origination_month")
    )


@query
def fn_months_on_book(t):
    day = F.lit(REPORT_DATE)
    return t.loan.filter(F.col("disbursement_date") <= day).select(
        "loan_id", C.months_on_book(day, F.col("disbursement_date")).alias("months_on_book")
    )


@query
def fn_greatest_least(t):
    paid = t.payment.select("installment_id", "amount", "principal_paid")
    left = F.greatest(
        F.col("scheduled_principal") - F.coalesce("principal_paid", F.lit(0)), F.lit(0)
    )
    return t.installment.join(paid, "installment_id", "left").select(
        "installment_id",
        left.cast("decimal(14,2)").alias("remaining"),
        F.least("amount", "amount_due").alias("capped_paid"),
    )


@query
def fn_event_ids(t):
    return event_table(t.spark, t.sf_dir, "application").select(
        "application_id",
        C.event_id("application", F.col("application_id"), F.col("event_version")).alias(
            "event_id"
        ),
        C.batch_id(F.col("application_date")).alias("batch_id"),
    )


@query
def fn_campaign_id(t):
    return t.marketing_touch.select(
        "touch_id", C.campaign_id(F.col("touch_date"), F.col("channel")).alias("campaign_id")
    )


@query
def fn_ingested_at(t):
    stamp = C.utc_midnight(F.col("payment_date"), F.col("payment_id") % 48)
    stamped = event_table(t.spark, t.sf_dir, "payment").withColumn("ingested_at", stamp)
    return stamped.selectExpr(
        "payment_id", "event_version", f"{C.utc_text('ingested_at')} AS ingested_at"
    )


@query
def risk_grade_band(t):
    return event_table(t.spark, t.sf_dir, "customer").select(
        "customer_id",
        "event_version",
        "risk_score",
        C.risk_band(F.col("risk_score")).alias("grade"),
    )


def _scored(t):
    customers = t.customer.select(
        "customer_id", "risk_score", "existing_debt", "monthly_income"
    )
    ratio = C.dti(F.col("existing_debt"), F.col("requested_amount"), F.col("monthly_income"))
    return (
        t.application.select("application_id", "customer_id", "requested_amount")
        .join(customers, "customer_id")
        .withColumn("dti", ratio)
    )


@query
def dti(t):
    return _scored(t).select("application_id", F.round("dti", 6).alias("dti"))


@query
def approval_score(t):
    score = C.approval_probability(F.col("risk_score"), F.col("dti"))
    return _scored(t).select("application_id", F.round(score, 6).alias("probability"))


@query
def hash_bucket(t):
    bucket = C.hash_bucket(F.col("installment_id"), F.lit("payment"), buckets=10_000)
    return t.installment.select("installment_id", bucket.alias("bucket"))


@query
def fn_clip(t):
    clipped = C.clip(F.col("requested_amount"), 5000, 150000).cast(MONEY)
    return t.application.select("application_id", clipped.alias("clipped"))


@query
def touched_flag(t):
    touched = t.marketing_touch.select("customer_id", F.lit(True).alias("touched")).distinct()
    return t.customer.select("customer_id").join(touched, "customer_id", "left").select(
        "customer_id", F.coalesce("touched", F.lit(False)).alias("touched")
    )


@query
def calendar_flags(t):
    weekend, month_end = C.calendar_flags(F.col("o_orderdate").cast("date"))
    return read(t.spark, t.sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        weekend.alias("is_weekend"),
        month_end.alias("is_month_end"),
    )


# -- schedules ----------------------------------------------------------------------
@query
def amortization_schedule(t):
    return schedule.amortization_schedule(t.loan)


@query
def payment_allocation(t):
    fraction = ((50 + F.col("installment_id") % 51) / F.lit(100)).cast("decimal(5,4)")
    return schedule.allocate_payment(
        t.installment.withColumn("fraction", fraction), "fraction"
    ).select("installment_id", "amount", "principal_paid", "interest_paid", "payment_status")


@query
def schedule_totals(t):
    return schedule.schedule_totals(t.installment)


# -- streaming ----------------------------------------------------------------------
@query
def stream_ingest(t):
    """All events arrive twice as a stream; each is stored once."""
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    )

    def arrivals():
        return streams.event_stream(
            t.spark, t.sf_dir, schema, pathGlobFilter="events.parquet"
        ).select(
            F.concat(F.lit("event:"), F.col("event_id").cast("string")).alias("source_event_id"),
            F.col("ts").cast("timestamp").alias("ingested_at"),
            "user_id",
            "event_type",
            "value",
        )

    out = _folder(t, "stream_ingest")
    arriving = arrivals().unionByName(arrivals())
    handle = streams.append_unseen(f"{out}/sink", arriving.schema)
    streams.run_available(arriving, handle, f"{out}/checkpoint")
    return t.spark.read.parquet(f"{out}/sink").drop("ingested_at")


@query
def stream_keyed_ingest(t):
    """All events land, are streamed in, land again and add nothing; the stream's state knows their ids."""
    out = _folder(t, "stream_keyed_ingest")
    events = read(t.spark, t.sf_dir, "events").select(
        F.concat(F.lit("event:"), F.col("event_id").cast("string")).alias("source_event_id"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
        "user_id",
        "event_type",
        "value",
    )
    for _ in range(2):
        events.write.mode("append").parquet(f"{out}/landing")
        keyed.stream_unseen(
            t.spark, f"{out}/landing", events.schema, f"{out}/sink", f"{out}/checkpoint"
        )
    return t.spark.read.parquet(f"{out}/sink").drop("ingested_at")


@query
def stream_refresh(t):
    """A root holds loans, schedules and first payment versions; all payments stream in.

    Every micro-batch goes through the job's load and refreshes the look-back.
    """
    root = _folder(t, "stream_refresh")
    payments = event_table(t.spark, t.sf_dir, "payment")
    # a load stores its batch itself, so these aren't stored before
    stored = {n: events(t.spark, t.sf_dir, n) for n in ("loan", "installment")}
    jobs.load_events(t.spark, root, {**stored, "payment": payments.filter("event_version = 1")})
    landing = storage.table_path(t.spark, t.sf_dir, "raw_payment")
    stream = streams.event_stream(t.spark, landing, payments.schema)
    handle = streams.refresh_batch(root, "payment", LOOKBACK, ("daily_portfolio_kpi",))
    streams.run_available(stream, handle, f"{root}/checkpoint")
    return jobs.mart_table(t.spark, root, "daily_portfolio_kpi")


@query
def late_affected_dates(t):
    return ingest.late_affected_dates(
        events(t.spark, t.sf_dir, "payment"), "payment_date"
    )

"""Declared schemas of the event, audit and mart tables."""

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
MART_MONEY = T.DecimalType(16, 2)
RATE = T.DecimalType(8, 5)
RATIO = T.DecimalType(10, 6)
OBSERVED = T.DecimalType(38, 6)

_STR, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_BOOL, _DATE, _TS = T.BooleanType(), T.DateType(), T.TimestampType()


def _struct(fields, nullable=()):
    return T.StructType(
        [T.StructField(name, kind, name in nullable) for name, kind in fields]
    )


ENVELOPE = [
    ("source_event_id", _STR),
    ("event_version", _INT),
    ("event_time", _TS),
    ("ingested_at", _TS),
    ("batch_id", _STR),
]

EVENTS = {
    "customer": _struct(
        ENVELOPE
        + [
            ("customer_id", _LONG),
            ("signup_date", _DATE),
            ("region", _STR),
            ("acquisition_channel", _STR),
            ("monthly_income", MONEY),
            ("existing_debt", MONEY),
            ("employment_tenure_months", _INT),
            ("risk_score", _INT),
            ("risk_grade", _STR),
        ]
    ),
    "marketing_touch": _struct(
        ENVELOPE
        + [
            ("touch_id", _LONG),
            ("customer_id", _LONG),
            ("campaign_id", _STR),
            ("channel", _STR),
            ("touch_date", _DATE),
            ("opened", _BOOL),
            ("clicked", _BOOL),
        ]
    ),
    "application": _struct(
        ENVELOPE
        + [
            ("application_id", _LONG),
            ("customer_id", _LONG),
            ("application_date", _DATE),
            ("product_code", _STR),
            ("channel", _STR),
            ("campaign_id", _STR),
            ("requested_amount", MONEY),
            ("decision", _STR),
            ("decision_date", _DATE),
            ("offer_accepted", _BOOL),
            ("accepted_date", _DATE),
        ],
        nullable=("campaign_id", "accepted_date"),
    ),
    "loan": _struct(
        ENVELOPE
        + [
            ("loan_id", _LONG),
            ("application_id", _LONG),
            ("customer_id", _LONG),
            ("disbursement_date", _DATE),
            ("principal", MONEY),
            ("term_months", _INT),
            ("annual_rate", RATE),
            ("risk_grade", _STR),
            ("status", _STR),
        ]
    ),
    "installment": _struct(
        ENVELOPE
        + [
            ("installment_id", _LONG),
            ("loan_id", _LONG),
            ("installment_no", _INT),
            ("due_date", _DATE),
            ("scheduled_principal", MONEY),
            ("scheduled_interest", MONEY),
            ("amount_due", MONEY),
        ]
    ),
    "payment": _struct(
        ENVELOPE
        + [
            ("payment_id", _LONG),
            ("loan_id", _LONG),
            ("installment_id", _LONG),
            ("payment_date", _DATE),
            ("amount", MONEY),
            ("principal_paid", MONEY),
            ("interest_paid", MONEY),
            ("payment_status", _STR),
        ]
    ),
}

# Business key of each event table, parents first.
KEYS = {
    "customer": "customer_id",
    "marketing_touch": "touch_id",
    "application": "application_id",
    "loan": "loan_id",
    "installment": "installment_id",
    "payment": "payment_id",
}

RUN_LOG = _struct(
    [
        ("run_date", _DATE),
        ("status", _STR),
        ("batch_id", _STR),
        ("started_at", _TS),
        ("finished_at", _TS),
        ("rows_loaded", _INT),
        ("rows_rejected", _INT),
        ("error_message", _STR),
    ],
    nullable=("batch_id", "finished_at", "error_message"),
)
QUALITY_RESULTS = _struct(
    [
        ("run_date", _DATE),
        ("check_name", _STR),
        ("severity", _STR),
        ("status", _STR),
        ("observed_value", OBSERVED),
        ("details", _STR),
        ("checked_at", _TS),
    ],
    nullable=("observed_value", "details"),
)
REJECTED_EVENTS = _struct(
    [
        ("run_date", _DATE),
        ("source_event_id", _STR),
        ("reason", _STR),
        ("payload", _STR),
        ("rejected_at", _TS),
    ],
    nullable=("payload",),
)
AUDIT = {
    "pipeline_runs": RUN_LOG,
    "quality_results": QUALITY_RESULTS,
    "rejected_events": REJECTED_EVENTS,
}

MARTS = {
    "daily_credit_kpi": _struct(
        [
            ("report_date", _DATE),
            ("channel", _STR),
            ("product_code", _STR),
            ("risk_grade", _STR),
            ("unique_applicants", _INT),
            ("applications", _INT),
            ("approvals", _INT),
            ("accepted", _INT),
            ("funded_count", _INT),
            ("requested_amount", MART_MONEY),
            ("funded_amount", MART_MONEY),
            ("approval_rate", RATIO),
            ("acceptance_rate", RATIO),
        ],
        nullable=("approval_rate", "acceptance_rate"),
    ),
    "daily_portfolio_kpi": _struct(
        [
            ("report_date", _DATE),
            ("risk_grade", _STR),
            ("active_loans", _INT),
            ("outstanding_principal", MART_MONEY),
            ("amount_due", MART_MONEY),
            ("amount_paid", MART_MONEY),
            ("collection_rate", RATIO),
            ("dpd_1_balance", MART_MONEY),
            ("dpd_7_balance", MART_MONEY),
            ("dpd_30_balance", MART_MONEY),
            ("dpd_90_balance", MART_MONEY),
        ],
        nullable=("collection_rate",),
    ),
    "daily_campaign_kpi": _struct(
        [
            ("report_date", _DATE),
            ("touch_date", _DATE),
            ("campaign_id", _STR),
            ("channel", _STR),
            ("touches", _INT),
            ("opens", _INT),
            ("clicks", _INT),
            ("applications", _INT),
            ("funded_count", _INT),
            ("funded_amount", MART_MONEY),
        ]
    ),
    "vintage_kpi": _struct(
        [
            ("report_date", _DATE),
            ("origination_month", _DATE),
            ("months_on_book", _INT),
            ("active_loans", _INT),
            ("outstanding_principal", MART_MONEY),
            ("dpd_30_balance", MART_MONEY),
            ("dpd_30_rate", RATIO),
        ],
        nullable=("dpd_30_rate",),
    ),
}
DQ_SUMMARY = _struct(
    [
        ("report_date", _DATE),
        ("check_name", _STR),
        ("severity", _STR),
        ("status", _STR),
        ("observed_value", OBSERVED),
        ("details", _STR),
    ],
    nullable=("observed_value", "details"),
)


def conform(df, schema):
    """Project ``df`` onto ``schema``: its column order and its types."""
    return df.selectExpr(
        *[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema]
    )

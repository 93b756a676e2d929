import os
import sys
from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.schemas import EVENTS, KEYS  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    yield session
    session.stop()


DEFAULTS = {
    "customer": dict(
        signup_date=date(2026, 1, 1), region="Kowloon", acquisition_channel="organic",
        monthly_income=20000, existing_debt=1000, employment_tenure_months=12,
        risk_score=650, risk_grade="C",
    ),
    "marketing_touch": dict(
        customer_id=1, campaign_id="CAMP", channel="sms", touch_date=date(2026, 1, 1),
        opened=False, clicked=False,
    ),
    "application": dict(
        customer_id=1, application_date=date(2026, 1, 1), product_code="personal_installment",
        channel="organic", campaign_id=None, requested_amount=1000, decision="approved",
        decision_date=date(2026, 1, 1), offer_accepted=True, accepted_date=None,
    ),
    "loan": dict(
        application_id=1, customer_id=1, disbursement_date=date(2026, 1, 1), principal=1000,
        term_months=12, annual_rate=Decimal("0.12"), risk_grade="C", status="active",
    ),
    "installment": dict(
        loan_id=1, installment_no=1, due_date=date(2026, 2, 1), scheduled_principal=100,
        scheduled_interest=10, amount_due=110,
    ),
    "payment": dict(
        loan_id=1, installment_id=1, payment_date=date(2026, 2, 1), amount=110,
        principal_paid=100, interest_paid=10, payment_status="paid",
    ),
}


@pytest.fixture(scope="session")
def make(spark):
    """Event frame of ``table`` from partial rows; missing columns take defaults."""

    def build(table, *rows):
        full = []
        for number, row in enumerate(rows, start=1):
            version = row.get("event_version", 1)
            day = datetime(2026, 1, version, tzinfo=UTC)
            key = row.get(KEYS[table], number)
            values = {
                KEYS[table]: number,
                "source_event_id": f"{table}:{key}:v{version}",
                "event_version": version,
                "event_time": day,
                "ingested_at": day,
                "batch_id": "batch:2026-01-01",
                **DEFAULTS[table],
                **row,
            }
            full.append(
                tuple(
                    Decimal(str(values[f.name])).quantize(Decimal(1).scaleb(-f.dataType.scale))
                    if f.dataType.typeName() == "decimal"
                    else values[f.name]
                    for f in EVENTS[table]
                )
            )
        return spark.createDataFrame(full, EVENTS[table])

    return build


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)

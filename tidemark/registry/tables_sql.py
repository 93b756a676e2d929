"""SQL for the derived lending tables, as named common table expressions."""

# Report date and first date of the look-back.
D = "DATE '1998-06-30'"
START = "DATE '1998-05-16'"


def _pick(values, number):
    branches = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({number}) % {len(values)} {branches} END"


_CHANNELS = ["organic", "paid_search", "referral", "partner", "sms"]
_REGIONS = ["Hong_Kong_Island", "Kowloon", "New_Territories"]
_M = "DECIMAL(12,2)"


def grade(score):
    return (
        f"CASE WHEN {score} >= 760 THEN 'A' WHEN {score} >= 700 THEN 'B' "
        f"WHEN {score} >= 640 THEN 'C' WHEN {score} >= 580 THEN 'D' ELSE 'E' END"
    )


def _envelope(table, key, day, version):
    return (
        f"'{table}:' || {key} || ':v' || {version} AS source_event_id, "
        f"{version} AS event_version, CAST({day} AS TIMESTAMP) AS event_time, "
        f"CAST({day} AS TIMESTAMP) + INTERVAL 1 DAY * ({version} - 1) AS ingested_at, "
        f"'batch:' || strftime({day}, '%Y-%m-%d') AS batch_id"
    )


def _versions(table, key, day, rows, corrected, wrong):
    version = f"(CASE WHEN {corrected} THEN 2 ELSE 1 END)"
    changed = ", ".join(f"{expr} AS {col}" for col, expr in wrong.items())
    return (
        f"SELECT {_envelope(table, key, day, version)}, r.* FROM {rows} r "
        f"UNION ALL BY NAME SELECT {_envelope(table, key, day, '1')}, "
        f"r.* REPLACE ({changed}) FROM {rows} r WHERE {corrected}"
    )


def _latest(events, key):
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT e.*, ROW_NUMBER() OVER (PARTITION BY {key} "
        f"ORDER BY event_version DESC, ingested_at DESC, source_event_id DESC) AS rn "
        f"FROM {events} e) WHERE rn = 1"
    )


_SCORE1 = "(350 + (k * 37) % 501)"
_SCORE2 = "(350 + (k * 91 + 17) % 501)"
_CUSTOMER = (
    "k AS customer_id, day AS signup_date, "
    f"{_pick(_REGIONS, 'k')} AS region, {_pick(_CHANNELS, 'k')} AS acquisition_channel, "
    f"CAST(6000 + abs(balance) AS {_M}) AS monthly_income, "
    f"CAST(abs(balance) * CAST(0.5 AS DECIMAL(2,1)) AS {_M}) AS existing_debt, "
    "CAST(6 + k % 175 AS INTEGER) AS employment_tenure_months"
)

TABLES = {
    "base_customer": (
        [],
        "SELECT c_custkey AS k, CAST(c_acctbal AS DECIMAL(12,2)) AS balance, "
        "DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS day FROM customer",
    ),
    "customer_events": (
        ["base_customer"],
        f"SELECT {_envelope('customer', 'k', 'day', '1')}, {_CUSTOMER}, "
        f"CAST({_SCORE1} AS INTEGER) AS risk_score, {grade(_SCORE1)} AS risk_grade "
        "FROM base_customer "
        f"UNION ALL BY NAME SELECT {_envelope('customer', 'k', 'day', '2')}, {_CUSTOMER}, "
        f"CAST({_SCORE2} AS INTEGER) AS risk_score, {grade(_SCORE2)} AS risk_grade "
        "FROM base_customer WHERE k % 10 = 0",
    ),
    "base_order": (
        [],
        "SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS status, "
        f"CAST(o_totalprice AS {_M}) AS amount, CAST(o_orderdate AS DATE) AS day, "
        "'CAMP-' || year(o_orderdate) || '-' || (o_orderkey % 5) AS campaign FROM orders",
    ),
    "application_rows": (
        ["base_order"],
        "SELECT k AS application_id, c AS customer_id, day AS application_date, "
        f"'personal_installment' AS product_code, {_pick(_CHANNELS, 'k')} AS channel, "
        "CASE WHEN k % 3 <> 0 THEN campaign END AS campaign_id, amount AS requested_amount, "
        "CASE WHEN status IN ('F', 'O') THEN 'approved' ELSE 'rejected' END AS decision, "
        "day AS decision_date, status = 'F' AS offer_accepted, "
        "CASE WHEN status = 'F' THEN day END AS accepted_date FROM base_order",
    ),
    "application_events": (
        ["application_rows"],
        _versions(
            "application", "application_id", "application_date", "application_rows",
            "application_id % 10 = 3",
            {
                "requested_amount": f"CAST(requested_amount * 2 AS {_M})",
                "decision": "'rejected'",
                "offer_accepted": "FALSE",
                "accepted_date": "CAST(NULL AS DATE)",
            },
        ),
    ),
    "touch_rows": (
        ["base_order"],
        "SELECT k * 10 + 2 AS touch_id, c AS customer_id, campaign AS campaign_id, "
        f"{_pick(_CHANNELS, 'k')} AS channel, day - CAST(k % 11 AS INTEGER) AS touch_date, "
        "k % 3 <> 0 AS opened, k % 7 = 0 AS clicked FROM base_order",
    ),
    "marketing_touch_events": (
        ["touch_rows"],
        _versions(
            "marketing_touch", "touch_id", "touch_date", "touch_rows", "touch_id % 100 = 32",
            {"opened": "NOT opened", "clicked": "FALSE"},
        ),
    ),
    "loan_rows": (
        ["base_order"],
        "SELECT k * 10 + 1 AS loan_id, k AS application_id, c AS customer_id, "
        "day + CAST(k % 3 AS INTEGER) AS disbursement_date, "
        f"CAST(total + CASE WHEN k % 10 = 9 THEN 0.05 ELSE 0 END AS {_M}) AS principal, "
        "CAST([6, 12, 24, 36][k % 4 + 1] AS INTEGER) AS term_months, "
        "CAST(CAST(6 + k % 25 AS DECIMAL(8,0)) / 100 AS DECIMAL(8,5)) AS annual_rate, "
        f"{grade('score')} AS risk_grade, 'active' AS status FROM ("
        "SELECT *, CASE WHEN c % 10 = 0 THEN 350 + (c * 91 + 17) % 501 "
        "ELSE 350 + (c * 37) % 501 END AS score FROM base_order "
        f"JOIN (SELECT l_orderkey, SUM(CAST(l_extendedprice AS {_M})) AS total "
        "FROM lineitem GROUP BY l_orderkey) ON l_orderkey = k "
        "WHERE status = 'F')",
    ),
    "loan_events": (
        ["loan_rows"],
        _versions(
            "loan", "loan_id", "disbursement_date", "loan_rows", "loan_id % 100 = 31",
            {"principal": f"CAST(principal + 1000 AS {_M})"},
        ),
    ),
    "numbered_lines": (
        ["loan_rows"],
        "SELECT loan_id * 100 + no AS installment_id, loan_id, CAST(no AS INTEGER) AS "
        "installment_no, disbursement_date + CAST(30 * no AS INTEGER) AS due_date, "
        f"price AS scheduled_principal, CAST(price * CAST(0.01 AS DECIMAL(3,2)) AS {_M}) AS "
        f"scheduled_interest, CAST(price + CAST(price * CAST(0.01 AS DECIMAL(3,2)) AS {_M}) "
        f"AS {_M}) AS amount_due, l_returnflag, l_partkey FROM ("
        f"SELECT *, CAST(l_extendedprice AS {_M}) AS price, ROW_NUMBER() OVER ("
        "PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, "
        "l_extendedprice) AS no FROM lineitem) JOIN loan_rows ON application_id = l_orderkey",
    ),
    "installment_rows": (
        ["numbered_lines"],
        "SELECT * EXCLUDE (l_returnflag, l_partkey) FROM numbered_lines",
    ),
    "installment_events": (
        ["installment_rows"],
        _versions(
            "installment", "installment_id", "due_date", "installment_rows",
            "installment_id % 10 = 3",
            {
                "scheduled_principal": f"CAST(scheduled_principal + 10 AS {_M})",
                "amount_due": f"CAST(amount_due + 10 AS {_M})",
            },
        ),
    ),
    "payment_rows": (
        ["numbered_lines"],
        "SELECT *, CAST(amount - principal_paid AS DECIMAL(12,2)) AS interest_paid FROM ("
        "SELECT installment_id * 10 + 1 AS payment_id, loan_id, installment_id, "
        "CASE l_returnflag WHEN 'N' THEN due_date "
        "ELSE due_date + CAST(1 + l_partkey % 30 AS INTEGER) END AS payment_date, "
        f"CAST(amount_due * share AS {_M}) AS amount, "
        f"CAST(scheduled_principal * share AS {_M}) AS principal_paid, "
        "CASE l_returnflag WHEN 'N' THEN 'paid' ELSE 'partial' END AS payment_status FROM ("
        "SELECT *, CAST(CASE l_returnflag WHEN 'N' THEN 1.0 ELSE 0.5 END AS DECIMAL(2,1)) "
        "AS share FROM numbered_lines WHERE l_returnflag IN ('N', 'A')))",
    ),
    "payment_events": (
        ["payment_rows"],
        _versions(
            "payment", "payment_id", "payment_date", "payment_rows", "payment_id % 100 = 31",
            {
                "amount": f"CAST(amount + 1 AS {_M})",
                "interest_paid": f"CAST(interest_paid + 1 AS {_M})",
            },
        ),
    ),
    "customer_latest": (["customer_events"], _latest("customer_events", "customer_id")),
    "marketing_touch_latest": (
        ["marketing_touch_events"],
        _latest("marketing_touch_events", "touch_id"),
    ),
    "application_latest": (
        ["application_events"],
        _latest("application_events", "application_id"),
    ),
    "loan_latest": (["loan_events"], _latest("loan_events", "loan_id")),
    "installment_latest": (
        ["installment_events"],
        _latest("installment_events", "installment_id"),
    ),
    "payment_latest": (["payment_events"], _latest("payment_events", "payment_id")),
}


def query(body: str, *needed: str, extra: dict | None = None) -> str:
    """``body`` preceded by the CTEs it needs; ``extra`` adds (needed, sql) entries."""
    known = {**TABLES, **(extra or {})}
    ordered: list[str] = []

    def visit(name):
        if name in ordered:
            return
        for parent in known[name][0]:
            visit(parent)
        ordered.append(name)

    for name in needed:
        visit(name)
    ctes = ", ".join(f"{name} AS ({known[name][1]})" for name in ordered)
    return f"WITH {ctes} {body}" if ctes else body

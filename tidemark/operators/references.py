"""The reference checks kept up by counts instead of joins over all rows.

For each check and parent key the counts say how many children name the key, how many
parents have it, how many of these break the rule, and what is owed less what is scheduled.
A changed row takes back the counts of the version it replaces and adds its own, so a check's
value changes by what its changed keys give after and before, and no other key is looked at.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import cents
from tidemark.sources.signed import Signed

COUNTS = Signed(
    "counts/references",
    ("check_name string", "key long"),
    ("children", "parents", "broken", "owed"),
    bucketed=True,
)

#: table -> (check, key, what one row counts).
_COUNTED = {
    "customer": [("orphan_applications", "customer_id", {"parents": "1"})],
    "application": [
        ("orphan_applications", "customer_id", {"children": "1"}),
        (
            "orphan_loans",
            "application_id",
            {
                "parents": "1",
                # an unknown decision of an accepted application is not counted
                "broken": "coalesce(decision <> 'approved' OR NOT offer_accepted, false)",
            },
        ),
        ("negative_amounts", "0", {"broken": "coalesce(requested_amount < 0, false)"}),
    ],
    "loan": [
        ("orphan_loans", "application_id", {"children": "1"}),
        ("schedule_reconciliation", "loan_id", {"parents": "1", "owed": cents("principal")}),
    ],
    "installment": [
        ("orphan_payments", "installment_id", {"parents": "1"}),
        (
            "schedule_reconciliation",
            "loan_id",
            {"children": "1", "owed": f"-{cents('scheduled_principal')}"},
        ),
    ],
    "payment": [
        ("orphan_payments", "installment_id", {"children": "1"}),
        (
            "negative_amounts",
            "0",
            {"broken": "coalesce(amount < 0 OR principal_paid < 0 OR interest_paid < 0, false)"},
        ),
    ],
}
CHECKED = ("orphan_applications", "orphan_loans", "orphan_payments", "negative_amounts", "schedule_reconciliation")

# More than two cents between a loan's principal and its schedule, if it has both.
_VALUE = """CASE check_name
    WHEN 'negative_amounts' THEN broken
    WHEN 'schedule_reconciliation' THEN
        IF(parents > 0 AND children > 0 AND abs(owed) > 2, parents, 0L)
    ELSE IF(parents = 0 OR broken > 0, children, 0L) END"""


def counted(images: dict[str, DataFrame]) -> DataFrame | None:
    """Signed counts of changed rows, which carry their ``sign``; None if no table has any."""
    found = [
        images[table].selectExpr(
            f"'{check}' AS check_name",
            f"CAST({key} AS BIGINT) AS key",
            *[f"sign * CAST({values.get(m, '0')} AS BIGINT) AS {m}" for m in COUNTS.measures],
        )
        for table, rules in _COUNTED.items()
        if table in images
        for check, key, values in rules
    ]
    return COUNTS.totals(reduce(DataFrame.unionAll, found)) if found else None


def value_changes(stored: DataFrame, changes: DataFrame) -> dict[str, int]:
    """By how much each check's value changes when ``changes`` are added to the stored counts.

    ``stored`` must hold every row of the changed keys; others are left out by a semi join.
    """
    names = COUNTS.key_names
    before = COUNTS.totals(stored.join(changes.select(names), names, "left_semi"))
    after = COUNTS.totals(before.unionByName(changes))
    signed = after.selectExpr("check_name", f"{_VALUE} AS n").unionAll(
        before.selectExpr("check_name", f"-({_VALUE}) AS n")
    )
    return {r["check_name"]: r["n"] for r in signed.groupBy("check_name").agg(F.sum("n").alias("n")).collect()}

"""Loan schedules and payment splits, exact to the cent."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import cents, from_cents, installment_due_date
from tidemark.schemas import MONEY

def _interest(balance: str) -> str:
    """SQL: a month's interest on ``balance`` cents, half a cent rounded away from zero.

    Whole-number arithmetic: the yearly rate counts hundred-thousandths, so a month
    is balance * rate / 1,200,000. ANSI mode raises if a product leaves the long range.
    """
    rounded = f"(abs({balance}) * rate * 2 + 1200000) DIV 2400000"
    return f"IF({balance} < 0, -({rounded}), {rounded})"


def amortization_schedule(loans: DataFrame) -> DataFrame:
    """Installment rows of each loan; the last row takes the remaining balance.

    The payment is that of an annuity, or principal / term at a zero rate. A narrow
    transformation: the balances before each period are carried through the loan's
    own terms, everything else follows from them row by row.
    """
    priced = loans.selectExpr(
        "loan_id",
        "disbursement_date",
        "term_months",
        f"{cents('principal')} AS principal",
        "CAST(annual_rate * 100000 AS BIGINT) AS rate",
        """CAST(round(CAST(CASE WHEN annual_rate = 0 THEN CAST(principal AS DOUBLE) / term_months
            ELSE CAST(principal AS DOUBLE) * (CAST(annual_rate AS DOUBLE) / 12)
              / (1D - pow(1D + CAST(annual_rate AS DOUBLE) / 12, -term_months))
            END AS DECIMAL(18,8)), 2) * 100 AS BIGINT) AS payment""",
    )
    last = "element_at(balances, -1)"
    balances = priced.selectExpr(
        "*",
        f"""posexplode(aggregate(
            IF(term_months > 1, sequence(2, term_months), CAST(array() AS ARRAY<INT>)),
            array(principal),
            (balances, n) -> concat(balances, array({last} - payment + {_interest(last)}))
        )) AS (period, balance)""",
    )
    rows = balances.selectExpr(
        "loan_id",
        "disbursement_date",
        "period + 1 AS installment_no",
        f"{_interest('balance')} AS interest",
        "balance",
        "payment",
        "period + 1 = term_months AS is_last",
    ).selectExpr(
        "loan_id",
        "disbursement_date",
        "installment_no",
        "interest",
        "IF(is_last, balance, payment - interest) AS part",
    )
    money = lambda c: from_cents(c, precision=12)
    return rows.select(
        (F.col("loan_id") * 100 + F.col("installment_no")).alias("installment_id"),
        "loan_id",
        "installment_no",
        installment_due_date(F.col("disbursement_date"), F.col("installment_no")).alias("due_date"),
        F.expr(f"{money('part')} AS scheduled_principal"),
        F.expr(f"{money('interest')} AS scheduled_interest"),
        F.expr(f"{money('part + interest')} AS amount_due"),
    )


def allocate_payment(installments: DataFrame, fraction_col: str) -> DataFrame:
    """Split ``amount_due * fraction`` into principal (pro rata) and interest (the rest)."""
    fraction = F.col(fraction_col).cast("decimal(5,4)")
    amount = (F.col("amount_due") * fraction).cast(MONEY)
    share = (F.col("amount") * F.col("scheduled_principal")).cast("decimal(24,4)")
    principal = F.try_divide(share, F.col("amount_due")).cast(MONEY)
    return (
        installments.withColumn("amount", amount)
        .withColumn("principal_paid", principal)
        .withColumn("interest_paid", (F.col("amount") - F.col("principal_paid")).cast(MONEY))
        .withColumn("payment_status", F.when(fraction == 1, "paid").otherwise("partial"))
    )


def schedule_totals(installments: DataFrame) -> DataFrame:
    return installments.groupBy("loan_id").agg(
        F.count(F.lit(1)).alias("installments"),
        F.sum("scheduled_principal").cast("decimal(16,2)").alias("scheduled_principal"),
        F.sum("scheduled_interest").cast("decimal(16,2)").alias("scheduled_interest"),
        F.sum("amount_due").cast("decimal(16,2)").alias("amount_due"),
    )

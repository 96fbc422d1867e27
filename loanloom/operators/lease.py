"""Derived columns of a cleaned lease tape, and its names in loan terms."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import double, month_number, present_value
from . import enrich

KEY, ASSET, BEGIN, END = "securitizationKey", "assetNumber", "reportingPeriodBeginDate", "reportingPeriodEndDate"
B, E = "reportingPeriodSecuritizationValueAmount", "reportingPeriodEndActualSecuritizationAmount"
CO, LIQ, REPURCHASE, PAID = "chargedOffAmount", "liquidationProceedsAmount", "repurchaseAmount", "totalActualAmountPaid"
RATE, TERM, LEFT, PAY = "securitizationDiscountRate", "originalLeaseTermNumber", "remainingTermNumber", "reportingPeriodScheduledPaymentAmount"
OWED = "reportingPeriodEndingActualBalanceAmount"
SENS = 0.01
#: Lease names and the loan names that reports know them by.
TO_LOAN = {
    "chargedOffAmount": "chargedoffPrincipalAmount", "liquidationProceedsAmount": "repossessedProceedsAmount", "reportingPeriodEndingActualBalanceAmount": "reportingPeriodEndingLeaseBalanceAmount",
    "reportingPeriodSecuritizationValueAmount": "reportingPeriodBeginningLoanBalanceAmount", "reportingPeriodEndActualSecuritizationAmount": "reportingPeriodActualEndBalanceAmount",
    "coLesseePresentIndicator": "coObligorIndicator", "paidThroughDate": "interestPaidThroughDate", "reportingPeriodBeginDate": "reportingPeriodBeginningDate", "reportingPeriodEndDate": "reportingPeriodEndingDate",
    "scheduledTerminationDate": "loanMaturityDate", "gracePeriod": "gracePeriodNumber", "lesseeCreditScore": "obligorCreditScore", "lesseeEmploymentVerificationCode": "obligorEmploymentVerificationCode",
    "lesseeIncomeVerificationLevelCode": "obligorIncomeVerificationLevelCode", "originalLeaseTermNumber": "originalLoanTerm", "remainingTermNumber": "remainingTermToMaturityNumber",
    "lesseeCreditScoreType": "obligorCreditScoreType", "lesseeGeographicLocation": "obligorGeographicLocation", "primaryLeaseServicerName": "primaryLoanServicerName",
}


def _is(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def scheduled_values(df: DataFrame) -> DataFrame:
    """Present values of the payments left and the residual, at the period's begin and end, due at its start."""
    pv = lambda n: present_value(double(RATE) / 12, n, -double(PAY), -double("baseResidualValue"), 1)
    return df.withColumns({"scheduledSecuritizationBeginValueAmount": pv(double(LEFT) + 1), "scheduledSecuritizationEndValueAmount": pv(double(LEFT))})


def reconciled(df: DataFrame) -> DataFrame:
    """Charge-offs and begin values that contradict each other. A row that begins at 0 and ends above it, with payments
    left: a negative charge-off becomes the difference, for a positive one the begin value is made up. A charge-off
    that gives the begin value only together with the proceeds becomes the begin value."""
    b, e, co, liq = double(B), double(E), double(CO), double(LIQ)
    opens = (F.abs(b) < SENS) & (F.abs(e) > SENS) & (double(LEFT) > 0)
    begin = F.when(_is(opens & (co > 0)), F.coalesce(e, F.lit(0.0)) + co).otherwise(b)
    charged = F.when(_is(opens & (co < 0)), b - e).when(_is((co > 0) & (F.abs(b - co - liq) < SENS)), begin).otherwise(co)
    return df.withColumns({B: begin, CO: charged})


def months_delinquent(df: DataFrame) -> DataFrame:
    """Full months past due up to 4; 5 charged off; 6 paid off early: nothing owed before the end of the term, more
    paid than scheduled, and not a day late."""
    days = F.coalesce(double("currentDelinquencyStatus"), F.lit(0.0))
    out = F.when(double(CO) > 0, 5).otherwise(F.least(F.floor(days / 30), F.lit(4)).cast("int"))
    if all(c in df.columns for c in (OWED, LEFT, TERM, PAID, PAY)):
        early = (F.abs(double(OWED)) < SENS) & (double(LEFT) < double(TERM)) & (double(PAID) > double(PAY)) & (days == 0)
        out = F.when(_is(early), 6).otherwise(out)
    return df.withColumn("monthsDelinquent", out)


def recoveries(df: DataFrame) -> DataFrame:
    """``recoveredAmount``: proceeds of charged-off leases, and proceeds that come after a lease of which nothing is left
    was charged off. Those of leases that ended otherwise are paid amounts."""
    liq = double(LIQ)
    nothing = F.abs(sum(F.coalesce(double(c), F.lit(0.0)) for c in (OWED, E) if c in df.columns)) < SENS
    late = lambda code: _is((F.abs(liq) > SENS) & (F.col("zeroBalanceEffectiveDate") < F.col(BEGIN)) & nothing & (F.col("zeroBalanceCode") == code))
    recovered = F.when(_is((double(CO) > 0) & (liq > 0)), liq).otherwise(0.0) + F.when(late(3), liq).otherwise(0.0)
    paid = double(PAID) + F.when(_is(F.col("terminationIndicator").isin(1, 2)) | late(1), liq).otherwise(0.0)
    return df.withColumns({"recoveredAmount": recovered, PAID: paid})


def repeated_proceeds(df: DataFrame) -> DataFrame:
    """Event amounts and codes are 0 on a row whose asset's next row reports the same proceeds again."""
    w = Window.partitionBy(KEY, ASSET).orderBy(BEGIN)
    again = _is((F.abs(double(LIQ)) > SENS) & (F.lead(LIQ).over(w) == F.col(LIQ)))
    out = df.withColumn("_again", again)
    return out.withColumns({c: F.when(F.col("_again"), F.lit(0)).otherwise(F.col(c)) for c in (CO, "recoveredAmount", LIQ, "zeroBalanceCode", "terminationIndicator") if c in df.columns}).drop("_again")


def flows(df: DataFrame) -> DataFrame:
    """Scheduled amortisation and interest, actual principal and interest, the rest, prepayments, sale results."""
    md = F.col("monthsDelinquent")
    step = (double("scheduledSecuritizationBeginValueAmount") - double("scheduledSecuritizationEndValueAmount")) * (F.floor(double("currentDelinquencyStatus") / 30) + 1)
    out = df.withColumns({
        "scheduledSecuritizationValueAmortization": F.when(md < 5, step).otherwise(0.0),
        "scheduledSecuritizationValueInterest": double("scheduledSecuritizationBeginValueAmount") * double(RATE) / 12,
        "actualPrincipalCollectedAmount": double(B) - double(E) - double(CO),
    })
    early = _is((F.abs(double(CO)) < SENS) & (F.abs(double(B)) > SENS) & (F.abs(double(E)) < SENS) & (double(LEFT) > 1))
    prin = F.col("actualPrincipalCollectedAmount")
    out = out.withColumn("principalPrepaid", F.when(early, F.greatest(prin - F.col("scheduledSecuritizationValueAmortization"), F.lit(0.0))).otherwise(0.0))
    out = out.withColumn("actualInterestCollectedAmount", F.least(F.greatest(double(PAID) - prin, F.lit(0.0)), double(B) * double(RATE) / 12))
    ended = _is(F.col("terminationIndicator").isin(1, 2) | F.col("zeroBalanceCode").isin(1, 2))
    return out.withColumns({
        "otherPrincipalAdjustmentAmount": double(PAID) - prin - F.col("actualInterestCollectedAmount"),
        "saleGainOrLoss": F.when(ended, double(LIQ) - double("contractResidualValue")).otherwise(0.0),
    })


def ages(df: DataFrame) -> DataFrame:
    out = enrich.trust_dates(df, BEGIN, END)
    age = double(TERM) - double(LEFT)
    return enrich.cutoff_balance(out.withColumns({"age": age, "ageFromCutoff": age - F.col("monthsFromCutoffDate"), "vintage": F.year("originationDate")}), B)


def loan_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("originalLoanAmount", double(TERM) * double(PAY) + double("contractResidualValue"))


def implied_rates(df: DataFrame, steps: int = 40) -> DataFrame:
    """Annual rate that makes payments and residual worth the cost, paid at the start of months; null where Newton's
    steps do not settle. It is solved once for a lease (again where its terms change), on one of its rows, which stay
    where they are."""
    keys = [TERM, PAY, "acquisitionCost", "contractResidualValue"]
    n, pay, cost, rest = (double(c) for c in keys)

    def value(r: Column) -> Column:
        grow = F.pow(1 + r, n)
        return cost - (pay * (1 + r) * (1 - 1 / grow) / r + rest / grow)

    def step(r: Column, _: Column) -> Column:
        h = F.lit(1e-6)
        slope = (value(r + h) - value(r - h)) / (2 * h)
        return F.least(F.greatest(r - value(r) / F.nullif(slope, F.lit(0.0)), F.lit(-0.5)), F.lit(1.0))

    w = Window.partitionBy(*(c for c in (KEY, ASSET) if c in df.columns), *keys)
    out = df.withColumn("_row", F.row_number().over(w.orderBy(TERM)))  # any row: the terms are the same
    solved = F.when(F.col("_row") == 1, F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0.005), step))
    out = out.withColumn("_r", F.max(solved).over(w))
    rate = F.when(F.abs(value(F.col("_r"))) < 0.01, 12 * F.greatest(F.col("_r"), F.lit(0.0)))
    return out.withColumn("originalInterestRatePercentage", rate).drop("_row", "_r")


def enrich_lease(df: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """All derived columns of a cleaned lease tape."""
    out = repeated_proceeds(recoveries(reconciled(scheduled_values(df))))
    out = ages(flows(months_delinquent(out)))
    out = enrich.loan_to_value(enrich.scores(loan_amount(out), "lesseeCreditScore", "lesseeCreditScoreType"), None, "acquisitionCost")
    out = enrich.net_losses(enrich.prime_indicator(implied_rates(out)), CO, REPURCHASE)
    return enrich.regions(out, states, "lesseeGeographicLocation") if states is not None else out


def as_loans(df: DataFrame) -> DataFrame:
    """Lease columns under their loan names."""
    return df.withColumnsRenamed({a: b for a, b in TO_LOAN.items() if a in df.columns})

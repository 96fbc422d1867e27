"""Derived columns of a cleaned loan tape."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import double, month_number

B, E_ = "reportingPeriodBeginningLoanBalanceAmount", "reportingPeriodActualEndBalanceAmount"
PRIN, CO, REC, REPO, OTHER = "actualPrincipalCollectedAmount", "chargedoffPrincipalAmount", "recoveredAmount", "repossessedProceedsAmount", "otherPrincipalAdjustmentAmount"
SENS = 0.001


def _z(c: str) -> Column:
    return F.coalesce(double(c), F.lit(0.0))


def balances(df: DataFrame, sens: float = SENS) -> DataFrame:
    """Begin balances filled in, repossession proceeds told apart from charge-offs, principal tied out."""
    out = df.withColumn(B, F.coalesce(double(B), _z(E_) + _z(OTHER) + _z(CO) + _z(PRIN)))
    full = F.abs(_z(CO) - F.col(B)) < sens
    recover = F.coalesce(full & (F.abs(_z(REC)) < sens) & (_z(REPO) != 0), F.lit(False))
    split = F.coalesce((F.abs(_z(REPO) + _z(CO) + _z(REC) - F.col(B)) < sens) & ((_z(REPO) != 0) | (_z(CO) != 0) | (_z(REC) != 0)), F.lit(False))
    fresh = {
        REC: F.when(recover | split & (_z(REPO) != 0), _z(REC) + _z(REPO)).otherwise(_z(REC)),
        CO: F.when(split & ~recover, _z(CO) + _z(REPO) + _z(REC)).otherwise(_z(CO)),
        E_: F.when(split & ~recover, F.lit(0.0)).otherwise(double(E_)),
    }
    out = out.withColumns(fresh)
    return out.withColumn(OTHER, _z(OTHER) + (F.col(B) - F.col(E_)) - (double(PRIN) + F.col(CO) + _z(OTHER)))


def trust_dates(df: DataFrame, begin: str = "reportingPeriodBeginningDate", end: str = "reportingPeriodEndingDate") -> DataFrame:
    """``summaryDate`` (1 in the trust's last period) and ``monthsFromCutoffDate``, by a grouped minimum and maximum."""
    spans = df.groupBy("securitizationKey").agg(F.max(end).alias("_last"), F.min(begin).alias("_first"))
    out = df.join(F.broadcast(spans), "securitizationKey", "left")  # a row for each trust
    return out.withColumns({"summaryDate": (F.col(end) == F.col("_last")).cast("int"), "monthsFromCutoffDate": month_number(begin) - month_number("_first")}).drop("_last", "_first")


def ages(df: DataFrame) -> DataFrame:
    age = month_number("reportingPeriodBeginningDate") - month_number("originationDate")
    return df.withColumns({"age": age, "ageFromCutoff": age - F.col("monthsFromCutoffDate"), "vintage": F.year("originationDate")})


def cutoff_balance(df: DataFrame, balance: str = B) -> DataFrame:
    """``beginningBalanceAtCutoffDate``: the asset's begin balance in the trust's first month."""
    w = Window.partitionBy("securitizationKey", "assetNumber")
    return df.withColumn("beginningBalanceAtCutoffDate", F.max(F.when(F.col("monthsFromCutoffDate") == 0, F.col(balance))).over(w))


def scores(df: DataFrame, score: str = "obligorCreditScore", kind: str = "obligorCreditScoreType") -> DataFrame:
    """Score by type, consumer or commercial; none outside 300 to 850 or for unusable types."""
    name, value = F.lower(F.coalesce(F.col(kind), F.lit(""))), double(score)
    bad = name.contains("unknown") | name.contains("invalid") | name.contains("none") | ~F.coalesce(value.between(300, 850), F.lit(False))
    commercial = name.contains("commercial")
    pick = lambda want: F.when(~bad & want, value)
    return df.withColumns({"consumerCreditScore": pick(~commercial), "commercialCreditScore": pick(commercial)})


def loan_to_value(df: DataFrame, most: float | None = 2.0, amount: str = "originalLoanAmount") -> DataFrame:
    x = double(amount) / F.nullif(double("vehicleValueAmount"), F.lit(0.0))
    return df.withColumn("loanToValueRatio", F.when(x <= most, x) if most else x)


def months_delinquent(df: DataFrame) -> DataFrame:
    """Started months past due up to 4; 5 charged off; 6 paid in full."""
    late = F.least(F.ceil(double("currentDelinquencyStatus") / 30), F.lit(4))
    paid = (F.round(F.col(OTHER) + F.col(PRIN) - F.col(B), 6) >= 0) & (F.col(E_) <= 0.05)  # sums of cents as doubles
    return df.withColumn("monthsDelinquent", F.when(F.coalesce(paid, F.lit(False)), 6).when(F.col(CO) > 0, 5).otherwise(late.cast("int")))


def due_amount(df: DataFrame) -> DataFrame:
    """What the row before asked for, if that row ended the day before; else scheduled payments for each month late."""
    w = Window.partitionBy("securitizationKey", "assetNumber").orderBy("reportingPeriodBeginningDate")
    joined = F.date_add(F.lag("reportingPeriodEndingDate").over(w), 1) == F.col("reportingPeriodBeginningDate")
    asked = F.when(joined, F.lag("nextReportingPeriodPaymentAmountDue").over(w)).cast("double")
    planned = (_z("scheduledInterestAmount") + _z("scheduledPrincipalAmount")) * (F.floor(_z("currentDelinquencyStatus") / 30) + 1)
    return df.withColumn("dueAmount", F.coalesce(asked, planned))


def prepaid(df: DataFrame, sens: float = SENS) -> DataFrame:
    extra = double(PRIN) + double("actualInterestCollectedAmount") - double("dueAmount")
    return df.withColumn("principalPrepaid", F.when(F.abs(CO) > sens, F.lit(0.0)).otherwise(F.greatest(extra, F.lit(0.0))))


def prime_indicator(df: DataFrame, score: str = "consumerCreditScore") -> DataFrame:
    s = F.col(score)
    return df.withColumn("primeIndicator", F.when(s <= 640, 1).when(s <= 680, 2).when(s <= 740, 3).when(s > 740, 4).otherwise(0))


def net_losses(df: DataFrame, loss: str = CO, back: str = REC) -> DataFrame:
    return df.withColumn("netLosses", F.greatest(F.coalesce(double(loss) - double(back), F.lit(0.0)), F.lit(0.0)))


def regions(df: DataFrame, states: DataFrame, column: str = "obligorGeographicLocation") -> DataFrame:
    """``region`` of the state; ``states``: state, region."""
    return df.join(F.broadcast(states.select(F.col("state").alias(column), "region")), column, "left")


def enrich(df: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """All derived columns of a loan tape."""
    out = cutoff_balance(ages(trust_dates(balances(df))))
    out = due_amount(months_delinquent(loan_to_value(scores(out))))
    out = net_losses(prime_indicator(prepaid(out)))
    return regions(out, states) if states is not None else out

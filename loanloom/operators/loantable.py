"""The loan-month table: lean projection, composition, run-off, weighted average life, net yield."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import double, level_pay_wal, ratio, total
from .universe import month_sums, placed


def lean_columns() -> dict[str, Column]:
    """The numbers of a loan-month by their short names."""
    rounded = lambda c, kind: F.round(double(c)).cast(kind)
    return {
        "credit_score": rounded("consumerCreditScore", "smallint"), "orig_term": rounded("originalLoanTerm", "smallint"),
        "rem_term": rounded("remainingTermToMaturityNumber", "smallint"), "rate": double("reportingPeriodInterestRatePercentage"),
        "orig_amount": F.col("originalLoanAmount"), "beg_balance": F.col("reportingPeriodBeginningLoanBalanceAmount"),
        "end_balance": F.col("reportingPeriodActualEndBalanceAmount"), "interest": F.col("actualInterestCollectedAmount"),
        "charge_off": F.col("chargedoffPrincipalAmount"), "recovered": F.col("recoveredAmount"),
        "days_past_due": rounded("currentDelinquencyStatus", "int"), "months_delinquent": rounded("monthsDelinquent", "smallint"),
    }


def lean(loans: DataFrame, exits: DataFrame) -> DataFrame:
    """The loan-month columns; ``in_index`` is false from the trust's exit month on. ``exits``: securitizationKey, exited."""
    month = F.trunc("reportingPeriodBeginningDate", "MM")
    rows = loans.join(F.broadcast(exits.select("securitizationKey", "exited")), "securitizationKey", "left")  # a row for each trust
    return rows.select(
        "securitizationKey", F.col("assetNumber").alias("asset_number"), month.alias("report_month"),
        *(c.alias(n) for n, c in lean_columns().items()), (F.col("exited").isNull() | (month < F.col("exited"))).alias("in_index"),
    )


def trust_ids(trusts: DataFrame) -> DataFrame:
    """(securitizationKey, trust_id): ranks from 1. One row per trust, so the single window is small."""
    return trusts.select("securitizationKey").distinct().withColumn("trust_id", F.row_number().over(Window.orderBy("securitizationKey")))


def to_load(universe: DataFrame, log: DataFrame) -> DataFrame:
    """Qualifying trusts that the load log does not have yet."""
    return universe.filter("qualifies").join(log.select("securitizationKey"), "securitizationKey", "left_anti")


def composition(table: DataFrame) -> DataFrame:
    """Per month: loans, balance, and balance-weighted score, original and remaining term within valid ranges."""
    rows = table.filter("in_index and end_balance > 0")

    def mean(c: str, low: int, high: int):
        ok = F.col(c).between(low, high)
        return ratio(F.sum(F.when(ok, double(c) * double("end_balance"))), F.sum(F.when(ok, double("end_balance"))))

    return rows.groupBy("report_month").agg(
        F.count(F.lit(1)).alias("n_loans"), F.sum("end_balance").alias("balance"),
        mean("credit_score", 300, 850).alias("wa_fico"), mean("orig_term", 1, 120).alias("wa_orig_term"), mean("rem_term", 1, 90).alias("wa_rem_term"),
    )


def rate_bucket() -> Column:
    return F.round(F.col("rate").cast("decimal(20,8)") * 200).cast("double") / 200


def rate_buckets(table: DataFrame) -> DataFrame:
    """Balance by month, remaining term and rate to the nearest half percent."""
    rows = table.filter("in_index and end_balance > 0 and rem_term between 1 and 90 and rate >= 0")
    return rows.groupBy("report_month", "rem_term", rate_bucket().alias("rate_bucket")).agg(F.sum("end_balance").alias("balance"))


def scheduled_wal(buckets: DataFrame) -> DataFrame:
    """Balance-weighted life in months of scheduled payments, per month."""
    life = level_pay_wal(F.col("rem_term"), F.col("rate_bucket"))
    return buckets.groupBy("report_month").agg(ratio(F.sum(life * double("balance")), F.sum(double("balance"))).alias("scheduled_wal"))


def run_off(table: DataFrame) -> DataFrame:
    """Per deal and month: balances and remaining term."""
    ok = F.col("rem_term").between(1, 90)
    return table.filter("in_index and end_balance >= 0 and beg_balance > 0").groupBy("securitizationKey", "report_month").agg(
        F.sum("beg_balance").alias("beg"), F.sum("end_balance").alias("end"),
        ratio(F.sum(F.when(ok, double("rem_term") * double("end_balance"))), F.sum(F.when(ok, double("end_balance")))).alias("wa_rem"),
    )


def realized_wal(deals: DataFrame, rows: int = 6, least: float = 0.003) -> DataFrame:
    """Life from the mean run-off of each deal's last rows, capped at its remaining term, balance-weighted per month."""
    w = Window.partitionBy("securitizationKey").orderBy("report_month").rowsBetween(1 - rows, 0)
    speed = F.greatest(F.avg(1 - ratio("end", "beg")).over(w), F.lit(least))
    lives = deals.withColumn("life", F.least(1 / speed, F.coalesce("wa_rem", F.lit(float("inf"))))).filter("end > 0")
    return lives.groupBy("report_month").agg(ratio(F.sum(F.col("life") * double("end")), F.sum(double("end"))).alias("realized_wal"))


def _report_parts() -> list[Column]:
    """Sums over the loan-months of a deal and month from which the composition report is made. The scheduled life is a
    function of the row, so its balance-weighted sum needs no groups by term and rate."""
    live, end = F.col("end_balance") > 0, double("end_balance")
    term = F.col("rem_term").between(1, 90)
    ran = (F.col("end_balance") >= 0) & (F.col("beg_balance") > 0)
    paid = live & term & (F.col("rate") >= 0)
    parts = {"balance": (live, F.col("end_balance")), "beg": (ran, F.col("beg_balance")), "end": (ran, F.col("end_balance"))}
    for name, (low, high) in {"credit_score": (300, 850), "orig_term": (1, 120), "rem_term": (1, 90)}.items():
        known = live & F.col(name).between(low, high)
        parts |= {f"{name}_sum": (known, double(name) * end), f"{name}_of": (known, end)}
    parts |= {"life_sum": (paid, level_pay_wal(F.col("rem_term"), rate_bucket()) * end), "life_of": (paid, end)}
    parts |= {"left_sum": (ran & term, double("rem_term") * end), "left_of": (ran & term, end)}
    return [F.count_if(live).alias("n_loans"), *(F.sum(F.when(test, x)).alias(n) for n, (test, x) in parts.items())]


def _report(deals: DataFrame, rows: int = 6, least: float = 0.003) -> DataFrame:
    """The report from the parts by securitizationKey and report_month."""
    # Months without a balance to run off count for no deal's speed.
    w = Window.partitionBy("securitizationKey", F.col("beg").isNull()).orderBy("report_month").rowsBetween(1 - rows, 0)
    speed = F.greatest(F.avg(1 - ratio("end", "beg")).over(w), F.lit(least))
    life = F.least(1 / speed, F.coalesce(ratio("left_sum", "left_of"), F.lit(float("inf"))))
    lives = deals.withColumn("life", F.when(F.col("end") > 0, life))
    weight = F.when(F.col("end") > 0, double("end"))
    mean = lambda n: ratio(F.sum(f"{n}_sum"), F.sum(f"{n}_of"))
    out = lives.groupBy("report_month").agg(
        F.sum("n_loans").alias("n_loans"), F.sum("balance").alias("balance"), mean("credit_score").alias("wa_fico"), mean("orig_term").alias("wa_orig_term"),
        mean("rem_term").alias("wa_rem_term"), mean("life").alias("scheduled_wal"), ratio(F.sum(F.col("life") * weight), F.sum(weight)).alias("realized_wal"),
    )
    return out.filter("n_loans > 0").select("report_month", "n_loans", "balance", *(F.round(c, 2).alias(c) for c in ("wa_fico", "wa_orig_term", "wa_rem_term", "scheduled_wal", "realized_wal")))


def composition_report(table: DataFrame) -> DataFrame:
    """Composition with both lives, rounded for print, in one pass over the loan-month table."""
    return _report(table.filter("in_index").groupBy("securitizationKey", "report_month").agg(*_report_parts()))


def composition_report_of_loans(loans: DataFrame, **limits) -> DataFrame:
    """The same from enriched loans, with the trusts' exit months, in one pass: a trust leaves by whole months, so that
    months are dropped after summing. Rows without trust or month count nowhere."""
    sums = month_sums(loans.withColumns(lean_columns()), *_report_parts())
    return _report(placed(sums, **limits).filter("exited is null or month < exited").withColumnRenamed("month", "report_month"))


def month_aggregate(table: DataFrame) -> DataFrame:
    """Per month: trusts, interest cash and accrued, charge-offs, recoveries, average and begin balance."""
    b, e = F.coalesce("beg_balance", "end_balance"), F.coalesce("end_balance", "beg_balance")
    return table.filter("in_index").groupBy("report_month").agg(
        F.count_distinct("securitizationKey").alias("n_trusts"), total("interest").alias("interest_cash"),
        F.sum(double("rate") * double("beg_balance")).alias("interest_accrued"), total("charge_off").alias("charge_off"), total("recovered").alias("recovered"),
        F.sum((double(b) + double(e)) / 2).alias("avg_balance"), total("beg_balance").alias("beg_balance"),
    )


def net_yield(months: DataFrame) -> DataFrame:
    """Annual yields in percent per month, cash and accrued, before and after net loss; months without balance go."""
    pct = lambda x: F.round(100 * x, 3)
    loss = 12 * ratio(double("charge_off") - double("recovered"), "avg_balance")
    cash, accrued = 12 * ratio("interest_cash", "avg_balance"), ratio("interest_accrued", "avg_balance")
    return months.filter("avg_balance > 0").select("report_month", "n_trusts", pct(cash).alias("gross_cash"), pct(accrued).alias("gross_accrued"), pct(loss).alias("net_loss"), pct(cash - loss).alias("net_cash"), pct(accrued - loss).alias("net_accrued"))


def align(series: dict[str, DataFrame], key: str = "month", value: str = "value") -> DataFrame:
    """One row per date of any series, a column for each."""
    out = None
    for df in series.values():
        dates = df.select(key)
        out = dates if out is None else out.union(dates)
    out = out.distinct()
    for name, df in series.items():
        out = out.join(df.select(key, F.col(value).alias(name)), key, "left")
    return out


def decembers_and_latest(series: DataFrame, key: str = "month") -> DataFrame:
    """Rows of each December, and the last row."""
    last = series.agg(F.max(key).alias("_last"))
    return series.join(last, (F.month(key) == 12) | (F.col(key) == F.col("_last"))).drop("_last")


def method_difference(index: DataFrame, a: str = "stress_index_pca", b: str = "stress_index_zavg") -> DataFrame:
    """Largest absolute difference and correlation of two composites."""
    return index.agg(F.max(F.abs(F.col(a) - F.col(b))).alias("max_abs"), F.corr(a, b).alias("correlation"))


def publish_levels(index: DataFrame, value: str = "stress_index", kind: str = "stress") -> DataFrame:
    """Rounds of a published level: 100 + 25 · stress or the yield, at least 0.01, as an integer of 1e-8; only changes."""
    level = F.greatest(100 + 25 * F.col(value) if kind == "stress" else F.col(value), F.lit(0.01))
    rows = index.filter(F.col(value).isNotNull()).select("month", F.round(level * 1e8).cast("bigint").alias("answer"))
    w = Window.orderBy("month")  # one row per month
    changed = rows.withColumn("_was", F.lag("answer").over(w)).filter("_was is null or _was <> answer").drop("_was")
    return changed.withColumn("round_id", F.row_number().over(w))

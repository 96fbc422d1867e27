"""Dollar parts and ratios by trust and month, and pooled over trusts: numerators and denominators are summed first."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import double, ratio, total, untrue
from .universe import month_sums, monthly, placed

PARTS = ["pool_beg_balance", "pool_end_balance", "active_balance", "delq30_balance", "delq60_balance", "current_balance", "roll_30_balance", "net_losses", "charge_offs", "recoveries", "interest_collected"]


def with_days(loans: DataFrame) -> DataFrame:
    """Adds ``_resolved`` (charged off or paid), ``_dpd`` (days past due, from the bucket where days are absent)."""
    md = F.col("monthsDelinquent")
    resolved = F.coalesce(md.isin(5, 6), F.lit(False))
    if "currentDelinquencyStatus" in loans.columns:
        days = F.coalesce(double("currentDelinquencyStatus"), F.lit(0.0))
    else:
        days = F.when(resolved, F.lit(0.0)).otherwise(F.least(double(md), F.lit(4.0)) * 30)
    return loans.withColumn("_resolved", resolved).withColumn("_dpd", days)


def current_to_30(loans: DataFrame, deal: bool = False) -> DataFrame:
    """(securitizationKey, month, current_balance, roll_30_balance): end balance of current loans that report in the
    next calendar month, and of those of them that are then 30 days past due or more. A loan-month counts once.
    ``deal``: the rows are in no buckets by loan; they are moved once for all steps, not by loan month and by loan again."""
    rows = with_days(monthly(loans)).select("securitizationKey", "assetNumber", "month", "monthsDelinquent", "_dpd", "reportingPeriodActualEndBalanceAmount")
    rows = (rows.repartition("securitizationKey", "assetNumber") if deal else rows).groupBy("securitizationKey", "assetNumber", "month").agg(
        F.max("monthsDelinquent").alias("md"), F.max("_dpd").alias("dpd"), F.sum("reportingPeriodActualEndBalanceAmount").alias("e")
    )
    w = Window.partitionBy("securitizationKey", "assetNumber").orderBy("month")
    ahead = rows.withColumn("next_month", F.lead("month").over(w)).withColumn("next_dpd", F.lead("dpd").over(w))
    pairs = ahead.filter((F.col("md") == 0) & (F.col("next_month") == F.add_months("month", 1)))
    return pairs.groupBy("securitizationKey", "month").agg(total("e").alias("current_balance"), total(F.when(F.col("next_dpd") >= 30, F.col("e")).otherwise(F.lit(0))).alias("roll_30_balance"))


def with_ratios(parts: DataFrame) -> DataFrame:
    return parts.withColumns({
        "delq30plus": ratio("delq30_balance", "active_balance"),
        "delq60plus": ratio("delq60_balance", "active_balance"),
        "roll_c_to_30": ratio("roll_30_balance", "current_balance"),
        "net_loss_annl": 12 * ratio("net_losses", "pool_beg_balance"),
        "recovery_rate": ratio("recoveries", "charge_offs"),
    })


def _parts(loans: DataFrame) -> list[Column]:
    """The dollar sums over rows that have their days."""
    end = F.col("reportingPeriodActualEndBalanceAmount")
    live = untrue(F.col("_resolved"))
    part = lambda name: total(name) if name in loans.columns else F.lit(None).cast("double")
    return [
        part("reportingPeriodBeginningLoanBalanceAmount").alias("pool_beg_balance"),
        total(end).alias("pool_end_balance"),
        total(F.when(live, end)).alias("active_balance"),
        total(F.when(live & (F.col("_dpd") >= 30), end)).alias("delq30_balance"),
        total(F.when(live & (F.col("_dpd") >= 60), end)).alias("delq60_balance"),
        part("netLosses").alias("net_losses"),
        part("chargedoffPrincipalAmount").alias("charge_offs"),
        part("recoveredAmount").alias("recoveries"),
        part("actualInterestCollectedAmount").alias("interest_collected"),
    ]


def trust_month_parts(loans: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Dollar sums by trust and month, without the roll."""
    return with_days(monthly(loans)).groupBy(*(by or ["securitizationKey"]), "month").agg(*_parts(loans))


def universe_metrics(loans: DataFrame, **limits) -> DataFrame:
    """``trust_month_metrics`` of the universe, and each trust's ``first_month``, in two passes over the loans: one makes the
    sums of every trust and month, from which the universe is read off too, the other the rolls. A trust leaves by whole
    months, so months are dropped after summing; a month rolls only into one that stays."""
    sums = month_sums(with_days(loans), *_parts(loans))
    kept = placed(sums, **limits).filter("qualifies and (exited is null or month < exited)")
    rolls = current_to_30(loans)
    stays = F.col("exited").isNull() | (F.add_months("month", 1) < F.col("exited"))
    both = kept.join(rolls, ["securitizationKey", "month"], "left")
    both = both.withColumns({c: F.when(stays, F.col(c)) for c in ("current_balance", "roll_30_balance")})
    return with_ratios(both.select("securitizationKey", "month", "first_month", *PARTS))


def trust_month_metrics(loans: DataFrame, deal: bool = False) -> DataFrame:
    """Parts and ratios by trust and month of an already filtered universe; ``deal`` as in ``current_to_30``."""
    both = trust_month_parts(loans).join(current_to_30(loans, deal), ["securitizationKey", "month"], "left")
    return with_ratios(both)


def pool_metrics(trusts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Parts summed over trusts per month (null where all are null), ratios and yields of the sums."""
    keys = [*(by or []), "month"]
    pooled = trusts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in PARTS), F.count(F.lit(1)).alias("n_trusts"))
    beg, end = F.coalesce("pool_beg_balance", "pool_end_balance"), F.coalesce("pool_end_balance", "pool_beg_balance")
    average = (double(beg) + double(end)) / 2
    out = with_ratios(pooled).withColumn("pool_balance", F.col("pool_end_balance"))
    return out.withColumns({
        "gross_yield_annl": 12 * ratio("interest_collected", average),
        "net_yield_annl": 12 * ratio(double("interest_collected") - double("net_losses"), average),
    })

"""Cleaning and enrichment queries over the dirty raw tape."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import clean, enrich
from .raw import COLS, RAW, manufacturers, raw_tape, states
from .registry import query, r8

KEY, BEG = "securitizationKey", "reportingPeriodBeginningDate"
DEDUP = RAW + f""", base AS (SELECT *, CASE WHEN k % 17 = 0 THEN endb + 1 ELSE endb END AS last_end, {COLS['rate_text']}::DOUBLE AS rt, {COLS['fee']}::DOUBLE AS fee FROM raw),
st AS (SELECT sec, avg(CASE WHEN rt > 1 THEN 1.0 ELSE 0.0 END) AS above, max(rt) AS mx FROM base GROUP BY sec),
sc AS (SELECT b.*, above, mx, CASE WHEN mx > 5 AND above > 0.4 AND rt > 1 THEN rt / 100 WHEN mx > 5 AND NOT above > 0.4 AND rt > 5 THEN NULL ELSE rt END AS r1 FROM base b JOIN st USING (sec)),
cleaned AS (SELECT *, CASE WHEN r1 > 1 THEN NULL ELSE r1 END AS rate FROM sc)"""
ENR = RAW + """,
e1 AS (SELECT *, CASE WHEN k % 61 = 0 THEN endb + raw_co + prin ELSE beg END AS b FROM raw),
e2 AS (SELECT *, raw_co = b AND raw_rec = 0 AND repo <> 0 AS fix, repo + raw_co + raw_rec = b AND (repo <> 0 OR raw_co <> 0 OR raw_rec <> 0) AS split FROM e1),
e3 AS (SELECT *, CASE WHEN fix OR split THEN raw_rec + repo ELSE raw_rec END AS rec3, CASE WHEN split AND NOT fix THEN raw_co + repo + raw_rec ELSE raw_co END AS co3, CASE WHEN split AND NOT fix THEN 0 ELSE endb END AS end3 FROM e2),
e4 AS (SELECT *, (b - end3) - (prin + co3) AS other FROM e3),
sp AS (SELECT sec, max(mi) AS last_mi, min(mi) AS first_mi FROM raw GROUP BY sec),
e5 AS (SELECT e4.*, CAST(mi = last_mi AS INT) AS summary, mi - first_mi AS mfc,
  CASE WHEN other + prin >= b AND end3 <= 5 THEN 6 WHEN co3 > 0 THEN 5 ELSE least(ceil(dpd / 30.0), 4) END AS md3,
  CASE WHEN k % 101 = 0 OR coalesce(score_type, '') IN ('None') THEN NULL ELSE fico END AS usable,
  coalesce(CASE WHEN lag(mi) OVER w = mi - 1 THEN lag(sched_prin + interest) OVER w END, (interest + sched_prin) * (dpd // 30 + 1)) AS due
  FROM e4 JOIN sp USING (sec) WINDOW w AS (PARTITION BY sec, asset ORDER BY mi)),
enr AS (SELECT *, CASE WHEN coalesce(score_type, '') LIKE 'Commercial%' THEN NULL ELSE usable END AS cons, CASE WHEN score_type LIKE 'Commercial%' THEN usable END AS comm,
  CASE WHEN co3 > 0 THEN 0 ELSE greatest(prin + interest - due, 0) END AS pp, CASE WHEN veh_value <> 0 AND orig / veh_value::DOUBLE <= 2 THEN orig / veh_value::DOUBLE END AS ltv FROM e5)"""
S = ' SELECT sec AS "securitizationKey", '


def cents(c, name):
    """Whole cents of each row, summed as integers: a sum of doubles loses cents and depends on the order of its rows."""
    return F.sum(F.round(F.col(c) * 100).cast("bigint")).alias(name)


def _cleaned(s, d):
    return clean.clean(raw_tape(s, d), "loan", manufacturers(s))


def _enriched(s, d):
    return enrich.enrich(clean.clean(raw_tape(s, d, duplicates=False)), states(s))


def _per(f, measures):
    return lambda s, d: f(s, d).groupBy(KEY).agg(*measures())


def n():
    return F.count(F.lit(1)).alias("n")


_typed = lambda s, d: clean.typed(raw_tape(s, d))


def _restated(s, d):
    """Loan months as filed last that differ from their first filing. Both lie beside each other: nothing is joined."""
    end, filings = "reportingPeriodActualEndBalanceAmount", Window.partitionBy(KEY, "assetNumber", BEG)
    rows = _typed(s, d).withColumn("_first", F.min_by(end, "reportDate").over(filings))
    return clean.keep_last(rows).filter(F.round(F.col(end) * 100) != F.round(F.col("_first") * 100))


query("c1_dates", RAW + " SELECT month AS begin, CAST(sum(1 + CAST(k % 17 = 0 AS INT)) AS BIGINT) AS n, CAST(min(om) AS BIGINT) AS first_orig FROM raw GROUP BY 1")(
    lambda s, d: _typed(s, d).groupBy(F.col(BEG).alias("begin")).agg(n(), (F.year(F.min("originationDate")) * 12 + F.month(F.min("originationDate")) - 1).cast("bigint").alias("first_orig")))
query("c2_numbers", RAW + S + "CAST(sum(CASE WHEN k % 101 = 0 THEN 0 ELSE fico * (1 + CAST(k % 17 = 0 AS INT)) END) AS BIGINT) AS scores, CAST(sum(orig * (1 + CAST(k % 17 = 0 AS INT))) AS BIGINT) AS orig FROM raw GROUP BY 1")(
    _per(_typed, lambda: [F.coalesce(F.sum("obligorCreditScore"), F.lit(0)).cast("bigint").alias("scores"), cents("originalLoanAmount", "orig")]))
query("c3_c4_defaults", RAW + S + "CAST(sum(raw_co * (1 + CAST(k % 17 = 0 AS INT))) AS BIGINT) AS co, 0::BIGINT AS other, CAST(sum(CASE WHEN k % 101 = 0 THEN 1 + CAST(k % 17 = 0 AS INT) ELSE 0 END) AS BIGINT) AS no_score FROM raw GROUP BY 1")(
    _per(lambda s, d: clean.defaults(_typed(s, d)), lambda: [cents("chargedoffPrincipalAmount", "co"), cents("otherPrincipalAdjustmentAmount", "other"), F.count_if(F.col("obligorCreditScore") == 0).alias("no_score")]))
query("c5_keep_last", DEDUP + S + "count(*) AS n, CAST(sum(last_end) AS BIGINT) AS end_balance FROM base GROUP BY 1")(_per(lambda s, d: clean.keep_last(_typed(s, d)), lambda: [n(), cents("reportingPeriodActualEndBalanceAmount", "end_balance")]))
query("t3_restatement_wins", DEDUP + S + "count(*) AS n FROM base WHERE last_end <> endb GROUP BY 1")(
    lambda s, d: _restated(s, d).groupBy(KEY).agg(n()))
query("c6_manufacturers", RAW + " SELECT CASE WHEN k % 10 % 2 = 0 THEN 'Maker ' || CAST((k % 10) // 2 AS VARCHAR) ELSE 'Brand#' || CAST(k % 10 AS VARCHAR) END AS maker, count(*) AS n FROM raw GROUP BY 1")(
    lambda s, d: clean.translated(raw_tape(s, d, False), "vehicleManufacturerName", manufacturers(s)).groupBy(F.col("vehicleManufacturerName").alias("maker")).agg(n()))
query("c7_rate_statistics", DEDUP + S + "round(above, 8) AS above, mx AS most FROM st")(
    lambda s, d: clean.rate_statistics(clean.keep_last(_typed(s, d)), ["reportingPeriodInterestRatePercentage"]).select(KEY, r8("reportingPeriodInterestRatePercentage_above").alias("above"), F.col("reportingPeriodInterestRatePercentage_max").alias("most")))
query("c8_rates_rescaled", DEDUP + S + "count(rate) AS known, round(sum(rate), 6) AS total FROM cleaned GROUP BY 1")(_per(_cleaned, lambda: [F.count("reportingPeriodInterestRatePercentage").alias("known"), r8(F.sum("reportingPeriodInterestRatePercentage"), 6).alias("total")]))
query("c9_fee_floor", DEDUP + S + "round(sum(CASE WHEN fee < 0.001 THEN 0.01 ELSE fee END), 6) AS fees FROM base GROUP BY 1")(_per(_cleaned, lambda: [r8(F.sum("servicingFeePercentage"), 6).alias("fees")]))
query("e1_begin_balance", ENR + S + "CAST(sum(b) AS BIGINT) AS beg FROM enr GROUP BY 1")(_per(_enriched, lambda: [cents(enrich.B, "beg")]))
query("e2_e3_recoveries_and_charge_offs", ENR + S + "CAST(sum(rec3) AS BIGINT) AS rec, CAST(sum(co3) AS BIGINT) AS co, CAST(sum(end3) AS BIGINT) AS e FROM enr GROUP BY 1")(_per(_enriched, lambda: [cents(enrich.REC, "rec"), cents(enrich.CO, "co"), cents(enrich.E_, "e")]))
query("e4_principal_tie_out", ENR + S + "CAST(sum(other) AS BIGINT) AS other FROM enr GROUP BY 1")(_per(_enriched, lambda: [cents(enrich.OTHER, "other")]))
query("e5_summary_date", ENR + S + "CAST(sum(summary) AS BIGINT) AS n FROM enr GROUP BY 1")(_per(_enriched, lambda: [F.sum("summaryDate").alias("n")]))
query("e6_months_from_cutoff", ENR + S + "CAST(sum(mfc) AS BIGINT) AS mfc FROM enr GROUP BY 1")(_per(_enriched, lambda: [F.sum("monthsFromCutoffDate").alias("mfc")]))
query("e7_age", ENR + S + "CAST(sum(age) AS BIGINT) AS age, CAST(sum(age - mfc) AS BIGINT) AS from_cutoff FROM enr GROUP BY 1")(_per(_enriched, lambda: [F.sum("age").alias("age"), F.sum("ageFromCutoff").alias("from_cutoff")]))
query("e8_cutoff_balance", ENR + ", c AS (SELECT sec, asset, b AS cut FROM enr WHERE mfc = 0)" + S + "CAST(sum(cut) AS BIGINT) AS cut FROM enr JOIN c USING (sec, asset) GROUP BY 1")(
    lambda s, d: _enriched(s, d).filter("beginningBalanceAtCutoffDate is not null").groupBy(KEY).agg(cents("beginningBalanceAtCutoffDate", "cut")))
query("e9_scores", ENR + S + "count(cons) AS cons, count(comm) AS comm, CAST(coalesce(sum(cons), 0) AS BIGINT) AS score FROM enr GROUP BY 1")(
    _per(_enriched, lambda: [F.count("consumerCreditScore").alias("cons"), F.count("commercialCreditScore").alias("comm"), F.coalesce(F.sum("consumerCreditScore"), F.lit(0)).cast("bigint").alias("score")]))
query("e10_loan_to_value", ENR + S + "round(avg(ltv), 6) AS ltv FROM enr GROUP BY 1")(_per(_enriched, lambda: [r8(F.avg("loanToValueRatio"), 6).alias("ltv")]))
query("e11_vintage", ENR + " SELECT CAST(om // 12 AS INT) AS vintage, count(*) AS n FROM enr GROUP BY 1")(lambda s, d: _enriched(s, d).groupBy("vintage").agg(n()))
query("e12_months_delinquent", ENR + " SELECT CAST(md3 AS INT) AS md, count(*) AS n FROM enr GROUP BY 1")(lambda s, d: _enriched(s, d).groupBy(F.col("monthsDelinquent").cast("int").alias("md")).agg(n()))
query("e13_e14_due_amount", ENR + S + "CAST(sum(due) AS BIGINT) AS due FROM enr GROUP BY 1")(_per(_enriched, lambda: [cents("dueAmount", "due")]))
query("e15_principal_prepaid", ENR + S + "CAST(sum(pp) AS BIGINT) AS pp FROM enr GROUP BY 1")(_per(_enriched, lambda: [cents("principalPrepaid", "pp")]))
query("e16_prime_indicator", ENR + " SELECT CASE WHEN cons <= 640 THEN 1 WHEN cons <= 680 THEN 2 WHEN cons <= 740 THEN 3 WHEN cons > 740 THEN 4 ELSE 0 END AS tier, count(*) AS n FROM enr GROUP BY 1")(lambda s, d: _enriched(s, d).groupBy(F.col("primeIndicator").alias("tier")).agg(n()))
query("e17_net_losses", ENR + S + "CAST(sum(greatest(co3 - rec3, 0)) AS BIGINT) AS nl FROM enr GROUP BY 1")(_per(_enriched, lambda: [cents("netLosses", "nl")]))
query("e18_regions", ENR + " SELECT CASE state WHEN 'CA' THEN 'West' WHEN 'TX' THEN 'South' WHEN 'FL' THEN 'South' WHEN 'OH' THEN 'Midwest' WHEN 'NJ' THEN 'Northeast' END AS region, count(*) AS n FROM enr GROUP BY 1")(lambda s, d: _enriched(s, d).groupBy("region").agg(n()))

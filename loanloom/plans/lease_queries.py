"""Lease queries over the tape under lease names, and reader and writer queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, lease, report
from ..operators.metrics import trust_month_parts
from ..sources import readers
from .index_queries import INDEX, TRUST, _index, _live, _trust
from .raw import manufacturers, raw_tape, states
from .registry import TAPE, named, query, r8
from .tape import tape

KEY = "securitizationKey"
_E = {
    "securitizationKey": "sec", "assetNumber": "asset", "reportingPeriodBeginDate": "month", "reportingPeriodEndDate": "last_day(month)", "originationDate": "orig_month",
    "reportingPeriodSecuritizationValueAmount": "beg", "reportingPeriodEndActualSecuritizationAmount": "endb", "chargedOffAmount": "co", "liquidationProceedsAmount": "rec", "repurchaseAmount": "rec div 2",
    "totalActualAmountPaid": "prin + interest", "securitizationDiscountRate": "(300 + k % 500) / 10000.0D", "originalLeaseTermNumber": "term", "remainingTermNumber": "term - age",
    "reportingPeriodScheduledPaymentAmount": "orig div term", "baseResidualValue": "orig * 4 div 10", "contractResidualValue": "orig * 4 div 10", "acquisitionCost": "orig * 12 div 10", "vehicleValueAmount": "veh_value",
    "currentDelinquencyStatus": "dpd", "terminationIndicator": "CASE WHEN age = term - 1 THEN 1 ELSE 0 END", "zeroBalanceCode": "CASE WHEN co > 0 THEN 3 ELSE 0 END", "zeroBalanceEffectiveDate": "CASE WHEN co > 0 THEN last_day(month) END",
    "lesseeCreditScore": "fico", "lesseeCreditScoreType": "score_type", "lesseeGeographicLocation": "state",
}
S = ' SELECT sec AS "securitizationKey", '


def n():
    return F.count(F.lit(1)).alias("n")


LS = TAPE + """, ls AS (SELECT *, (300 + k % 500) / 10000.0::DOUBLE AS rate, orig // term AS pay, orig * 4 // 10 AS resid, term - age AS lft, age = term - 1 AS fin FROM tape),
pv AS (SELECT *, -( -CAST(resid AS DOUBLE) - pay * (1 + rate / 12) * (power(1 + rate / 12, lft + 1.0) - 1) / (rate / 12)) / power(1 + rate / 12, lft + 1.0) AS v0, -( -CAST(resid AS DOUBLE) - pay * (1 + rate / 12) * (power(1 + rate / 12, CAST(lft AS DOUBLE)) - 1) / (rate / 12)) / power(1 + rate / 12, CAST(lft AS DOUBLE)) AS v1,
  CASE WHEN co > 0 THEN 5 ELSE least(dpd // 30, 4) END AS lmd FROM ls)"""


def _leases(s, d):
    return tape(s, d).select(*(F.expr(e).alias(c) for c, e in _E.items()))


def _more_sql(duck: bool) -> str:
    """The tape with what a lease tape gets wrong: begin values and charge-offs that contradict each other, several ways
    to end, and proceeds that come, again, after the end."""
    keys = "k, sec, asset, orig_month, orig, term, fico, veh_value, score_type, state"
    after = "CAST(month + INTERVAL 1 MONTH AS DATE)" if duck else "add_months(month, 1)"
    return f"""SELECT {keys}, mi, i, month, age, dpd, interest, prin, CASE WHEN k % 29 IN (0, 1) AND i = 3 THEN 0 ELSE beg END AS beg, endb,
  CASE WHEN k % 29 = 0 AND i = 3 THEN -100 WHEN k % 29 = 1 AND i = 3 THEN 100 WHEN k % 29 = 2 AND i = 4 AND beg > 700 THEN beg - 700 ELSE co END AS co, CASE WHEN k % 29 = 2 AND i = 4 AND beg > 700 THEN 700 ELSE rec END AS rec,
  CASE WHEN co > 0 THEN last_day(month) END AS zb, CASE WHEN co > 0 THEN 1 + 2 * (k % 2) ELSE 0 END AS zc, CASE WHEN age = term - 1 THEN 1 + k % 4 ELSE 0 END AS ti FROM {"tape" if duck else "{t}"}
 UNION ALL SELECT {keys}, mi + 1, i + 1, {after}, age + 1, dpd, 0, 0, 0, 0, 0, CASE WHEN k % 3 = 0 THEN rec ELSE rec + 1 END, last_day(month), 1 + 2 * (k % 2), 0 FROM {"tape" if duck else "{t}"} WHERE co > 0"""


_MORE = _E | {"terminationIndicator": "ti", "zeroBalanceCode": "zc", "zeroBalanceEffectiveDate": "zb", lease.OWED: "CASE WHEN endb = 0 AND k % 5 = 0 THEN 1 ELSE endb END"}
_RATE, _PAY, _RESID, _LEFT = "(300 + k % 500) / 10000.0::DOUBLE", "(orig // term)", "(orig * 4 // 10)", "(term - age)"
_OPENS = f"beg = 0 AND endb <> 0 AND {_LEFT} > 0"
LX = TAPE + f""", lt AS ({_more_sql(True)}),
x2 AS (SELECT * REPLACE (CASE WHEN {_OPENS} AND co > 0 THEN endb + co ELSE beg END AS beg, CASE WHEN {_OPENS} AND co < 0 THEN beg - endb WHEN co > 0 AND beg - co - rec = 0 THEN beg ELSE co END AS co),
  CASE WHEN endb = 0 AND k % 5 = 0 THEN 1 ELSE endb END AS owed, {_RATE} AS rate, {_PAY} AS pay, {_RESID} AS resid, {_LEFT} AS lft FROM lt),
x3 AS (SELECT *, rec <> 0 AND coalesce(zb < month, false) AND owed + endb = 0 AS gone FROM x2),
x4 AS (SELECT *, CASE WHEN co > 0 AND rec > 0 THEN rec ELSE 0 END + CASE WHEN gone AND zc = 3 THEN rec ELSE 0 END AS recovered, prin + interest + CASE WHEN ti IN (1, 2) OR gone AND zc = 1 THEN rec ELSE 0 END AS paid FROM x3),
x5 AS (SELECT *, rec <> 0 AND coalesce(lead(rec) OVER (PARTITION BY sec, asset ORDER BY month) = rec, false) AS again FROM x4),
x6 AS (SELECT * REPLACE (CASE WHEN again THEN 0 ELSE co END AS co, CASE WHEN again THEN 0 ELSE recovered END AS recovered, CASE WHEN again THEN 0 ELSE rec END AS rec, CASE WHEN again THEN 0 ELSE zc END AS zc, CASE WHEN again THEN 0 ELSE ti END AS ti) FROM x5),
x7 AS (SELECT *, CASE WHEN owed = 0 AND lft < term AND paid > pay AND dpd = 0 THEN 6 WHEN co > 0 THEN 5 ELSE least(dpd // 30, 4) END AS lmd,
  -( -CAST(resid AS DOUBLE) - pay * (1 + rate / 12) * (power(1 + rate / 12, lft + 1.0) - 1) / (rate / 12)) / power(1 + rate / 12, lft + 1.0) AS v0, -( -CAST(resid AS DOUBLE) - pay * (1 + rate / 12) * (power(1 + rate / 12, CAST(lft AS DOUBLE)) - 1) / (rate / 12)) / power(1 + rate / 12, CAST(lft AS DOUBLE)) AS v1 FROM x6),
x8 AS (SELECT *, CASE WHEN lmd < 5 THEN (v0 - v1) * (dpd // 30 + 1) ELSE 0 END AS planned, beg - endb - co AS principal FROM x7),
x9 AS (SELECT *, CASE WHEN co = 0 AND beg <> 0 AND endb = 0 AND lft > 1 THEN greatest(principal - planned, 0) ELSE 0 END AS prepaid, CASE WHEN ti IN (1, 2) OR zc IN (1, 2) THEN rec - resid ELSE 0 END AS sale FROM x8)"""


def _more(s, d):
    rows = s.sql(_more_sql(False), t=tape(s, d))
    return rows.select(*(F.expr(e).alias(c) for c, e in _MORE.items()))


def _steps(s, d):
    return lease.flows(lease.months_delinquent(lease.repeated_proceeds(lease.recoveries(lease.reconciled(lease.scheduled_values(_more(s, d)))))))


def _flows(s, d):
    return lease.flows(lease.months_delinquent(lease.scheduled_values(_leases(s, d))))


query("lc1_dropped_trust", TAPE + " SELECT count(*) AS n FROM tape")(lambda s, d: clean.clean(_leases(s, d).unionByName(_leases(s, d).limit(5).withColumn(KEY, F.lit("DAIMLER TRUST LEASING LLC"))), "lease").agg(n()))
query("lc2_defaults", TAPE + S + "count(*) AS n, 0.0::DOUBLE AS fees FROM tape GROUP BY 1")(lambda s, d: clean.defaults(clean.typed(_leases(s, d), "lease"), "lease").groupBy(KEY).agg(n(), F.sum("excessFeeAmount").alias("fees")))
query("lc3_double_months", TAPE + ", dm AS (SELECT sec, asset, mi, CASE WHEN k % 23 = 0 AND i = 4 THEN lag(endb) OVER (PARTITION BY sec, asset ORDER BY mi) ELSE beg END AS v FROM tape)" + S + "count(v) AS n, CAST(sum(v) AS BIGINT) AS total FROM dm GROUP BY 1")(
    lambda s, d: clean.double_months(tape(s, d).select(*(F.expr(e).alias(c) for c, e in (_E | {"reportingPeriodBeginDate": "CASE WHEN k % 23 = 0 AND i = 4 THEN add_months(month, -1) ELSE month END"}).items()))).groupBy(KEY).agg(F.count(lease.B).alias("n"), F.sum(lease.B).alias("total")))
query("lc4_keep_last", TAPE + " SELECT count(*) AS n FROM tape")(lambda s, d: clean.keep_last(_leases(s, d).unionByName(_leases(s, d).filter("currentDelinquencyStatus = 35")), "reportingPeriodBeginDate").agg(n()))
query("le1_scheduled_values", LS + S + "round(sum(v0) / 1e8, 4) AS v0, round(sum(v1) / 1e8, 4) AS v1 FROM pv GROUP BY 1")(
    lambda s, d: lease.scheduled_values(_leases(s, d)).groupBy(KEY).agg(r8(F.sum("scheduledSecuritizationBeginValueAmount") / 1e8, 4).alias("v0"), r8(F.sum("scheduledSecuritizationEndValueAmount") / 1e8, 4).alias("v1")))
query("le6_months_delinquent", LX + " SELECT CAST(CASE WHEN owed = 0 AND lft < term AND prin + interest > pay AND dpd = 0 THEN 6 WHEN co > 0 THEN 5 ELSE least(dpd // 30, 4) END AS INT) AS md, count(*) AS n FROM (SELECT lt.*, CASE WHEN endb = 0 AND k % 5 = 0 THEN 1 ELSE endb END AS owed, term - age AS lft, orig // term AS pay FROM lt) GROUP BY 1")(lambda s, d: lease.months_delinquent(_more(s, d)).groupBy(F.col("monthsDelinquent").cast("int").alias("md")).agg(n()))
query("le7_le8_principal", LS + S + "round(sum(CASE WHEN lmd < 5 THEN (v0 - v1) * (dpd // 30 + 1) ELSE 0 END) / 1e8, 4) AS planned, CAST(sum(beg - endb - co) AS BIGINT) AS principal FROM pv GROUP BY 1")(
    lambda s, d: _flows(s, d).groupBy(KEY).agg(r8(F.sum("scheduledSecuritizationValueAmortization") / 1e8, 4).alias("planned"), F.sum("actualPrincipalCollectedAmount").cast("bigint").alias("principal")))
query("le10_interest", LS + S + "round(sum(least(greatest(CAST(prin + interest - (beg - endb - co) AS DOUBLE), 0), beg * rate / 12)) / 1e6, 3) AS interest FROM pv GROUP BY 1")(lambda s, d: _flows(s, d).groupBy(KEY).agg(r8(F.sum("actualInterestCollectedAmount") / 1e6, 3).alias("interest")))
query("le11_sale_results", LS + S + "CAST(sum(CASE WHEN fin THEN rec - resid ELSE 0 END) AS BIGINT) AS result FROM pv GROUP BY 1")(lambda s, d: _flows(s, d).groupBy(KEY).agg(F.sum("saleGainOrLoss").cast("bigint").alias("result")))
_LONG = {"begins": (lease.B, "beg"), "charged": (lease.CO, "co"), "proceeds": (lease.LIQ, "rec"), "recovered": ("recoveredAmount", "recovered"), "paid": (lease.PAID, "paid"), "principal": ("actualPrincipalCollectedAmount", "principal"), "sale": ("saleGainOrLoss", "sale")}
query("le2_le11_lease_flows", LX + S + "CAST(lmd AS INT) AS md, count(*) AS n, " + ", ".join(f"CAST(sum({e}) AS BIGINT) AS {c}" for c, (_, e) in _LONG.items()) + ", round(sum(prepaid) / 1e6, 3) AS prepaid FROM x9 GROUP BY 1, 2")(
    lambda s, d: _steps(s, d).groupBy(KEY, F.col("monthsDelinquent").cast("int").alias("md")).agg(n(), *(F.sum(c).cast("bigint").alias(k) for k, (c, _) in _LONG.items()), r8(F.sum("principalPrepaid") / 1e6, 3).alias("prepaid")))
query("r8_lease_speed", LS + """, sp AS (SELECT sec, min(mi) AS first_mi FROM tape GROUP BY 1), c AS (SELECT pv.*, mi - first_mi AS mfc, max(CASE WHEN mi = first_mi THEN beg END) OVER (PARTITION BY sec, asset) AS cb FROM pv JOIN sp USING (sec)),
both_ AS (SELECT sec AS k2, * FROM c UNION ALL SELECT NULL AS k2, * FROM c), op AS (SELECT k2, sum(CAST(age - mfc AS DOUBLE) * cb) / nullif(sum(CAST(cb AS DOUBLE)), 0) AS wa FROM both_ GROUP BY 1),
g AS (SELECT k2, mfc, 1 - (sum(CAST(beg AS DOUBLE)) / nullif(sum(v0), 0)) / nullif(sum(CAST(endb AS DOUBLE)) / nullif(sum(v1), 0), 0) AS s FROM both_ GROUP BY 1, 2)
SELECT g.k2 AS "securitizationKey", CAST(mfc AS INT) AS "monthsFromCutoffDate", round(s / nullif(1 + s * wa, 0), 6) AS abs_speed FROM g JOIN op ON g.k2 IS NOT DISTINCT FROM op.k2""")(
    lambda s, d: report.lease_speed(lease.as_loans(lease.ages(lease.scheduled_values(_leases(s, d))))).select(KEY, F.col("monthsFromCutoffDate").cast("int").alias("monthsFromCutoffDate"), r8("abs_speed", 6).alias("abs_speed")))
query("le12_ages", LS + S + "CAST(sum(term - lft) AS BIGINT) AS age FROM pv GROUP BY 1")(lambda s, d: lease.ages(_leases(s, d)).groupBy(KEY).agg(F.sum("age").cast("bigint").alias("age")))
query("le14_loan_amount", LS + S + "CAST(sum(term * pay + resid) AS BIGINT) AS amount FROM pv GROUP BY 1")(lambda s, d: lease.loan_amount(_leases(s, d)).groupBy(KEY).agg(F.sum("originalLoanAmount").cast("bigint").alias("amount")))
# bisection instead of Newton's steps: the value grows with the rate
_IMPLIED = TAPE.replace("WITH ", "WITH RECURSIVE ", 1) + """,
lease_ AS (SELECT DISTINCT CAST(term AS DOUBLE) AS n, CAST(orig // term AS DOUBLE) AS pay, CAST(orig * 12 // 10 AS DOUBLE) AS cost, CAST(orig * 4 // 10 AS DOUBLE) AS rest FROM tape),
it_ AS (SELECT 0 AS step, n, pay, cost, rest, -0.4::DOUBLE AS lo, 1.0::DOUBLE AS hi FROM lease_
  UNION ALL SELECT step + 1, n, pay, cost, rest, CASE WHEN low THEN mid ELSE lo END, CASE WHEN low THEN hi ELSE mid END FROM (
    SELECT *, cost - (pay * (1 + mid) * (1 - power(1 + mid, -n)) / mid + rest * power(1 + mid, -n)) < 0 AS low FROM (SELECT *, (lo + hi) / 2 AS mid FROM it_ WHERE step < 60))),
sol_ AS (SELECT n, pay, cost, rest, 12 * greatest((lo + hi) / 2, 0) AS rate FROM it_ WHERE step = 60)
SELECT sec AS "securitizationKey", count(rate) AS solved, round(avg(rate), 6) AS rate FROM tape t LEFT JOIN sol_ ON n = term AND pay = orig // term AND cost = orig * 12 // 10 AND rest = orig * 4 // 10 GROUP BY 1"""
query("le15_implied_rates", _IMPLIED)(lambda s, d: lease.implied_rates(_leases(s, d)).groupBy(KEY).agg(F.count("originalInterestRatePercentage").alias("solved"), r8(F.avg("originalInterestRatePercentage"), 6).alias("rate")))
query("le16_net_losses", LS + S + "CAST(sum(greatest(co - rec // 2, 0)) AS BIGINT) AS nl FROM pv GROUP BY 1")(lambda s, d: lease.enrich.net_losses(_leases(s, d), lease.CO, lease.REPURCHASE).groupBy(KEY).agg(F.sum("netLosses").cast("bigint").alias("nl")))
query("le17_loan_names", LS + S + "CAST(sum(beg) AS BIGINT) AS beg, CAST(sum(co) AS BIGINT) AS co FROM pv GROUP BY 1")(
    lambda s, d: lease.as_loans(_leases(s, d)).groupBy(KEY).agg(F.sum("reportingPeriodBeginningLoanBalanceAmount").alias("beg"), F.sum("chargedoffPrincipalAmount").alias("co")))
_TIER = "CASE WHEN cons <= 640 THEN 1 WHEN cons <= 680 THEN 2 WHEN cons <= 740 THEN 3 WHEN cons > 740 THEN 4 ELSE 0 END"
query("le13_scores_and_tiers", TAPE + """, sc AS (SELECT *, coalesce(lower(score_type), '') AS kind FROM tape),
cs AS (SELECT *, CASE WHEN NOT contains(kind, 'none') AND NOT contains(kind, 'commercial') THEN fico END AS cons, CASE WHEN contains(kind, 'commercial') THEN fico END AS comm FROM sc)""" + S + f"{_TIER} AS tier, CASE state WHEN 'CA' THEN 'West' WHEN 'TX' THEN 'South' WHEN 'FL' THEN 'South' WHEN 'OH' THEN 'Midwest' WHEN 'NJ' THEN 'Northeast' END AS region, count(*) AS n, count(comm) AS comm, round(avg((orig * 12 // 10) / nullif(CAST(veh_value AS DOUBLE), 0)), 6) AS ltv FROM cs GROUP BY 1, 2, 3")(
    lambda s, d: lease.enrich.regions(lease.enrich.prime_indicator(lease.enrich.loan_to_value(lease.enrich.scores(_leases(s, d), "lesseeCreditScore", "lesseeCreditScoreType"), None, "acquisitionCost")), states(s), "lesseeGeographicLocation")
    .groupBy(KEY, F.col("primeIndicator").alias("tier"), "region").agg(n(), F.count("commercialCreditScore").alias("comm"), r8(F.avg("loanToValueRatio"), 6).alias("ltv")))
# leases as filed: makers and models by their old names, discount rates in percent in some trusts
_DIRTY = _E | {
    "vehicleManufacturerName": "CASE WHEN k % 11 <> 0 THEN concat('Brand#', k % 10) END", "vehicleModelName": "CASE WHEN k % 13 <> 0 THEN concat('Model#', k % 6) END",
    "securitizationDiscountRate": "CASE WHEN nk % 2 = 0 THEN (300 + k % 500) / 100.0D WHEN k % 103 = 0 THEN 7.5D WHEN k % 107 = 0 THEN 1.5D ELSE (300 + k % 500) / 10000.0D END", "servicingFeePercentage": "CASE WHEN k % 7 = 0 THEN 0.004D ELSE 0.02D END",
}


def _dirty(s, d):
    models = s.createDataFrame([("Model#0", "Sedan"), ("Model#3", "Van")], "old string, new string")
    return clean.clean(tape(s, d).select(*(F.expr(e).alias(c) for c, e in _DIRTY.items())), "lease", manufacturers(s), models)


_MAKER = "CASE WHEN k % 11 = 0 THEN 'N/A' WHEN k % 2 = 0 THEN 'Maker ' || CAST(k % 10 // 2 AS VARCHAR) ELSE 'Brand#' || CAST(k % 10 AS VARCHAR) END"
_MODEL = "CASE WHEN k % 13 = 0 THEN 'N/A' WHEN k % 6 = 0 THEN 'Sedan' WHEN k % 6 = 3 THEN 'Van' ELSE 'Model#' || CAST(k % 6 AS VARCHAR) END"
query("lc5_makers_and_models", TAPE + S + f"{_MAKER} AS maker, {_MODEL} AS model, count(*) AS n FROM tape GROUP BY 1, 2, 3")(
    lambda s, d: _dirty(s, d).groupBy(KEY, F.col("vehicleManufacturerName").alias("maker"), F.col("vehicleModelName").alias("model")).agg(n()))
query("lc6_rates_and_fees", TAPE + """, rt AS (SELECT sec, CASE WHEN nk % 2 = 0 THEN (300 + k % 500) / 100.0::DOUBLE WHEN k % 103 = 0 THEN 7.5 WHEN k % 107 = 0 THEN 1.5 ELSE (300 + k % 500) / 10000.0::DOUBLE END AS x, CASE WHEN k % 7 = 0 THEN 0.01 ELSE 0.02 END AS fee FROM tape),
st AS (SELECT sec, avg(CAST(x > 1 AS INT)) AS above, max(x) AS most FROM rt GROUP BY 1),
ok AS (SELECT sec, fee, CASE WHEN most > 5 AND above > 0.4 THEN CASE WHEN x > 1 THEN x / 100 ELSE x END WHEN most > 5 AND x > 5 THEN NULL ELSE x END AS y FROM rt JOIN st USING (sec))""" + S + "count(CASE WHEN y <= 1 THEN y END) AS n, round(sum(CASE WHEN y <= 1 THEN y END), 6) AS rate, round(sum(fee), 6) AS fees FROM ok GROUP BY 1")(
    lambda s, d: _dirty(s, d).groupBy(KEY).agg(F.count("securitizationDiscountRate").alias("n"), r8(F.sum("securitizationDiscountRate"), 6).alias("rate"), r8(F.sum("servicingFeePercentage"), 6).alias("fees")))
query("le2_le13_enriched_leases")(lambda s, d: lease.enrich_lease(_leases(s, d)).groupBy(KEY, "monthsDelinquent", "primeIndicator").agg(n(), r8(F.sum("netLosses"), 2).alias("net_losses"), r8(F.sum("recoveredAmount"), 2).alias("recovered")))

query("s8_published", TRUST + " SELECT sec AS securitization_key, month, CAST(pool_beg_balance AS BIGINT) AS pool_beg_balance, CAST(net_losses AS BIGINT) AS net_losses, DATE '2026-01-01' AS as_of FROM trust")(
    lambda s, d: readers.published(named(_trust(s, d), [KEY, "month"], ["pool_beg_balance", "net_losses"]), ["securitization_key", "month", "pool_beg_balance", "net_losses", "as_of"], "2026-01-01"))
query("s9_s12_upsert", TRUST + ' SELECT sec AS "securitizationKey", month, CAST(CASE WHEN year(month) >= 2021 THEN net_losses + 1 ELSE net_losses END AS BIGINT) AS net_losses FROM parts')(
    lambda s, d: readers.upsert(*(lambda t: (t, t.filter("year(month) >= 2021").withColumn("net_losses", F.col("net_losses") + 1)))(named(trust_month_parts(_live(s, d)), [KEY, "month"], ["net_losses"])), [KEY, "month"]))
@query("s11_snapshot_read_back", INDEX + " SELECT 'series' AS part, CAST(month AS VARCHAR) AS date, CAST(n_trusts AS DOUBLE) AS n_trusts, round(delq30plus, 8) AS value FROM marks UNION ALL SELECT 'latest', CAST(month AS VARCHAR), CAST(n_trusts AS DOUBLE), round(delq30plus, 8) FROM marks WHERE month = (SELECT max(month) FROM marks) UNION ALL SELECT 'own roll', CAST(month AS VARCHAR), NULL, round(roll_c_to_30, 8) FROM marks")
def _snapshot(s, d):
    """The snapshot's JSON, read back as rows."""
    marks = named(_index(s, d), ["month"], ["n_trusts"], ["delq30plus", "roll_c_to_30"])
    own = marks.select(F.lit("own").alias("series"), F.lit("roll").alias("metric"), F.col("month").cast("string").alias("date"), F.col("roll_c_to_30").alias("value"))
    made = readers.snapshot(marks, ["n_trusts", "delq30plus"], own)
    point, each = "date string, n_trusts double, delq30plus double", "array<struct<series:string,metric:string,points:array<struct<date:string,value:double>>>>"
    series = made.select(F.inline(F.from_json("series", "array<struct<date:string,n_trusts:double,delq30plus:double>>"))).select(F.lit("series").alias("part"), "date", "n_trusts", F.col("delq30plus").alias("value"))
    latest = made.select(F.from_json("latest", point).alias("p")).select(F.lit("latest"), "p.date", "p.n_trusts", "p.delq30plus")
    marks_ = made.select(F.inline(F.from_json("benchmarks", each))).select(F.concat_ws(" ", "series", "metric").alias("part"), F.inline("points")).select("part", "date", F.lit(None).cast("double"), "value")
    return series.union(latest).union(marks_)


query("s11_snapshot")(lambda s, d: readers.snapshot(named(_index(s, d), ["month"], ["n_trusts"], ["delq30plus"]), ["n_trusts", "delq30plus"], named(_index(s, d), ["month"], [], ["roll_c_to_30"]).select(F.lit("own").alias("series"), F.lit("roll").alias("metric"), F.col("month").cast("string").alias("date"), F.col("roll_c_to_30").alias("value"))))
query("s1_raw_rows", TAPE + S + "CAST(sum(1 + CAST(k % 17 = 0 AS INT)) AS BIGINT) AS n FROM tape GROUP BY 1")(lambda s, d: raw_tape(s, d).groupBy(KEY).agg(n()))

"""Loan-month table queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import loantable as lt
from ..operators import stress, universe
from .index_queries import INDEX, PCA, UNI, _index, _uni
from .registry import TAPE, named, query, r8
from .tape import floor_cents, loans

LEAN = UNI + """,
lean AS (SELECT t.sec, t.asset, t.month, t.fico, t.term, t.term - t.age AS rem, t.apr_bps / 10000.0::DOUBLE AS rate, t.orig, t.beg, t.endb, t.interest, t.co, t.rec, t.dpd, t.md,
  u.exited IS NULL OR t.month < u.exited AS in_index FROM tape t LEFT JOIN ex u USING (sec))"""
_D = "CAST(endb AS DOUBLE)"
BUCKETS = LEAN + """,
bucket AS (SELECT month, rem, round(CAST(rate AS DECIMAL(20, 8)) * 200)::DOUBLE / 200 AS rb, sum(endb) AS bal FROM lean WHERE in_index AND endb > 0 AND rem BETWEEN 1 AND 90 AND rate >= 0 GROUP BY 1, 2, 3),
life AS (SELECT *, CASE WHEN rb <= 0 THEN (rem + 1) / 2.0 ELSE
  ((rb / 12) / (1 - power(1 + rb / 12, -CAST(rem AS DOUBLE))) - rb / 12) * (1 - (rem + 1) * power(1 + rb / 12, CAST(rem AS DOUBLE)) + rem * power(1 + rb / 12, CAST(rem + 1 AS DOUBLE))) / power(rb / 12, 2) END AS wal FROM bucket),
sched AS (SELECT month, sum(wal * CAST(bal AS DOUBLE)) / sum(CAST(bal AS DOUBLE)) AS scheduled_wal FROM life GROUP BY month),
deals AS (SELECT sec, month, sum(beg) AS b, sum(endb) AS e, sum(CASE WHEN rem BETWEEN 1 AND 90 THEN CAST(rem AS DOUBLE) * endb END) / nullif(sum(CASE WHEN rem BETWEEN 1 AND 90 THEN CAST(endb AS DOUBLE) END), 0) AS wa_rem
  FROM lean WHERE in_index AND endb >= 0 AND beg > 0 GROUP BY sec, month),
speed AS (SELECT *, greatest(avg(1 - CAST(e AS DOUBLE) / CAST(b AS DOUBLE)) OVER (PARTITION BY sec ORDER BY month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 0.003) AS eff FROM deals),
real AS (SELECT month, sum(least(1 / eff, coalesce(wa_rem, 1e300)) * CAST(e AS DOUBLE)) / nullif(sum(CAST(e AS DOUBLE)), 0) AS realized_wal FROM speed WHERE e > 0 GROUP BY month),
comp AS (SELECT month, count(*) AS n_loans, CAST(sum(endb) AS BIGINT) AS balance, sum(CASE WHEN fico BETWEEN 300 AND 850 THEN CAST(fico AS DOUBLE) * endb END) / sum(CASE WHEN fico BETWEEN 300 AND 850 THEN CAST(endb AS DOUBLE) END) AS wa_fico,
  sum(CASE WHEN term BETWEEN 1 AND 120 THEN CAST(term AS DOUBLE) * endb END) / sum(CASE WHEN term BETWEEN 1 AND 120 THEN CAST(endb AS DOUBLE) END) AS wa_orig_term,
  sum(CASE WHEN rem BETWEEN 1 AND 90 THEN CAST(rem AS DOUBLE) * endb END) / sum(CASE WHEN rem BETWEEN 1 AND 90 THEN CAST(endb AS DOUBLE) END) AS wa_rem_term FROM lean WHERE in_index AND endb > 0 GROUP BY month),
agg AS (SELECT month, count(DISTINCT sec) AS n_trusts, sum(interest) AS ic, sum(rate * CAST(beg AS DOUBLE)) AS ia, sum(co) AS co, sum(rec) AS rec, sum((CAST(beg AS DOUBLE) + CAST(endb AS DOUBLE)) / 2) AS ab, sum(beg) AS beg FROM lean WHERE in_index GROUP BY month)"""


def _lean(spark, d):
    rows = loans(spark, d)
    return lt.lean(rows, universe.exits(rows))


query("e19_lean_projection", LEAN + " SELECT sec AS \"securitizationKey\", month AS report_month, count(*) AS n, CAST(sum(fico) AS BIGINT) AS scores, CAST(sum(rem) AS BIGINT) AS rem, CAST(sum(md) AS BIGINT) AS md, count_if(in_index)::BIGINT AS inside FROM lean GROUP BY 1, 2")(
    lambda s, d: _lean(s, d).groupBy("securitizationKey", "report_month").agg(F.count(F.lit(1)).alias("n"), F.sum("credit_score").alias("scores"), F.sum("rem_term").alias("rem"), F.sum("months_delinquent").alias("md"), F.count_if("in_index").alias("inside")))
query("e20_trust_ids", TAPE + ' SELECT sec AS "securitizationKey", CAST(row_number() OVER (ORDER BY sec) AS INT) AS trust_id FROM (SELECT DISTINCT sec FROM tape)')(lambda s, d: lt.trust_ids(loans(s, d)))
query("e21_trusts_to_load", UNI + " SELECT sec AS \"securitizationKey\" FROM uni WHERE qualifies AND sec NOT LIKE '%2018%'")(
    lambda s, d: lt.to_load(_uni(s, d), _uni(s, d).filter("securitizationKey like '%2018%'")).select("securitizationKey"))
query("q1_composition", BUCKETS + " SELECT month AS report_month, n_loans, balance, round(wa_fico, 6) AS wa_fico, round(wa_orig_term, 6) AS wa_orig_term, round(wa_rem_term, 6) AS wa_rem_term FROM comp")(
    lambda s, d: named(lt.composition(_lean(s, d)), ["report_month"], ["n_loans", "balance"], ["wa_fico", "wa_orig_term", "wa_rem_term"], 6))
_MINUS = BUCKETS.replace("t.apr_bps / 10000.0::DOUBLE AS rate", "CASE WHEN t.k % 7 = 3 THEN -0.01 WHEN t.k % 7 = 4 THEN NULL ELSE t.apr_bps / 10000.0::DOUBLE END AS rate")
_NO_RATE = "CASE CAST(asset_number AS BIGINT) % 7 WHEN 3 THEN -0.01D WHEN 4 THEN NULL ELSE rate END"
query("q2_rate_buckets", _MINUS + " SELECT month AS report_month, CAST(rem AS BIGINT) AS rem_term, round(rb, 6) AS rate_bucket, CAST(bal AS BIGINT) AS balance FROM bucket")(
    lambda s, d: named(lt.rate_buckets(_lean(s, d).withColumn("rate", F.expr(_NO_RATE))), ["report_month"], ["rem_term", "balance"], ["rate_bucket"], 6))
query("q3_level_pay_life", BUCKETS + " SELECT CAST(rem AS BIGINT) AS rem_term, round(rb, 6) AS rate_bucket, round(wal, 6) AS wal FROM (SELECT DISTINCT rem, rb, wal FROM life)")(
    lambda s, d: lt.rate_buckets(_lean(s, d)).select(F.col("rem_term").cast("bigint").alias("rem_term"), r8("rate_bucket", 6).alias("rate_bucket"), r8(lt.level_pay_wal(F.col("rem_term"), F.col("rate_bucket")), 6).alias("wal")).distinct())
query("q4_scheduled_wal", BUCKETS + " SELECT month AS report_month, round(scheduled_wal, 6) AS scheduled_wal FROM sched")(lambda s, d: named(lt.scheduled_wal(lt.rate_buckets(_lean(s, d))), ["report_month"], [], ["scheduled_wal"], 6))
query("q5_run_off", BUCKETS + ' SELECT sec AS "securitizationKey", month AS report_month, CAST(b AS BIGINT) AS beg, CAST(e AS BIGINT) AS "end", round(wa_rem, 6) AS wa_rem FROM deals')(
    lambda s, d: named(lt.run_off(_lean(s, d)), ["securitizationKey", "report_month"], ["beg", "end"], ["wa_rem"], 6))
query("q6_realized_wal", BUCKETS + " SELECT month AS report_month, round(realized_wal, 6) AS realized_wal FROM real")(lambda s, d: named(lt.realized_wal(lt.run_off(_lean(s, d))), ["report_month"], [], ["realized_wal"], 6))
query("q7_composition_report", BUCKETS + " SELECT month AS report_month, n_loans, balance, round(wa_fico, 2) AS wa_fico, round(wa_orig_term, 2) AS wa_orig_term, round(wa_rem_term, 2) AS wa_rem_term, round(scheduled_wal, 2) AS scheduled_wal, round(realized_wal, 2) AS realized_wal FROM comp LEFT JOIN sched USING (month) LEFT JOIN real USING (month)")(
    lambda s, d: lt.composition_report_of_loans(loans(s, d)).withColumn("balance", F.col("balance").cast("bigint")))
query("q8_month_aggregate", BUCKETS + " SELECT month AS report_month, n_trusts, CAST(ic AS BIGINT) AS interest_cash, round(ia, 0) AS interest_accrued, CAST(co AS BIGINT) AS charge_off, CAST(rec AS BIGINT) AS recovered, ab AS avg_balance, CAST(beg AS BIGINT) AS beg_balance FROM agg")(
    lambda s, d: named(lt.month_aggregate(_lean(s, d)), ["report_month", "n_trusts", "avg_balance"], ["interest_cash", "charge_off", "recovered", "beg_balance"], ["interest_accrued"], 0))
_NY = """, ny AS (SELECT month, n_trusts, round(100 * (12 * CAST(ic AS DOUBLE) / ab), 3) AS gross_cash, round(100 * (ia / ab), 3) AS gross_accrued, round(100 * (12 * (CAST(co AS DOUBLE) - rec) / ab), 3) AS net_loss,
  round(100 * (12 * CAST(ic AS DOUBLE) / ab - 12 * (CAST(co AS DOUBLE) - rec) / ab), 3) AS net_cash, round(100 * (ia / ab - 12 * (CAST(co AS DOUBLE) - rec) / ab), 3) AS net_accrued FROM agg WHERE ab > 0)"""
query("q9_net_yield", BUCKETS + _NY + " SELECT month AS report_month, n_trusts, gross_cash, gross_accrued, net_loss, net_cash, net_accrued FROM ny")(lambda s, d: lt.net_yield(lt.month_aggregate(_lean(s, d))))
_MIX = BUCKETS + INDEX[len(UNI):]
query("q10_site_merge", _MIX + " SELECT m.month, round(100 * m.delq30plus, 2) AS delq30_pct, round(m.stress_index_zavg, 3) AS stress, c.n_loans, round(c.wa_fico, 1) AS wa_fico FROM marks m LEFT JOIN comp c USING (month)")(
    lambda s, d: _index(s, d).join(lt.composition(_lean(s, d)).withColumnRenamed("report_month", "month"), "month", "left").select("month", F.round(100 * F.col("delq30plus"), 2).alias("delq30_pct"), F.round("stress_index_zavg", 3).alias("stress"), "n_loans", F.round("wa_fico", 1).alias("wa_fico")))
query("q11_align_series", _MIX + " , a AS (SELECT month, round(delq30plus, 8) AS v FROM marks), b AS (SELECT month, round(wa_fico, 6) AS v FROM comp) SELECT month, a.v AS delq30plus, b.v AS wa_fico FROM a FULL JOIN b USING (month)")(
    lambda s, d: lt.align({"delq30plus": _index(s, d).select("month", r8("delq30plus").alias("value")), "wa_fico": lt.composition(_lean(s, d)).select(F.col("report_month").alias("month"), r8("wa_fico", 6).alias("value"))}))
query("q12_decembers_and_latest", INDEX + " SELECT month, round(net_yield_annl, 8) AS net_yield_annl FROM marks WHERE month(month) = 12 OR month = (SELECT max(month) FROM marks)")(
    lambda s, d: named(lt.decembers_and_latest(_index(s, d)), ["month"], [], ["net_yield_annl"]))
query("q13_method_difference", PCA + " SELECT round(max(abs(stress_index_pca - stress_index_zavg)), 6) AS max_abs, round(corr(stress_index_pca, stress_index_zavg), 6) AS correlation FROM both_")(lambda s, d: named(lt.method_difference(_index(s, d, method="pca")), [], [], ["max_abs", "correlation"], 6))
query("q14_published_levels", INDEX + ", lv AS (SELECT month, CAST(round(greatest(100 + 25 * round(stress_index_zavg, 4), 0.01) * 1e8) AS BIGINT) AS answer FROM marks WHERE stress_index_zavg IS NOT NULL), ch AS (SELECT *, lag(answer) OVER (ORDER BY month) AS was FROM lv) SELECT month, answer, CAST(row_number() OVER (ORDER BY month) AS INT) AS round_id FROM ch WHERE was IS NULL OR was <> answer")(
    lambda s, d: lt.publish_levels(_index(s, d).withColumn("stress_index", F.round("stress_index", 4))))

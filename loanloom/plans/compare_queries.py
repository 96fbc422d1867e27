"""Benchmark, position-book and feature queries."""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..functions.scratch import settled
from ..operators import book, compare, features, forests
from .index_queries import INDEX, _index
from .registry import TAPE, named, query, r8
from .tape import loans, tape

_Q = INDEX + """,
qs AS (SELECT last_day((date_trunc('quarter', month) + INTERVAL 2 MONTH)::DATE) AS quarter, avg(delq30plus) AS delq30plus, 1 - product(1 - roll_c_to_30) AS roll, min(n_trusts) AS n_trusts FROM marks GROUP BY 1),
qb AS (SELECT *, delq30plus + ((year(quarter) * 4 + month(quarter) // 3) * 37 % 11) / 1000.0::DOUBLE AS bench FROM qs)"""


def _quarters(s, d):
    m = _index(s, d)
    q = compare.quarterly(m, ["delq30plus"], ["roll_c_to_30"]).withColumnRenamed("roll_c_to_30", "roll")
    n = m.groupBy(compare.quarter_end(F.col("month")).alias("quarter")).agg(F.min("n_trusts").alias("n_trusts"))
    return q.join(n, "quarter").withColumn("bench", F.col("delq30plus") + F.expr("((year(quarter) * 4 + month(quarter) div 3) * 37 % 11) / 1000.0D"))


query("b1_quarterly", _Q + " SELECT quarter, round(delq30plus, 8) AS delq30plus, round(roll, 8) AS roll FROM qs")(lambda s, d: named(_quarters(s, d), ["quarter"], [], ["delq30plus", "roll"]))
_CORR = """, rk AS (SELECT *, rank() OVER (ORDER BY delq30plus) + (count(*) OVER (PARTITION BY delq30plus) - 1) / 2.0 AS ra, rank() OVER (ORDER BY bench) + (count(*) OVER (PARTITION BY bench) - 1) / 2.0 AS rb FROM qb WHERE delq30plus IS NOT NULL)"""
query("b2_correlations", _Q + _CORR + " SELECT 'all' AS k, count(*) AS n, round(corr(delq30plus, bench), 6) AS pearson, round(corr(ra, rb), 6) AS spearman FROM rk")(
    lambda s, d: named(compare.correlations(_quarters(s, d).withColumn("k", F.lit("all")), ["k"], "delq30plus", "bench"), ["k", "n"], [], ["pearson", "spearman"], 6))
query("b3_correlation_grid", _Q + " SELECT scope, metric, count(*) AS n, round(corr(a, bench), 6) AS pearson FROM (SELECT 'full' AS scope, 'delq30plus' AS metric, delq30plus AS a, bench, n_trusts FROM qb UNION ALL SELECT 'full', 'roll', roll, bench, n_trusts FROM qb UNION ALL SELECT 'enough', 'delq30plus', delq30plus, bench, n_trusts FROM qb WHERE n_trusts >= 4 UNION ALL SELECT 'enough', 'roll', roll, bench, n_trusts FROM qb WHERE n_trusts >= 4) WHERE a IS NOT NULL GROUP BY 1, 2")(
    lambda s, d: named(compare.correlation_grid(_quarters(s, d), ["delq30plus", "roll"], ["bench"]), ["scope", "metric", "n"], [], ["pearson"], 6))
query("b4_aligned_tail", _Q + " SELECT quarter, round(delq30plus, 8) AS delq30plus, round(bench, 8) AS bench FROM qb ORDER BY quarter DESC LIMIT 10")(lambda s, d: named(_quarters(s, d).orderBy(F.col("quarter").desc()).limit(10), ["quarter"], [], ["delq30plus", "bench"]))
query("b5_standardised", _Q + ", ws AS (SELECT avg(bench) AS m, stddev_samp(bench) AS sd FROM qb WHERE quarter BETWEEN DATE '2019-01-01' AND DATE '2023-12-31') SELECT quarter, round((bench - m) / coalesce(nullif(sd, 0), 1), 6) AS bench FROM qb, ws")(
    lambda s, d: named(compare.standardised(_quarters(s, d), ["bench"], "2019-01-01", "2023-12-31"), ["quarter"], [], ["bench"], 6))
query("b6_annualised", _Q + " SELECT quarter, round(1 - power(1 - roll, 4), 8) AS roll FROM qs")(lambda s, d: _quarters(s, d).select("quarter", r8(compare.annualised(F.col("roll"), 4)).alias("roll")))

_P = INDEX + """,
lv AS (SELECT month, round(100 + 25 * stress_index_zavg, 4) AS level, round(100 * net_loss_annl, 6) AS net_loss, row_number() OVER (ORDER BY month) - 1 AS j FROM marks),
ps AS (SELECT DISTINCT k AS position, CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END AS side, k % 48 AS a, k % 48 + 6 + k % 30 AS z FROM tape),
pt AS (SELECT position, side, lv.month, level, net_loss, first_value(level) OVER w AS p0, count(*) OVER (PARTITION BY position) AS n FROM ps JOIN lv ON j BETWEEN a AND z WHERE level IS NOT NULL WINDOW w AS (PARTITION BY position ORDER BY month)),
pr AS (SELECT *, coalesce(side * 100000.0::DOUBLE * (level - lag(level) OVER w) / p0, 0) AS mtm FROM pt WHERE n >= 2 AND p0 > 0 WINDOW w AS (PARTITION BY position ORDER BY month)),
pf AS (SELECT *, sum(mtm) OVER (PARTITION BY position ORDER BY month) AS pnl FROM pr)"""


def _marks(s, d):
    return settled(_index(s, d)).select("month", F.round(100 + 25 * F.col("stress_index_zavg"), 4).alias("level"), F.round(100 * F.col("net_loss_annl"), 6).alias("net_loss"))


def _paths(s, d, marks=None):
    marks = _marks(s, d) if marks is None else marks
    first = marks.agg(F.min("month").alias("m0"))
    ids = tape(s, d).select(F.col("k").alias("position")).distinct().join(first)
    at = lambda e: F.add_months("m0", F.expr(e).cast("int"))
    positions = ids.select("position", F.when(F.col("position") % 2 == 0, 1).otherwise(-1).alias("side"), at("position % 48").alias("entry"), at("position % 48 + 6 + position % 30").alias("exit"), F.lit(100000.0).alias("notional"))
    return book.paths(positions, marks.select("month", "level"))


_pf = lambda s, d: book.profits(_paths(s, d))
query("x1_paths", _P + " SELECT position, count(*) AS n, CAST(min(p0) AS DOUBLE) AS p0 FROM pr GROUP BY 1")(lambda s, d: _paths(s, d).groupBy("position").agg(F.count(F.lit(1)).alias("n"), F.min("p0").alias("p0")))
query("x2_profits", _P + " SELECT position, month, round(pnl, 4) AS pnl FROM pf")(lambda s, d: named(_pf(s, d), ["position", "month"], [], ["pnl"], 4))
query("x3_risk", _P + ", fl AS (SELECT *, pnl - max(pnl) OVER (PARTITION BY position ORDER BY month) AS fall FROM pf) SELECT position, round(arg_max(pnl, month), 4) AS total, round(stddev_pop(mtm), 4) AS volatility, round(min(fall), 4) AS drawdown FROM fl GROUP BY 1")(lambda s, d: named(book.risk(_pf(s, d)), ["position"], [], ["total", "volatility", "drawdown"], 4))
_CALLS = _P.replace("WITH ", "WITH RECURSIVE ", 1) + """,
st_ AS MATERIALIZED (SELECT position, mtm, row_number() OVER (PARTITION BY position ORDER BY month) AS r, count(*) OVER (PARTITION BY position) AS last FROM pr),
it_ AS (SELECT position, 0::BIGINT AS r, 20000.0::DOUBLE AS equity, 0.0::DOUBLE AS topped, 0 AS calls FROM (SELECT DISTINCT position FROM st_)
  UNION ALL SELECT position, r, CASE WHEN e < 10000 THEN 20000 ELSE e END, topped + CASE WHEN e < 10000 THEN 20000 - e ELSE 0 END, calls + CAST(e < 10000 AS INT) FROM (
    SELECT s.position, s.r, equity + mtm AS e, topped, calls FROM it_ i JOIN st_ s ON s.position = i.position AND s.r = i.r + 1))
SELECT i.position, calls, round(topped, 4) AS topped, round(equity, 4) AS equity FROM it_ i JOIN (SELECT DISTINCT position, last FROM st_) l ON l.position = i.position AND l.last = i.r"""
query("x4_margin_calls", _CALLS)(lambda s, d: named(book.margin_calls(_pf(s, d)), ["position", "calls"], [], ["topped", "equity"], 4))
query("x5_liquidations", _P + ", lq AS (SELECT position, min(CASE WHEN 20000 + pnl < 10000 THEN month END) AS liquidated, max(month) AS fin FROM pf GROUP BY 1) SELECT position, liquidated, round(greatest(20000 + pnl, 0), 4) AS payout FROM pf JOIN lq USING (position) WHERE month = coalesce(liquidated, fin)")(
    lambda s, d: named(book.liquidations(_pf(s, d)), ["position", "liquidated"], [], ["payout"], 4))
query("x6_hedge", _P + " SELECT position, month, round(sum(-1e6 * net_loss / 12 / 100) OVER (PARTITION BY position ORDER BY month) + 0.5 * 1e6 * (level / p0 - 1), 3) AS net FROM pr")(
    lambda s, d: (lambda marks: named(book.hedge(_paths(s, d, marks), marks.select("month", "net_loss"), 1e6, 0.5), ["position", "month"], [], ["net"], 3))(_marks(s, d)))

query("f1_regressor_profile", TAPE + ", c AS (SELECT state AS v, count(*) AS n FROM tape GROUP BY 1) SELECT 'obligorGeographicLocation' AS field, CAST(sum(n) AS BIGINT) AS rows, arg_max(v, n) AS top, round(max(n) / sum(n), 8) AS top_share FROM c")(
    lambda s, d: features.profile(loans(s, d), ["obligorGeographicLocation"]).select("field", "rows", "top", r8("top_share").alias("top_share")))
_ENCODED = TAPE + """,
vals_ AS (SELECT v, n, n / sum(n) OVER () AS share, row_number() OVER (ORDER BY n DESC, v DESC) AS place, count(*) OVER () AS vals
  FROM (SELECT CAST(new_used AS VARCHAR) AS v, count(*) AS n FROM tape WHERE new_used IS NOT NULL GROUP BY 1)),
tops_ AS (SELECT *, max(share) OVER () AS top FROM vals_),
cuts_ AS (SELECT quantile_cont(fico, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]) AS c FROM tape),
steps_ AS (SELECT unnest(range(8)) AS tenth)
SELECT 'vehicleNewUsedCode_is_' || v AS flag, CAST(n AS BIGINT) AS n FROM tops_
WHERE vals > 1 AND CASE WHEN top >= 0.9 THEN place = 1 ELSE share > 0.15 AND place < vals END
UNION ALL
SELECT 'consumerCreditScore_p' || CAST(10 * tenth AS VARCHAR), CAST((SELECT count(*) FROM tape, cuts_ WHERE fico >= c[tenth + 1] AND fico < c[tenth + 2]) AS BIGINT) FROM steps_"""


@query("f1_encoded", _ENCODED)
def _encoded(s, d):
    rows = loans(s, d).select("vehicleNewUsedCode", "consumerCreditScore")
    out = features.encode(rows, rows.columns)
    flags = [c for c in out.columns if c not in rows.columns]
    return out.agg(*(F.sum(c).alias(c) for c in flags)).unpivot([], flags, "flag", "n")


def _importances(s, d):
    found, area = features.importances(loans(s, d), ["consumerCreditScore", "originalLoanTerm", "age", "vehicleTypeCode"])
    return found.select("feature", F.round("importance", 6).alias("importance"), F.lit(round(area, 6)).alias("area"))


query("f2_importances")(_importances)
#: Fields of the default model that the tape has.
MODEL = ["obligorIncomeVerificationLevelCode", "originalInterestRatePercentage", "originalLoanTerm", "paymentToIncomePercentage", "vehicleModelYear", "vehicleNewUsedCode", "vehicleTypeCode", "consumerCreditScore", "age", "vintage"]


def _forests(s, d):
    rows = loans(s, d).select("securitizationKey", "assetNumber", "monthsDelinquent", *MODEL)
    return forests.forests(forests.with_all(rows), MODEL, depth=6)


@query("f2_trust_forests")
def _trust_forests(s, d):
    """Importances of every trust and of all together, with the areas on the rows grown on and on those held back."""
    importance, scores = _forests(s, d)
    area = forests.areas(forests.cumulated(scores, ["securitizationKey", "held"]), ["securitizationKey", "held"])
    wide = area.groupBy("securitizationKey").agg(F.max(F.when(~F.col("held"), F.col("area"))).alias("area"), F.max(F.when(F.col("held"), F.col("area"))).alias("held_area"))
    return importance.join(wide, "securitizationKey", "left").select("securitizationKey", "feature", "rank", *(F.round(c, 6).alias(c) for c in ("importance", "area", "held_area")))


@query("f2_trust_roc")
def _trust_roc(s, d):
    """The curves of these forests on the rows they were grown on, at 101 places."""
    scores = _forests(s, d)[1].filter("not held")
    return named(forests.curve(forests.cumulated(scores, ["securitizationKey"]), ["securitizationKey"]), ["securitizationKey"], [], ["false_rate", "true_rate"])


_ROC = TAPE + """,
sc AS (SELECT sec, 850 - fico AS score, count(*) AS n, sum(CASE WHEN md IN (2, 3, 4, 5) THEN 1 ELSE 0 END) AS bad FROM tape GROUP BY 1, 2),
st AS (SELECT sec, n - bad AS good, bad, sum(n - bad) OVER w - (n - bad) AS good0, sum(bad) OVER w - bad AS bad0, sum(n - bad) OVER (PARTITION BY sec) AS goods, sum(bad) OVER (PARTITION BY sec) AS bads
  FROM sc WINDOW w AS (PARTITION BY sec ORDER BY score DESC))"""


def _steps(s, d):
    bad = F.col("monthsDelinquent").isin(2, 3, 4, 5).cast("int")
    scores = loans(s, d).select("securitizationKey", (850 - F.col("consumerCreditScore")).alias("score"), F.lit(1).alias("n"), bad.alias("bad"))
    return forests.cumulated(scores, ["securitizationKey"])


query("f2_roc", _ROC + """ SELECT sec AS "securitizationKey", round(k / 100.0::DOUBLE, 8) AS false_rate, round((bad0 + bad * (k * goods / 100.0::DOUBLE - good0) / good) / bads, 8) AS true_rate
FROM st JOIN (SELECT unnest(range(0, 100)) AS k) ON k * goods >= 100 * good0 AND k * goods < 100 * (good0 + good) WHERE goods > 0 AND bads > 0
UNION ALL SELECT DISTINCT sec, 1.0::DOUBLE, 1.0::DOUBLE FROM st WHERE goods > 0 AND bads > 0""")(
    lambda s, d: named(forests.curve(_steps(s, d), ["securitizationKey"]), ["securitizationKey"], [], ["false_rate", "true_rate"]))
query("f2_area", _ROC + """ SELECT sec AS "securitizationKey", round(sum(good * (bad0 + bad / 2.0::DOUBLE)) / goods / bads, 8) AS area FROM st WHERE goods > 0 AND bads > 0 GROUP BY sec, goods, bads""")(
    lambda s, d: named(forests.areas(_steps(s, d), ["securitizationKey"]), ["securitizationKey"], [], ["area"]))
_FLAGGED = TAPE + """,
cells_ AS (SELECT sec, 'vehicleNewUsedCode' AS field, CAST(new_used AS VARCHAR) AS v FROM tape UNION ALL SELECT sec, 'obligorCreditScoreType', score_type FROM tape),
vals_ AS (SELECT sec, field, v, count(*) AS n FROM cells_ GROUP BY 1, 2, 3),
tops_ AS (SELECT *, sum(n) OVER f AS total, sum(CASE WHEN v IS NOT NULL THEN n ELSE 0 END) OVER f AS filled, count(v) OVER f AS vals, max(CASE WHEN v IS NOT NULL THEN n END) OVER f AS most,
  row_number() OVER (PARTITION BY sec, field ORDER BY v IS NULL, n DESC, v DESC) AS place FROM vals_ WINDOW f AS (PARTITION BY sec, field)),
cuts_ AS (SELECT sec, quantile_cont(CAST(fico AS DOUBLE), [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]) AS c, max(n) AS most, sum(n) AS total, count(*) AS vals FROM (SELECT sec, fico, count(*) OVER (PARTITION BY sec, fico) AS n FROM tape) GROUP BY sec),
few_ AS (SELECT sec, count(*) AS rows, max(n) AS most, count(DISTINCT fico) AS vals FROM (SELECT sec, fico, count(*) OVER (PARTITION BY sec, fico) AS n FROM tape) GROUP BY sec)
SELECT sec AS "securitizationKey", field || '_is_' || v AS flag, NULL::DOUBLE AS lo FROM tops_ WHERE vals > 1 AND filled > 0.2 * total AND v IS NOT NULL
  AND CASE WHEN most >= 0.9 * filled THEN place = 1 WHEN most >= 0.1 * filled THEN n > 0.15 * filled AND place < vals ELSE false END
UNION ALL SELECT sec, field || '_null', NULL FROM tops_ WHERE v IS NULL AND filled > 0
UNION ALL SELECT sec, 'consumerCreditScore_p' || CAST(10 * k AS VARCHAR), round(c[k + 1], 6) FROM cuts_ JOIN few_ f USING (sec), (SELECT unnest(range(8)) AS k) WHERE f.vals > 1 AND f.most < 0.1 * f.rows
UNION ALL SELECT sec, 'consumerCreditScore_is_' || CAST(fico AS VARCHAR), NULL FROM (
  SELECT sec, fico, n, f.rows, f.vals, f.most, row_number() OVER (PARTITION BY sec ORDER BY n DESC, CAST(fico AS VARCHAR) DESC) AS place FROM (SELECT sec, fico, count(*) AS n FROM tape GROUP BY 1, 2) JOIN few_ f USING (sec))
  WHERE vals > 1 AND CASE WHEN most >= 0.9 * rows THEN place = 1 WHEN most >= 0.1 * rows THEN n > 0.15 * rows AND place < vals ELSE false END"""
query("f1_trust_flags", _FLAGGED)(
    lambda s, d: forests.rules(loans(s, d).select("securitizationKey", "vehicleNewUsedCode", "obligorCreditScoreType", "consumerCreditScore"), ["vehicleNewUsedCode", "obligorCreditScoreType", "consumerCreditScore"]).select("securitizationKey", "flag", F.round("lo", 6).alias("lo")))
query("f3_f4_interactions", TAPE + ", b AS (SELECT CASE WHEN fico < hi THEN CAST(least(floor((fico - lo) / ((hi - lo) / 7.0)), 6) AS INT) ELSE 0 END AS fb, veh_type - 1 AS vb, md FROM tape, (SELECT CAST(min(fico) AS DOUBLE) AS lo, CAST(max(fico) AS DOUBLE) AS hi FROM tape)) SELECT fb AS \"consumerCreditScore_bucket\", CAST(vb AS INT) AS \"vehicleTypeCode_bucket\", round(avg(CASE WHEN md IN (2, 3, 4, 5) THEN 1.0 ELSE 0 END), 8) AS bad_share, count(*) AS n FROM b GROUP BY 1, 2")(
    lambda s, d: features.interactions(features.bucketed(loans(s, d), ["consumerCreditScore", "vehicleTypeCode"]), "consumerCreditScore_bucket", "vehicleTypeCode_bucket").withColumn("bad_share", r8("bad_share")))
_FIELDS = {"consumerCreditScore": "fb", "originalLoanTerm": "tb", "vehicleTypeCode": "vb", "obligorGeographicLocation": "sb"}
_TABLES = TAPE + """,
b AS (SELECT CASE WHEN fico < hi THEN CAST(least(floor((fico - lo) / ((hi - lo) / 7.0)), 6) AS INT) ELSE 0 END AS fb,
  CAST(dense_rank() OVER (ORDER BY term) - 1 AS INT) AS tb, CAST(dense_rank() OVER (ORDER BY veh_type) - 1 AS INT) AS vb, CAST(dense_rank() OVER (ORDER BY state) - 1 AS INT) AS sb,
  CASE WHEN md IN (2, 3, 4, 5) THEN 1.0 ELSE 0 END AS bad FROM tape, (SELECT CAST(min(fico) AS DOUBLE) AS lo, CAST(max(fico) AS DOUBLE) AS hi FROM tape))
SELECT field_a, field_b, bucket_a, bucket_b, round(avg(bad), 8) AS bad_share, count(*) AS n FROM (""" + " UNION ALL ".join(
    f"SELECT '{x}' AS field_a, '{y}' AS field_b, {_FIELDS[x]} AS bucket_a, {_FIELDS[y]} AS bucket_b, bad FROM b" for x, y in combinations(_FIELDS, 2)
) + ") GROUP BY 1, 2, 3, 4"
query("f4_interaction_tables", _TABLES)(lambda s, d: features.interaction_tables(loans(s, d), list(_FIELDS)).withColumn("bad_share", r8("bad_share")))
query("f5_bootstrap")(lambda s, d: features.bootstrap(loans(s, d)).groupBy("securitizationKey").agg(F.count(F.lit(1)).alias("n")))

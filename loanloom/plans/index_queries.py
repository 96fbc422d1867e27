"""Universe, metrics, pooling, stress and cohort queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scratch import settled
from ..operators import metrics, stress, universe
from .registry import TAPE, named, query, r8
from .tape import floor_cents, loans

UNI = TAPE + """,
fm AS (SELECT sec, min(month) AS first_month, max(month) AS last_month, count(DISTINCT asset) AS n_loans, max(CASE WHEN i = 0 THEN 1 ELSE 0 END) AS cut FROM tape GROUP BY sec),
snap AS (SELECT t.* FROM tape t JOIN fm USING (sec) WHERE CASE WHEN cut = 1 THEN i = 0 ELSE month = first_month END),
iss AS (SELECT sec, sum(CAST(fico AS DOUBLE) * orig) / sum(CAST(orig AS DOUBLE)) AS wavg_fico,
  CAST(CASE WHEN sum(CASE WHEN i = 0 THEN beg END) > 0 THEN sum(CASE WHEN i = 0 THEN beg END) WHEN sum(beg) > 0 THEN sum(beg) ELSE sum(orig) END AS DOUBLE) AS original_pool FROM snap GROUP BY sec),
ends AS (SELECT sec, month, sum(endb) AS e FROM tape GROUP BY sec, month),
ex AS (SELECT sec, min(CASE WHEN e < 0.1 * original_pool THEN month END) AS exited FROM ends JOIN iss USING (sec) GROUP BY sec),
uni AS (SELECT sec, first_month, last_month, n_loans, wavg_fico, original_pool, exited, wavg_fico < 640 AND original_pool > 2e9 AS qualifies,
  concat_ws('; ', CASE WHEN wavg_fico >= 640 THEN 'wavg_fico=' || printf('%.0f', wavg_fico) || '>=640' END, CASE WHEN original_pool <= 2e9 THEN 'pool=$' || printf('%.0f', original_pool / 1e6) || 'M<=$2000M' END) AS reason
  FROM fm JOIN iss USING (sec) JOIN ex USING (sec)),
live AS (SELECT t.* FROM tape t JOIN uni u USING (sec) WHERE qualifies AND (exited IS NULL OR month < exited))"""
TRUST = UNI + """,
parts AS (SELECT sec, month, sum(beg) AS pool_beg_balance, sum(endb) AS pool_end_balance, coalesce(sum(CASE WHEN md NOT IN (5, 6) THEN endb END), 0) AS active_balance,
  coalesce(sum(CASE WHEN md NOT IN (5, 6) AND dpd >= 30 THEN endb END), 0) AS delq30_balance, coalesce(sum(CASE WHEN md NOT IN (5, 6) AND dpd >= 60 THEN endb END), 0) AS delq60_balance,
  sum(nl) AS net_losses, sum(co) AS charge_offs, sum(rec) AS recoveries, sum(interest) AS interest_collected FROM live GROUP BY sec, month),
roll AS (SELECT a.sec, a.month, sum(a.endb) AS current_balance, sum(CASE WHEN b.dpd >= 30 THEN a.endb ELSE 0 END) AS roll_30_balance
  FROM live a JOIN live b ON a.sec = b.sec AND a.asset = b.asset AND b.month = a.month + INTERVAL 1 MONTH WHERE a.md = 0 GROUP BY a.sec, a.month),
trust AS (SELECT p.*, r.current_balance, r.roll_30_balance FROM parts p LEFT JOIN roll r USING (sec, month))"""
_RATIOS = """CAST(delq30_balance AS DOUBLE) / nullif(CAST(active_balance AS DOUBLE), 0) AS delq30plus, CAST(delq60_balance AS DOUBLE) / nullif(CAST(active_balance AS DOUBLE), 0) AS delq60plus,
  CAST(roll_30_balance AS DOUBLE) / nullif(CAST(current_balance AS DOUBLE), 0) AS roll_c_to_30, 12 * CAST(net_losses AS DOUBLE) / nullif(CAST(pool_beg_balance AS DOUBLE), 0) AS net_loss_annl,
  CAST(recoveries AS DOUBLE) / nullif(CAST(charge_offs AS DOUBLE), 0) AS recovery_rate"""


def pool_ctes(source: str, name: str, extra: str = "") -> str:
    sums = ", ".join(f"sum({c}) AS {c}" for c in metrics.PARTS)
    return f""",
{name}_s AS (SELECT month, {sums}, count(*) AS n_trusts FROM {source} {extra} GROUP BY month),
{name} AS (SELECT *, {_RATIOS}, 12 * CAST(interest_collected AS DOUBLE) / nullif((CAST(pool_beg_balance AS DOUBLE) + CAST(pool_end_balance AS DOUBLE)) / 2, 0) AS gross_yield_annl,
  12 * (CAST(interest_collected AS DOUBLE) - CAST(net_losses AS DOUBLE)) / nullif((CAST(pool_beg_balance AS DOUBLE) + CAST(pool_end_balance AS DOUBLE)) / 2, 0) AS net_yield_annl FROM {name}_s)"""


def stress_ctes(source: str, name: str) -> str:
    w = "OVER (ORDER BY month ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"
    z = ", ".join(f"{s} * greatest(least(CASE WHEN count({c}) {w} >= 12 THEN ({c} - avg({c}) {w}) / nullif(stddev_samp({c}) {w}, 0) END, 3.0), -3.0) AS z_{c}" for c, s in stress.SIGNS.items())
    # least and greatest pass over nulls, so a missing score is put back
    fix = ", ".join(f"CASE WHEN ok_{c} THEN z_{c} END AS z_{c}" for c in stress.SIGNS)
    ok = ", ".join(f"count({c}) {w} >= 12 AND {c} IS NOT NULL AND stddev_samp({c}) {w} > 0 AS ok_{c}" for c in stress.SIGNS)
    weights = ", ".join(f"coalesce(1 / nullif(stddev_samp(z_{c}), 0), 0) AS w_{c}" for c in stress.SIGNS)
    total = " + ".join(f"w_{c}" for c in stress.SIGNS)
    mean = " + ".join(f"coalesce(z_{c}, 0) * w_{c}" for c in stress.SIGNS)
    some = ", ".join(f"z_{c}" for c in stress.SIGNS)
    return f""",
{name}_z0 AS (SELECT *, {z}, {ok} FROM {source}),
{name}_z AS (SELECT * EXCLUDE ({some}), {fix} FROM {name}_z0),
{name}_w AS (SELECT {weights} FROM {name}_z),
{name} AS (SELECT z.*, CASE WHEN coalesce({some}) IS NOT NULL THEN ({mean}) / nullif({total}, 0) END AS stress_index_zavg FROM {name}_z z, {name}_w w)"""


POOL = TRUST + pool_ctes("trust", "pool")
INDEX = POOL + stress_ctes("pool", "marks")
_R = ["delq30plus", "delq60plus", "roll_c_to_30", "net_loss_annl", "recovery_rate"]
_Z = [f"z_{c}" for c in stress.SIGNS]
_AGED = """,
aged AS (SELECT t.*, (year(month) * 12 + month(month)) - (year(first_month) * 12 + month(first_month)) AS age FROM trust t JOIN fm USING (sec)),
ages AS (SELECT month, CAST(sum(age * CAST(pool_end_balance AS DOUBLE)) AS DOUBLE) / nullif(sum(CAST(pool_end_balance AS DOUBLE)), 0) AS pool_age, count(*) AS n FROM aged GROUP BY month)"""


def _uni(spark, d):
    return universe.build_universe(loans(spark, d), min_pool_size=floor_cents(d))


def _live(spark, d):
    rows = loans(spark, d)
    return universe.apply_universe(rows, universe.build_universe(rows, min_pool_size=floor_cents(d)))


def _trust(spark, d):
    return metrics.universe_metrics(loans(spark, d), min_pool_size=floor_cents(d)).drop("first_month")


def _index(spark, d, **how):
    return stress.build_stress_index(metrics.pool_metrics(_trust(spark, d)), **how)


def rounded(names, places):
    return ", ".join(f"round({c}, {places}) AS {c}" for c in names)


def whole(names):
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in names)


query("u1_month_start", TAPE + " SELECT date_trunc('month', month + INTERVAL 9 DAY)::DATE AS month, count(*) AS n FROM tape GROUP BY 1")(
    lambda s, d: universe.monthly(loans(s, d).withColumn("reportingPeriodBeginningDate", F.date_add("reportingPeriodBeginningDate", 9))).groupBy("month").agg(F.count(F.lit(1)).alias("n")))
query("u2_issuance_snapshot", UNI + " SELECT sec AS securitizationKey, count(*) AS n, CAST(sum(orig) AS BIGINT) AS orig FROM snap GROUP BY sec")(
    lambda s, d: universe.issuance_snapshot(loans(s, d)).groupBy("securitizationKey").agg(F.count(F.lit(1)).alias("n"), F.sum("originalLoanAmount").alias("orig")))
query("u3_u4_issuance_fico_and_pool", UNI + " SELECT sec AS securitizationKey, round(wavg_fico, 6) AS wavg_fico, round(original_pool, 2) AS original_pool FROM iss")(
    lambda s, d: universe.issuance(loans(s, d)).select("securitizationKey", r8("wavg_fico", 6).alias("wavg_fico"), r8("original_pool", 2).alias("original_pool")))
query("u5_exit_month", UNI + " SELECT sec AS securitizationKey, exited FROM ex")(
    lambda s, d: universe.exit_months(loans(s, d), universe.issuance(loans(s, d))))
query("u6_universe", UNI + " SELECT sec AS securitizationKey, left(sec, 8) AS shelf, round(wavg_fico, 6) AS wavg_fico, original_pool, first_month, last_month, exited, n_loans, qualifies, reason FROM uni")(
    lambda s, d: _uni(s, d).withColumn("wavg_fico", r8("wavg_fico", 6)))
query("u7_apply_universe", UNI + " SELECT sec AS securitizationKey, month, count(*) AS n, CAST(sum(endb) AS BIGINT) AS e FROM live GROUP BY 1, 2")(
    lambda s, d: _live(s, d).groupBy("securitizationKey", F.col("reportingPeriodBeginningDate").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.sum("reportingPeriodActualEndBalanceAmount").alias("e")))
query("m1_active_flags", TAPE + " SELECT md, md IN (5, 6) AS resolved, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN md IN (5, 6) THEN 0 ELSE least(md, 4) * 30 END) AS DOUBLE) AS dpd FROM tape GROUP BY 1, 2")(
    lambda s, d: metrics.with_days(loans(s, d).drop("currentDelinquencyStatus")).groupBy(F.col("monthsDelinquent").alias("md"), F.col("_resolved").alias("resolved")).agg(F.count(F.lit(1)).alias("n"), F.sum("_dpd").alias("dpd")))
query("m2_trust_month_sums", TRUST + f" SELECT sec AS securitizationKey, month, {whole([c for c in metrics.PARTS if c not in ('current_balance', 'roll_30_balance')])} FROM parts")(
    lambda s, d: named(metrics.trust_month_parts(_live(s, d)), ["securitizationKey", "month"], [c for c in metrics.PARTS if c not in ("current_balance", "roll_30_balance")]))
query("m3_roll_current_to_30", TRUST + f" SELECT sec AS securitizationKey, month, {whole(['current_balance', 'roll_30_balance'])} FROM roll")(
    lambda s, d: named(metrics.current_to_30(_live(s, d)), ["securitizationKey", "month"], ["current_balance", "roll_30_balance"]))
query("m4_trust_ratios", TRUST + f" SELECT securitizationKey, month, {rounded(_R, 8)} FROM (SELECT sec AS securitizationKey, month, {_RATIOS} FROM trust)")(
    lambda s, d: named(_trust(s, d), ["securitizationKey", "month"], [], _R))
query("p1_pooled_metrics", POOL + f" SELECT month, {whole([*metrics.PARTS, 'n_trusts'])}, {rounded(_R, 8)} FROM pool")(
    lambda s, d: named(metrics.pool_metrics(_trust(s, d)), ["month"], [*metrics.PARTS, "n_trusts"], _R))
query("p2_yields", POOL + f" SELECT month, {rounded(['gross_yield_annl', 'net_yield_annl'], 8)} FROM pool")(
    lambda s, d: named(metrics.pool_metrics(_trust(s, d)), ["month"], [], ["gross_yield_annl", "net_yield_annl"]))
query("z1_z2_rolling_scores", INDEX + f" SELECT month, {rounded(_Z, 6)} FROM marks")(
    lambda s, d: named(_index(s, d), ["month"], [], _Z, 6))
query("z3_inverse_volatility", INDEX + " SELECT month, round(stress_index_zavg, 6) AS stress_index_zavg FROM marks")(
    lambda s, d: named(_index(s, d), ["month"], [], ["stress_index_zavg"], 6))
_MEAN = " + ".join(f"coalesce({z}, 0)" for z in _Z)
_COUNT = " + ".join(f"CAST({z} IS NOT NULL AS INT)" for z in _Z)
query("z4_equal_weight", INDEX + f" SELECT month, round(({_MEAN}) / nullif(CAST({_COUNT} AS DOUBLE), 0), 6) AS stress_index_zavg FROM marks")(
    lambda s, d: named(_index(s, d, inverse_vol_weight=False), ["month"], [], ["stress_index_zavg"], 6))
query("z5_principal_component")(lambda s, d: stress.principal_component(_index(s, d).withColumn("series_key", F.lit("national")), _Z, ["series_key"]).select("series_key", F.transform("loadings", lambda x: F.round(x, 6)).alias("loadings"), r8("explained", 6).alias("explained")))
# the first component by power iteration, 500 steps
_M = {(i, j): f"c{min(i, j)}{max(i, j)}" for i in range(5) for j in range(5)}
_COVARIANCES = ", ".join(f"covar_samp({_Z[i]}, {_Z[j]}) AS c{i}{j}" for i in range(5) for j in range(i, 5))
_NEXT = ", ".join("(" + " + ".join(f"{_M[i, j]} * v{j}" for j in range(5)) + f") AS u{i}" for i in range(5))
_NORM = "sqrt(" + " + ".join(f"u{i} * u{i}" for i in range(5)) + ")"
PCA = INDEX.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
full_ AS (SELECT * FROM marks WHERE {" AND ".join(f"{z} IS NOT NULL" for z in _Z)}),
cov_ AS MATERIALIZED (SELECT {_COVARIANCES}, {", ".join(f"avg({z}) AS m{i}" for i, z in enumerate(_Z))} FROM full_),
it_ AS (SELECT 0 AS step, {", ".join(f"1.0::DOUBLE AS v{i}" for i in range(5))}
  UNION ALL SELECT step + 1, {", ".join(f"u{i} / {_NORM}" for i in range(5))} FROM (SELECT step, {_NEXT} FROM it_, cov_ WHERE step < 500)),
load_ AS (SELECT v0, v1, v2, v3, v4, {", ".join(f"m{i}" for i in range(5))}, ({" + ".join(f"v{i} * {_M[i, j]} * v{j}" for i in range(5) for j in range(5))}) / ({" + ".join(f"c{i}{i}" for i in range(5))}) AS explained FROM it_, cov_ WHERE step = 500),
pc_ AS (SELECT marks.*, {" + ".join(f"({z} - m{i}) * v{i}" for i, z in enumerate(_Z))} AS pc FROM marks, load_),
sp_ AS (SELECT coalesce(stddev_samp(CASE WHEN pc IS NOT NULL THEN stress_index_zavg END) / nullif(stddev_samp(CASE WHEN stress_index_zavg IS NOT NULL THEN pc END), 0), 1) AS scale FROM pc_),
both_ AS (SELECT *, pc * scale AS stress_index_pca FROM pc_, sp_)"""
query("z5_loadings", PCA + " SELECT field, round(loading, 6) AS loading, round(explained, 6) AS explained FROM (" + " UNION ALL ".join(f"SELECT '{z}' AS field, v{i} AS loading, explained FROM load_" for i, z in enumerate(_Z)) + ")")(
    lambda s, d: stress.principal_component(_index(s, d).withColumn("series_key", F.lit("national")), _Z, ["series_key"]).select(F.explode(F.arrays_zip(F.array(*map(F.lit, _Z)).alias("field"), "loadings")).alias("x"), "explained").select(F.col("x.field").alias("field"), r8("x.loadings", 6).alias("loading"), r8("explained", 6).alias("explained")))
query("z6_component_index", PCA + " SELECT month, round(stress_index_pca, 6) AS stress_index, round(stress_index_pca, 6) AS stress_index_pca, round(stress_index_zavg, 6) AS stress_index_zavg FROM both_")(lambda s, d: named(_index(s, d, method="pca"), ["month"], [], ["stress_index", "stress_index_pca", "stress_index_zavg"], 6))
query("z7_covid_flag", INDEX + " SELECT month, month BETWEEN DATE '2020-04-01' AND DATE '2020-12-01' AS covid_flag FROM marks")(lambda s, d: _index(s, d).select("month", "covid_flag"))
_FLAG = "month BETWEEN DATE '2020-04-01' AND DATE '2020-12-01' AS covid_flag"


@query("z8_build_index", INDEX + f" SELECT month, {whole(['n_trusts', 'pool_balance'])}, {rounded([*_R, 'gross_yield_annl', 'net_yield_annl'], 8)}, {rounded([*_Z, 'stress_index_zavg'], 6)}, {_FLAG} FROM (SELECT *, pool_end_balance AS pool_balance FROM marks)")
def z8(spark, d):
    out = stress.build_index(loans(spark, d), min_pool_size=floor_cents(d))
    longs, ratios = ["n_trusts", "pool_balance"], [*_R, "gross_yield_annl", "net_yield_annl"]
    return out.select("month", "covid_flag", *(F.col(c).cast("bigint").alias(c) for c in longs), *(r8(c).alias(c) for c in ratios), *(r8(c, 6).alias(c) for c in [*_Z, "stress_index_zavg"]))


@query("z9_incremental_union", POOL + f" SELECT month, {whole(['n_trusts', 'pool_end_balance'])}, {rounded(_R, 8)} FROM pool")
def z9(spark, d):
    """Trust metrics of two disjoint sets of deals, made apart and pooled."""
    live = _live(spark, d)
    half = F.pmod(F.xxhash64("securitizationKey"), F.lit(2)) == 0
    both = metrics.trust_month_metrics(live.filter(half)).unionByName(metrics.trust_month_metrics(live.filter(~half)))
    return named(metrics.pool_metrics(both), ["month"], ["n_trusts", "pool_end_balance"], _R)


@query("z10_longest_build", TRUST + " SELECT securitizationKey, build, count(*) AS months FROM (SELECT sec AS securitizationKey, 'full' AS build FROM parts) GROUP BY 1, 2")
def z10(spark, d):
    """Of a full and a shortened build of each deal, the longer one."""
    full = metrics.trust_month_parts(_live(spark, d))
    late = full.join(full.groupBy("securitizationKey").agg(F.min("month").alias("_m")), "securitizationKey").filter("month > _m").drop("_m")
    builds = full.withColumn("build", F.lit("full")).unionByName(late.withColumn("build", F.lit("late")))
    return stress.longest_build(builds).groupBy("securitizationKey", "build").agg(F.count(F.lit(1)).alias("months"))


def _aged(spark, d):
    rows = metrics.universe_metrics(loans(spark, d), min_pool_size=floor_cents(d))
    return stress.pool_age(rows.drop("first_month"), rows.select("securitizationKey", "first_month").distinct())


query("k1_trust_age", TRUST + _AGED + " SELECT sec AS securitizationKey, month, CAST(age AS BIGINT) AS age FROM aged")(lambda s, d: named(_aged(s, d), ["securitizationKey", "month"], ["age"]))
query("k2_pool_age", TRUST + _AGED + " SELECT month, round(pool_age, 6) AS pool_age, n AS n_trusts FROM ages")(lambda s, d: named(stress.mean_pool_age(_aged(s, d)), ["month"], ["n_trusts"], ["pool_age"], 6))
COHORT = TRUST + _AGED + pool_ctes("aged", "cpool", "WHERE age BETWEEN 6 AND 30") + stress_ctes("cpool", "cmarks")
query("k3_cohort_index", COHORT + f" SELECT month, CAST(n_trusts AS BIGINT) AS n_trusts, {rounded(_R, 8)}, {rounded(['stress_index_zavg'], 6)} FROM cmarks")(
    lambda s, d: stress.cohort_index(_aged(s, d)).select("month", F.col("n_trusts").cast("bigint").alias("n_trusts"), *(r8(c).alias(c) for c in _R), r8("stress_index_zavg", 6).alias("stress_index_zavg")))
query("k4_cohort_diagnostics", COHORT + ", diag AS (SELECT c.*, a.pool_age FROM cmarks c LEFT JOIN ages a USING (month)) SELECT count(*) AS months, count_if(n_trusts >= 3)::BIGINT AS months_enough, round(stddev_samp(pool_age), 6) AS pool_age_std, round(avg(CASE WHEN month >= DATE '2021-01-01' THEN net_loss_annl END), 8) AS net_loss_since FROM diag")(
    lambda s, d: (lambda aged: named(stress.cohort_diagnostics(stress.cohort_index(aged), stress.mean_pool_age(aged), "2021-01-01"), ["months", "months_enough"], [], ["pool_age_std", "net_loss_since"]).withColumn("pool_age_std", F.round("pool_age_std", 6)))(settled(_aged(s, d))))

"""Vetting and report queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrich, report, vetting
from .registry import ORACLES, TAPE, query, r8
from .tape import LOAN, loans, tape

KEY, BEG = "securitizationKey", "reportingPeriodBeginningDate"
# a tape with a month missing in some trusts, missing and doubled loan months, and negative charge-offs
_VT = "SELECT * REPLACE (CASE WHEN k % 211 = 0 AND i = 2 THEN -100 WHEN k % 101 = 0 AND i = 4 THEN 50 ELSE co END AS co) FROM tape WHERE NOT (k % 19 = 0 AND i = 5) AND NOT (nk = 3 AND i = 7)"
VT = TAPE + f", vt AS ({_VT} UNION ALL SELECT * FROM tape WHERE k % 17 = 0 AND i = 3)"
S = ' SELECT sec AS "securitizationKey", '


def _vt(s, d):
    t = tape(s, d)
    # a row's own charge-off, and that of its copy
    kept = "CASE WHEN NOT (k % 19 = 0 AND i = 5) AND NOT (nk = 3 AND i = 7) THEN CASE WHEN k % 211 = 0 AND i = 2 THEN -100 WHEN k % 101 = 0 AND i = 4 THEN 50 ELSE co END END"
    rows = t.withColumn("co", F.explode(F.array_compact(F.array(F.expr(kept), F.expr("CASE WHEN k % 17 = 0 AND i = 3 THEN co END")))))
    return rows.select(*(F.expr(e).alias(n) for n, e in LOAN.items())).withColumns({"repossessedProceedsAmount": F.lit(0), "otherPrincipalAdjustmentAmount": F.lit(0)})


def _vet(f, *cols):
    return lambda s, d: f(_vt(s, d)).select(KEY, *cols)


query("v1_count", VT + S + "count(DISTINCT asset) AS \"Count\" FROM vt GROUP BY 1")(_vet(vetting.row_counters, "Count"))
query("v2_opening", VT + ", f AS (SELECT sec, min(month) AS a, max(month) AS z FROM vt GROUP BY 1)" + S + 'a AS "StartMonth", z AS "EndMonth", CAST(sum(beg) AS BIGINT) AS "OpenBal" FROM vt JOIN f USING (sec) WHERE month = a GROUP BY 1, 2, 3')(
    lambda s, d: vetting.row_counters(_vt(s, d)).join(vetting.opening_balance(_vt(s, d)), KEY).select(KEY, "StartMonth", "EndMonth", "OpenBal"))
query("v3_missing_months", VT + S + '(max(mi) - min(mi) + 1 - count(DISTINCT mi))::BIGINT AS "MissingMonths" FROM vt GROUP BY 1 HAVING max(mi) - min(mi) + 1 > count(DISTINCT mi)')(lambda s, d: vetting.missing_months(_vt(s, d)))
query("v4_v5_walk", VT + ", w AS (SELECT sec, beg, row_number() OVER o AS n, lag(endb) OVER o AS e0, lag(beg) OVER o AS b0 FROM vt WINDOW o AS (PARTITION BY sec, asset ORDER BY mi))" + S + 'count_if(n > 1 AND NOT coalesce(beg = e0, false))::BIGINT AS "Walk", count_if(b0 < beg)::BIGINT AS "IncrBal" FROM w GROUP BY 1')(lambda s, d: vetting.walks(_vt(s, d)))
query("v6_payments", VT + S + 'count_if(beg - endb <> prin + co)::BIGINT AS "Pmts" FROM vt GROUP BY 1')(_vet(vetting.row_counters, "Pmts"))
query("v7_v8_missing_and_extra", VT + """, ms AS (SELECT sec, month, lead(month) OVER (PARTITION BY sec ORDER BY month) AS nxt FROM (SELECT DISTINCT sec, month FROM vt)),
due AS (SELECT DISTINCT v.sec, asset, nxt AS month FROM vt v JOIN ms USING (sec, month) WHERE nxt IS NOT NULL AND endb <> 0), here AS (SELECT DISTINCT sec, asset, month FROM vt),
miss AS (SELECT sec, count(*) AS m FROM due WHERE NOT EXISTS (SELECT 1 FROM here h WHERE h.sec = due.sec AND h.asset = due.asset AND h.month = due.month) GROUP BY 1),
extra AS (SELECT h.sec, count(*) AS x FROM here h JOIN (SELECT sec, nxt AS month FROM ms WHERE nxt IS NOT NULL) USING (sec, month) WHERE NOT EXISTS (SELECT 1 FROM due d WHERE h.sec = d.sec AND h.asset = d.asset AND h.month = d.month) GROUP BY 1)""" + S + 'm AS "Missing", x AS "Extra" FROM miss FULL JOIN extra USING (sec)')(
    lambda s, d: vetting.appearances(_vt(s, d)))
query("v9_after_charge_off", VT + ", f AS (SELECT sec, asset, min(mi) AS m FROM vt WHERE co > 0 GROUP BY 1, 2)" + S + 'count(*) AS "COExtra" FROM vt JOIN f USING (sec, asset) WHERE mi > m GROUP BY 1')(lambda s, d: vetting.after_charge_off(_vt(s, d)))
query("v10_duplicates", VT + S + 'CAST(sum(n) AS BIGINT) AS "Dupes" FROM (SELECT sec, asset, month, count(*) AS n FROM vt GROUP BY 1, 2, 3 HAVING count(*) > 1) GROUP BY 1')(lambda s, d: vetting.duplicates(_vt(s, d)))
query("v11_v19_row_counters", VT + S + 'count_if(beg < 0)::BIGINT AS "NegOpenBal", count_if(endb < 0)::BIGINT AS "NegCloseBal", 0::BIGINT AS "RateNeg", count_if(pti_bps > 10000)::BIGINT AS "RatePos", 0::BIGINT AS "Integer", count_if(co < 0)::BIGINT AS "NegCO", count_if(co < beg AND co <> 0)::BIGINT AS "PartialCO", count_if(co > beg AND co <> 0)::BIGINT AS "GreaterCO", 0::BIGINT AS "NegRepo", count_if(rec < 0)::BIGINT AS "NegRecov" FROM vt GROUP BY 1')(
    _vet(vetting.row_counters, "NegOpenBal", "NegCloseBal", "RateNeg", "RatePos", "Integer", "NegCO", "PartialCO", "GreaterCO", "NegRepo", "NegRecov"))
query("v20_cash_flow", VT + S + 'month AS "reportingPeriodBeginningDate", CAST(sum(beg) AS BIGINT) AS beg, CAST(sum(prin) AS BIGINT) AS prin, CAST(sum(co) AS BIGINT) AS co, CAST(sum(rec) AS BIGINT) AS rec FROM vt GROUP BY GROUPING SETS ((sec, month), (sec))')(
    lambda s, d: vetting.cashflow(_vt(s, d)).select(KEY, BEG, F.col(vetting.B).alias("beg"), F.col(vetting.PRIN).alias("prin"), F.col(vetting.CO).alias("co"), F.col(vetting.REC).alias("rec")))
# every counter of the queries above, by trust
_COUNTERS = {"v1_count": ["Count"], "v2_opening": ["OpenBal"], "v3_missing_months": ["MissingMonths"], "v4_v5_walk": ["Walk", "IncrBal"], "v6_payments": ["Pmts"], "v7_v8_missing_and_extra": ["Missing", "Extra"], "v9_after_charge_off": ["COExtra"], "v10_duplicates": ["Dupes"]}
_COUNTERS["v11_v19_row_counters"] = ["NegOpenBal", "NegCloseBal", "RateNeg", "RatePos", "Integer", "NegCO", "PartialCO", "GreaterCO", "NegRepo", "NegRecov"]
_ALL = [c for names in _COUNTERS.values() for c in names]
_FROM = "".join(f' LEFT JOIN ({ORACLES[q]}) q{k} USING ("securitizationKey")' if k else f'({ORACLES[q]}) q0' for k, q in enumerate(_COUNTERS))
query("v21_error_report", 'SELECT "securitizationKey", counter, value FROM (SELECT "securitizationKey", ' + ", ".join(f'CAST(coalesce("{c}", 0) AS DOUBLE) AS "{c}"' for c in _ALL) + f" FROM {_FROM}) UNPIVOT (value FOR counter IN (" + ", ".join(f'"{c}"' for c in _ALL) + "))")(
    lambda s, d: vetting.long_report(vetting.vet(_vt(s, d))))
_NUMBERS = {"originalLoanTerm": "term", "originalLoanAmount": "orig", "consumerCreditScore": "fico", "reportingPeriodActualEndBalanceAmount": "endb", "chargedoffPrincipalAmount": "co", "age": "age"}
_QUARTILES = ", ".join(f"round(quantile_cont(x, {p}), 6) AS {n}" for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
query("v22_numeric_profile", VT + ", n AS (" + " UNION ALL ".join(f"SELECT sec, '{c}' AS field, CAST({e} AS DOUBLE) AS x FROM vt" for c, e in _NUMBERS.items()) + ")" + S + f"field, count(x) AS \"count\", round(avg(x), 6) AS mean, round(stddev_samp(x), 4) AS std, min(x) AS lo, {_QUARTILES}, max(x) AS hi, count_if(x IS NULL)::BIGINT AS nans, count_if(x = 0)::BIGINT AS zeros, count_if(x > 1)::BIGINT AS above_one, count_if(x < 0)::BIGINT AS negative, count_if(x % 1 <> 0)::BIGINT AS non_int FROM n GROUP BY 1, 2")(
    lambda s, d: vetting.numeric_profile(_vt(s, d), list(_NUMBERS)).select(KEY, "field", "count", r8("mean", 6).alias("mean"), r8("std", 4).alias("std"), F.col("min").alias("lo"), *(r8(F.col("quartiles")[k], 6).alias(n) for k, n in enumerate(("q25", "q50", "q75"))), F.col("max").alias("hi"), "nans", "zeros", "above_one", "negative", "non_int"))
_TOP = VT + ", c AS (SELECT sec, score_type AS v, count(*) AS n FROM vt GROUP BY 1, 2)" + S + "'obligorCreditScoreType' AS field, CAST(sum(CASE WHEN v IS NOT NULL THEN n ELSE 0 END) AS BIGINT) AS \"count\", count(v) AS \"unique\", arg_max(v, CASE WHEN v IS NOT NULL THEN n END) AS top, max(CASE WHEN v IS NOT NULL THEN n END) AS freq, CAST(sum(CASE WHEN v IS NULL THEN n ELSE 0 END) AS BIGINT) AS nans FROM c GROUP BY 1"
query("v23_text_profile", _TOP)(lambda s, d: vetting.text_profile(_vt(s, d), ["obligorCreditScoreType"]))
query("v25_describe", _TOP)(lambda s, d: report.describe(_vt(s, d), ["obligorCreditScoreType"]))
query("v24_distinct_values", VT + S + "'obligorGeographicLocation' AS field, string_agg(DISTINCT state, ',' ORDER BY state) AS \"values\", 0::BIGINT AS nans FROM vt GROUP BY 1")(
    lambda s, d: vetting.distinct_values(_vt(s, d), ["obligorGeographicLocation"]).withColumn("values", F.concat_ws(",", "values")))
query("v26_parity", TAPE + " SELECT 'endb' AS \"column\", CAST(count_if(k % 17 = 0) AS BIGINT) AS different, 1.0::DOUBLE AS max_abs FROM tape UNION ALL SELECT 'beg', 0::BIGINT, 0.0::DOUBLE FROM (SELECT 1)")(
    lambda s, d: vetting.parity(tape(s, d).select("k", "mi", "endb", "beg"), tape(s, d).select("k", "mi", F.expr("endb + CAST(k % 17 = 0 AS INT)").alias("endb"), "beg"), ["k", "mi"]))

LAST = TAPE + ", sp AS (SELECT sec, max(mi) AS last_mi, min(mi) AS first_mi FROM tape GROUP BY sec), t AS (SELECT tape.*, mi = last_mi AS fin, mi - first_mi AS mfc FROM tape JOIN sp USING (sec))"
_E = "nullif(sum(CASE WHEN fin THEN CAST(endb AS DOUBLE) END), 0)"
_N = "nullif(CAST(count_if(fin) AS DOUBLE), 0)"
_O = "nullif(sum(CASE WHEN fin THEN CAST(orig AS DOUBLE) END), 0)"
MEASURES = {
    "total_def": "sum(co)::DOUBLE / nullif(sum(CASE WHEN mfc = 0 THEN CAST(beg AS DOUBLE) END), 0)", "avg_balance": "avg(CASE WHEN fin THEN CAST(endb AS DOUBLE) END)", "avg_size": "avg(CASE WHEN fin THEN CAST(orig AS DOUBLE) END)",
    "delq": f"sum(CASE WHEN fin THEN CASE WHEN dpd > 0 THEN CAST(endb AS DOUBLE) ELSE 0 END END) / {_E}", "delq_1m": f"sum(CASE WHEN fin THEN CASE WHEN md = 1 THEN CAST(endb AS DOUBLE) ELSE 0 END END) / {_E}",
    "delq_3m_plus": f"sum(CASE WHEN fin THEN CASE WHEN md = 4 THEN CAST(endb AS DOUBLE) ELSE 0 END END) / {_E}", "def": f"sum(CASE WHEN fin THEN CAST(co AS DOUBLE) END) / {_E}",
    "wavg_term": f"sum(CASE WHEN fin THEN CAST(term AS DOUBLE) * orig END) / {_O}", "wavg_age": f"sum(CASE WHEN fin THEN CAST(age AS DOUBLE) * orig END) / {_O}", "wavg_mfc": f"sum(CASE WHEN fin THEN CAST(mfc AS DOUBLE) * orig END) / {_O} + 1",
    "wavg_cons_score": f"sum(CASE WHEN fin THEN CAST(fico AS DOUBLE) * orig END) / {_O}", "car": f"count_if(fin AND veh_type = 1) / {_N}", "used": f"count_if(fin AND new_used = 2) / {_N}", "y2017": f"count_if(fin AND model_year = 2017) / {_N}",
    "before_2015": f"count_if(fin AND model_year < 2015) / {_N}", "tx": f"count_if(fin AND state = 'TX') / {_N}", "inc_ver": f"count_if(fin AND inc_ver >= 3) / {_N}", "wavg_apr": f"sum(CASE WHEN fin THEN apr_bps / 10000.0::DOUBLE * orig END) / {_O}",
}
_SQL = "count_if(fin)::BIGINT AS n_loans, " + ", ".join(f'round({e}, 6) AS "{k}"' for k, e in MEASURES.items())


def _rows(s, d):
    return enrich.trust_dates(loans(s, d).withColumn("age", F.col("age").cast("bigint")))


def _seasoned(s, d):
    """With ages and balances at the cutoff, and prepaid principal."""
    rows = enrich.cutoff_balance(_rows(s, d).withColumn("ageFromCutoff", F.col("age") - F.col("monthsFromCutoffDate")))
    return rows.withColumn("principalPrepaid", F.expr("CASE WHEN monthsDelinquent = 6 THEN greatest(actualPrincipalCollectedAmount - scheduledPrincipalAmount, 0) ELSE 0 END"))


def _shown(df, *keys):
    return df.select(*keys, "n_loans", *(r8(k, 6).alias(k) for k in MEASURES))


query("r1_r2_summary_row", LAST + f" SELECT {_SQL} FROM t")(lambda s, d: _shown(report.summary_row(_rows(s, d))))
query("r6_comparison", LAST + f' SELECT sec AS "securitizationKey", {_SQL} FROM t GROUP BY GROUPING SETS ((sec), ())')(lambda s, d: _shown(report.comparison(_rows(s, d)), KEY))
_BIN = ", b AS (SELECT t.*, CASE WHEN orig < hi THEN least(floor((orig - lo) / ((hi - lo) / 7.0)), 6) END AS bin FROM t, (SELECT CAST(min(orig) AS DOUBLE) AS lo, CAST(max(orig) AS DOUBLE) AS hi FROM t))"
query("r3_equal_bins", LAST + _BIN + f" SELECT CAST(bin AS INT) AS bin, {_SQL} FROM b WHERE bin IS NOT NULL GROUP BY 1")(
    lambda s, d: (lambda b: _shown(b.filter("bin is not null").groupBy("bin").agg(*report.measures(b)), "bin"))(report.bins(_rows(s, d), "originalLoanAmount")))
query("r4_r5_summary", LAST + _BIN + f""", s AS (SELECT 'Size' AS dimension, 'bin ' || CAST(CAST(bin AS INT) AS VARCHAR) AS stratum, * FROM b WHERE bin IS NOT NULL UNION ALL SELECT 'Size', 'Overall', * FROM b
  UNION ALL SELECT 'VehType', CASE veh_type WHEN 1 THEN 'Car' WHEN 2 THEN 'Truck' ELSE 'SUV' END, * FROM b UNION ALL SELECT 'EmpVer', CAST(emp_ver AS VARCHAR), * FROM b) SELECT dimension, stratum, {_SQL} FROM s GROUP BY 1, 2""")(
    lambda s, d: _shown(report.summary(_rows(s, d)), "dimension", "stratum").filter("dimension = 'Size' or dimension in ('VehType', 'EmpVer') and stratum <> 'Overall'"))
# every measure over every dimension
_W = lambda x, test="fin": f"sum(CASE WHEN {test} THEN {x} * orig END) / nullif(sum(CASE WHEN {test} THEN CAST(orig AS DOUBLE) END), 0)"
_LATE_ = lambda test: f"sum(CASE WHEN fin THEN CASE WHEN {test} THEN CAST(endb AS DOUBLE) ELSE 0 END END) / {_E}"
_HELD = lambda test: f"count_if(fin AND {test}) / {_N}"
_FIRST = "nullif(sum(CASE WHEN mfc = 0 THEN CAST(beg AS DOUBLE) END), 0)"
ALL_MEASURES = MEASURES | {
    "avg_balance_share": "avg(CASE WHEN fin THEN CAST(endb AS DOUBLE) END) / nullif(avg(CASE WHEN fin THEN CAST(orig AS DOUBLE) END), 0)",
    "delq_2m": _LATE_("md = 2"), "delq_3m": _LATE_("md = 3"), "total_pp": f"sum(pp)::DOUBLE / {_FIRST}", "pp": "sum(CASE WHEN fin THEN CAST(pp AS DOUBLE) END) / nullif(sum(CASE WHEN fin THEN CAST(beg AS DOUBLE) END), 0)",
    "wavg_ltv": _W("ltv"), "wavg_pti": _W("pti_bps / 10000.0::DOUBLE"), "wavg_comm_score": _W("CAST(cscore AS DOUBLE)", "fin AND cscore > 0"), "cons": _HELD("fico > 0"), "comm": _HELD("cscore > 0"),
    "new": _HELD("new_used = 1"), "truck": _HELD("veh_type = 2"), "suv": _HELD("veh_type = 3"), "y2015": _HELD("model_year = 2015"), "y2016": _HELD("model_year = 2016"), "before_2010": _HELD("model_year < 2010"),
    "ca": _HELD("state = 'CA'"), "fl": _HELD("state = 'FL'"), "oh": _HELD("state = 'OH'"), "nj": _HELD("state = 'NJ'"), "emp_ver": _HELD("emp_ver >= 3"),
}
_MORE = {"Term": "CAST(term AS DOUBLE)", "Size": "CAST(orig AS DOUBLE)", "APR": "apr_bps / 10000.0::DOUBLE", "Age": "CAST(age AS DOUBLE)", "FICO": "CAST(fico AS DOUBLE)", "CommScore": "CAST(cscore AS DOUBLE)", "LTV": "ltv", "PTI": "pti_bps / 10000.0::DOUBLE"}
_LABELS = {"VehType": "CASE veh_type WHEN 1 THEN 'Car' WHEN 2 THEN 'Truck' WHEN 3 THEN 'SUV' END", "VehCond": "CASE new_used WHEN 1 THEN 'New' WHEN 2 THEN 'Used' END", "VehYear": "CASE WHEN model_year BETWEEN 2012 AND 2017 THEN CAST(model_year AS VARCHAR) END", "EmpVer": "CAST(emp_ver AS VARCHAR)", "IncVer": "CAST(inc_ver AS VARCHAR)", "VehManu": "'Brand#' || CAST(k % 10 AS VARCHAR)"}
_WIDE = LAST + """, w AS (SELECT *, CAST(orig AS DOUBLE) / veh_value AS ltv, CASE WHEN k % 97 = 0 THEN fico - 100 END AS cscore, CASE WHEN md = 6 THEN greatest(prin - sched_prin, 0) ELSE 0 END AS pp FROM t),
""" + "r AS (SELECT " + ", ".join(f"min({x}) AS lo{k}, max({x}) AS hi{k}" for k, x in enumerate(_MORE.values())) + " FROM w), s AS (" + " UNION ALL ".join(
    [f"SELECT '{d}' AS dimension, CASE WHEN {x} < hi{k} THEN 'bin ' || CAST(CAST(least(floor(({x} - lo{k}) / ((hi{k} - lo{k}) / 7.0)), 6) AS INT) AS VARCHAR) END AS stratum, w.* FROM w, r" for k, (d, x) in enumerate(_MORE.items())]
    + [f"SELECT '{d}', {x}, w.* FROM w" for d, x in _LABELS.items()] + [f"SELECT '{d}', 'Overall', w.* FROM w" for d in (*_MORE, *_LABELS)]
) + ")"


def _wide(s, d):
    rows = _seasoned(s, d).withColumns({"loanToValueRatio": F.col("originalLoanAmount").cast("double") / F.col("vehicleValueAmount"), "_k": F.col("assetNumber").cast("bigint")})
    return rows.withColumns({"commercialCreditScore": F.expr("CASE WHEN _k % 97 = 0 THEN consumerCreditScore - 100 END"), "vehicleManufacturerName": F.expr("concat('Brand#', _k % 10)")}).drop("_k")


query("r2_r5_all_strata", _WIDE + " SELECT dimension, stratum, count_if(fin)::BIGINT AS n_loans, " + ", ".join(f'round({e}, 6) AS "{k}"' for k, e in ALL_MEASURES.items()) + " FROM s WHERE stratum IS NOT NULL GROUP BY 1, 2")(
    lambda s, d: report.summary(_wide(s, d)).select("dimension", "stratum", "n_loans", *(r8(k, 6).alias(k) for k in ALL_MEASURES)))
_D = "CAST({} AS DOUBLE)".format
_LATE = ", ".join(f"sum(CASE WHEN md = {k} THEN {_D('endb')} ELSE 0 END) / nullif(sum({_D('endb')}), 0) AS {name}" for k, name in ((1, "delq30"), (2, "delq60"), (3, "delq90"), (5, '"def"')))


def _perf(axis: str, held: str) -> str:
    return LAST + f""", c AS (SELECT *, max(CASE WHEN mfc = 0 THEN beg END) OVER (PARTITION BY sec, asset) AS cb, CASE WHEN md = 6 THEN greatest(prin - sched_prin, 0) ELSE 0 END AS pp FROM t),
both_ AS (SELECT sec AS k2, * FROM c UNION ALL SELECT NULL AS k2, * FROM c), op AS (SELECT k2, sum(CASE WHEN mfc = 0 THEN {_D(held)} END) AS o, sum({_D("age - mfc")} * cb) / nullif(sum({_D("cb")}), 0) AS wa FROM both_ GROUP BY 1),
g AS (SELECT k2, {axis} AS x, (sum(prin + co) - sum(sched_prin))::DOUBLE / nullif((sum(beg) - sum(sched_prin))::DOUBLE, 0) AS smm, {_LATE}, sum({_D("pp")}) / nullif(sum({_D("beg")}), 0) AS prepay, sum(nl) AS nl FROM both_ GROUP BY 1, 2),
perf AS (SELECT g.*, smm / nullif(1 - smm * (wa - 1), 0) AS abs_speed, CAST(sum(nl) OVER (PARTITION BY g.k2 ORDER BY x) AS DOUBLE) / nullif(o, 0) AS cnl FROM g JOIN op ON g.k2 IS NOT DISTINCT FROM op.k2)
SELECT perf.k2 AS "securitizationKey", CAST(x AS INT) AS axis, """ + ", ".join(f'round("{c}", 6) AS "{c}"' for c in PERFORMANCE) + " FROM perf"


PERFORMANCE = ("abs_speed", "prepay", "delq30", "delq60", "delq90", "def", "cnl")
for _name, _axis, _sql in (("r7_r12_performance", "monthsFromCutoffDate", _perf("mfc", "cb")), ("r11_performance_by_age", "age", _perf("age", "orig"))):
    query(_name, _sql)(lambda s, d, axis=_axis: report.performance(_seasoned(s, d), axis).select(KEY, F.col(axis).cast("int").alias("axis"), *(r8(c, 6).alias(c) for c in PERFORMANCE)))
# some loans leave long before their trust's last month
_MV = TAPE + """, tp AS (SELECT * FROM tape WHERE NOT (k % 13 = 0 AND i > 10)), sp AS (SELECT sec, max(mi) AS last_mi FROM tp GROUP BY sec), mv AS (SELECT tp.*, lead(md) OVER (PARTITION BY sec, asset ORDER BY mi) AS nx, mi = last_mi AS fin FROM tp JOIN sp USING (sec)),
st AS (SELECT f.range AS f, t.range AS t FROM range(0, 7) f, range(0, 7) t)"""


def _leavers(s, d):
    return enrich.trust_dates(tape(s, d).filter("NOT (k % 13 = 0 AND i > 10)").select(*(F.expr(e).alias(n) for n, e in LOAN.items())))


query("r14_roll_matrix", _MV + ", ms AS (SELECT md, nx, sum(CAST(endb AS DOUBLE)) AS w FROM mv WHERE NOT fin GROUP BY 1, 2), den AS (SELECT md, sum(w) AS d FROM ms GROUP BY 1) SELECT f::INT AS from_state, t::INT AS to_state, round(coalesce(w / nullif(d, 0), 0), 6) AS share FROM st LEFT JOIN ms ON md = f AND nx = t LEFT JOIN den ON den.md = f")(lambda s, d: report.roll_matrix(_leavers(s, d)).withColumn("share", r8("share", 6)))
query("r15_roll_series", _MV + ', ma AS (SELECT month, md, nx, sum(CAST(endb AS DOUBLE)) AS w FROM mv WHERE NOT fin GROUP BY 1, 2, 3), den AS (SELECT month, md, sum(w) AS d FROM ma GROUP BY 1, 2), mo AS (SELECT DISTINCT month FROM tp WHERE month < (SELECT max(month) FROM tp)) SELECT mo.month AS "reportingPeriodBeginningDate", f::INT AS from_state, t::INT AS to_state, round(coalesce(w / nullif(d, 0), 0), 6) AS share FROM mo JOIN st ON f < 5 LEFT JOIN ma ON ma.month = mo.month AND ma.md = f AND nx = t LEFT JOIN den ON den.month = mo.month AND den.md = f')(
    lambda s, d: report.roll_series(_leavers(s, d)).withColumn("share", r8("share", 6)))
_CV = TAPE + """, c AS (SELECT CASE WHEN fico <= 640 THEN 1 WHEN fico <= 680 THEN 2 WHEN fico <= 740 THEN 3 ELSE 4 END AS tier, md, age, beg, orig FROM tape WHERE fico <> 600 OR age > 20), cs AS (SELECT tier, md, age, sum(CAST(beg AS DOUBLE)) AS v FROM c GROUP BY 1, 2, 3),
whole AS (SELECT tier, sum(CAST(orig AS DOUBLE)) AS o, min(age) AS begun FROM c GROUP BY 1), sn AS (SELECT tier, md, a.age, o FROM (SELECT DISTINCT tier, md FROM c) JOIN whole USING (tier), (SELECT DISTINCT age FROM c) a WHERE a.age >= begun)"""
query("r13_life_curves", _CV + ' SELECT tier AS "primeIndicator", md AS "monthsDelinquent", age, round(sum(coalesce(v, 0)) OVER (PARTITION BY tier, md ORDER BY age) / o, 6) AS share FROM sn LEFT JOIN cs USING (tier, md, age)')(
    lambda s, d: report.curves(enrich.prime_indicator(loans(s, d).filter("consumerCreditScore <> 600 or age > 20"))).withColumn("share", r8("share", 6)))

"""What the plans of heavy queries read and move, and one-pass operators against their parts."""
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loanloom.operators import loantable, metrics, universe, vetting
from loanloom.plans.report_queries import _vt
from loanloom.plans.tape import floor_cents, loans
from loanloom.sources import silver

D = "/root/testdata/sf0.001"


def plan(spark, name):
    return entry.queries()[name](spark, D)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("name", "scans"), [("z8_build_index", 2), ("m4_trust_ratios", 2), ("v21_error_report", 3), ("f4_interaction_tables", 1), ("u6_universe", 2), ("q7_composition_report", 1), ("q1_composition", 2), ("q8_month_aggregate", 2)])
def test_scans(spark, name, scans):
    assert plan(spark, name).count("FileScan") <= scans


@pytest.mark.parametrize("name", ["m3_roll_current_to_30", "v4_v5_walk", "r14_roll_matrix", "le2_le11_lease_flows", "v21_error_report", "z8_build_index"])
def test_no_exchange_by_loan(spark, name):
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(spark, name))
    assert not [m for m in moved if "asset" in m]


def test_silver_keeps_rows_and_places(spark):
    rows = loans(spark, D).filter("securitizationKey like 'Shelf 0%'")
    stored = silver.read_silver(spark, silver.write_silver(rows, 4))
    assert stored.count() == rows.count() and stored.select(rows.columns).exceptAll(rows).count() == 0
    twice = stored.groupBy(*silver.KEYS).agg(F.max("reportingPeriodBeginningDate").alias("last")).join(stored, list(silver.KEYS))
    assert "Exchange hashpartitioning" not in twice.hint("merge")._jdf.queryExecution().executedPlan().toString() or "Broadcast" in twice._jdf.queryExecution().executedPlan().toString()


def test_universe_metrics_equal_the_filtered_loans(spark):
    rows, limits = loans(spark, D), {"min_pool_size": floor_cents(D)}
    once = metrics.universe_metrics(rows, **limits).drop("first_month")
    apart = metrics.trust_month_metrics(universe.apply_universe(rows, universe.build_universe(rows, **limits)))
    text = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(sorted(apart.columns)).collect())
    assert text(once) == text(apart) and len(text(once)) > 500


def test_universe_without_optional_columns(spark):
    rows = spark.createDataFrame([("t", "a", "2020-01-15", 500, 10.0, 0), ("t", "b", "2020-01-01", None, 5.0, 0), ("t", "a", "2020-02-01", 500, 0.5, 1), (None, "x", "2020-01-01", 1, 1.0, 0)], "securitizationKey string, assetNumber string, d string, consumerCreditScore int, reportingPeriodActualEndBalanceAmount double, monthsDelinquent int")
    rows = rows.withColumn("reportingPeriodBeginningDate", F.col("d").cast("date")).drop("d")
    r = universe.build_universe(rows).collect()
    assert len(r) == 1 and r[0]["wavg_fico"] == 500 and r[0]["original_pool"] is None and r[0]["n_loans"] == 2 and r[0]["reason"] == "no_pool_size" and r[0]["exited"] is None


def test_vetting_in_one_pass_equals_its_parts(spark, tmp_path):
    df = _vt(spark, D)
    df = df.unionByName(df.limit(20))
    df.write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    want = vetting.row_counters(df)
    for part in (vetting.opening_balance(df), vetting.missing_months(df), vetting.walks(df), vetting.appearances(df), vetting.after_charge_off(df), vetting.duplicates(df)):
        want = want.join(part, vetting.KEY, "left")
    names = ["Count", "OpenBal", "MissingMonths", "Missing", "Extra", "COExtra", "Dupes", "Pmts", "NegCO", "GreaterCO", "StartMonth"]
    got = {r[vetting.KEY]: r for r in vetting.vet(df).select(vetting.KEY, *names).collect()}
    for r in want.collect():
        assert {n: got[r[vetting.KEY]][n] for n in names} == {n: r[n] if r[n] is not None or n == "StartMonth" else 0 for n in names}
    assert len(got) == want.count()


def test_composition_report_equals_its_parts(spark):
    rows = loans(spark, D)
    # Loans without a beginning balance, negative rates and long terms leave some of the sums.
    k = F.xxhash64("assetNumber", "reportingPeriodBeginningDate") % 7
    rows = rows.withColumns({
        "reportingPeriodBeginningLoanBalanceAmount": F.when((k == 0) | F.col("securitizationKey").like("%2019%"), F.lit(0)).otherwise(F.col("reportingPeriodBeginningLoanBalanceAmount")),
        "reportingPeriodInterestRatePercentage": F.when(k == 1, -0.1).otherwise(F.col("reportingPeriodInterestRatePercentage")),
        "remainingTermToMaturityNumber": F.when(k == 2, 95).otherwise(F.col("remainingTermToMaturityNumber")),
    })
    table = loantable.lean(rows, universe.exit_months(rows, universe.issuance(rows)))
    life, real = loantable.scheduled_wal(loantable.rate_buckets(table)), loantable.realized_wal(loantable.run_off(table))
    want = loantable.composition(table).join(life, "report_month", "left").join(real, "report_month", "left").orderBy("report_month").collect()
    assert len(want) > 50 and any(r["realized_wal"] for r in want)
    for got in (loantable.composition_report(table), loantable.composition_report_of_loans(rows)):
        got = got.orderBy("report_month").collect()
        assert [tuple(r)[:3] for r in got] == [(r["report_month"], r["n_loans"], r["balance"]) for r in want]
        for a, b in zip(got, want):
            for c in ("wa_fico", "wa_orig_term", "wa_rem_term", "scheduled_wal", "realized_wal"):
                assert (a[c] is None) == (b[c] is None) and (a[c] is None or abs(a[c] - b[c]) <= 0.0051), c

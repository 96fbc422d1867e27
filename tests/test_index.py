"""Hand-computed trust, qualification, flag and payoff cases."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from loanloom.operators import metrics, stress, universe

LOAN = "securitizationKey string, assetNumber string, reportingPeriodBeginningDate date, monthsDelinquent int, currentDelinquencyStatus int, reportingPeriodBeginningLoanBalanceAmount double, reportingPeriodActualEndBalanceAmount double, chargedoffPrincipalAmount double, recoveredAmount double, netLosses double, actualInterestCollectedAmount double"


def _rows(trust="TEST"):
    states = {"A": (0, 1, 5), "B": (0, 0, 0), "C": (1, 2, 3)}
    for asset, mds in states.items():
        for m, md in enumerate(mds, 1):
            off = md == 5
            days = 0 if md > 4 else md * 30
            yield trust, asset, dt.date(2023, m, 1), md, days, 100.0, 0.0 if off else 100.0, 100.0 if off else 0.0, 40.0 if off else 0.0, 60.0 if off else 0.0, 1.0


def _by_month(df):
    return {r["month"].month: r for r in df.collect()}


def test_trust_ratios(spark):
    got = _by_month(metrics.trust_month_metrics(spark.createDataFrame(list(_rows()), LOAN)))
    assert got[1]["delq30plus"] == pytest.approx(1 / 3) and got[1]["roll_c_to_30"] == pytest.approx(0.5)
    assert got[2]["delq30plus"] == pytest.approx(2 / 3) and got[2]["delq60plus"] == pytest.approx(1 / 3) and got[2]["roll_c_to_30"] == 0
    assert got[3]["delq30plus"] == pytest.approx(0.5) and got[3]["net_loss_annl"] == pytest.approx(12 * 60 / 300) and got[3]["recovery_rate"] == pytest.approx(0.4)
    assert got[3]["roll_c_to_30"] is None


def test_a_second_trust_keeps_the_ratios(spark):
    one = spark.createDataFrame(list(_rows()), LOAN)
    two = spark.createDataFrame([*_rows(), *_rows("TEST2")], LOAN)
    a, b = (_by_month(metrics.pool_metrics(metrics.trust_month_metrics(x))) for x in (one, two))
    for m in (1, 2, 3):
        assert b[m]["n_trusts"] == 2 and a[m]["n_trusts"] == 1
        assert all(a[m][c] == b[m][c] for c in ("delq30plus", "delq60plus", "roll_c_to_30", "net_loss_annl", "recovery_rate"))


def test_universe_rules(spark):
    trusts = [("Subprime Auto Trust 2022-1", 600, 24), ("Subprime Auto Trust 2022-2", 615, 24), ("Prime Auto Trust 2022-1", 730, 24), ("Tiny Subprime Trust 2022-1", 590, 4)]
    rows = [(t, str(k), dt.date(2022 + m // 12, m % 12 + 1, 1), m, float(f), 20e6, 20e6 * max(0, 1 - m / 60), 20e6 * max(0, 1 - m / 60)) for t, f, n in trusts for k in range(n) for m in range(30)]
    df = spark.createDataFrame(rows, "securitizationKey string, assetNumber string, reportingPeriodBeginningDate date, monthsFromCutoffDate int, consumerCreditScore double, originalLoanAmount double, reportingPeriodBeginningLoanBalanceAmount double, reportingPeriodActualEndBalanceAmount double")
    got = {r["securitizationKey"]: r for r in universe.build_universe(df).collect()}
    assert [got[t]["qualifies"] for t, _, _ in trusts] == [True, True, False, False]
    assert got["Prime Auto Trust 2022-1"]["reason"] == "wavg_fico=730>=640" and "pool=$80M<=$200M" in got["Tiny Subprime Trust 2022-1"]["reason"]
    assert universe.apply_universe(df, universe.build_universe(df)).select("securitizationKey").distinct().count() == 2


def test_covid_flag(spark):
    months = spark.range(40).select(F.add_months(F.lit("2019-06-01").cast("date"), F.col("id").cast("int")).alias("month"))
    flagged = sorted(r["month"] for r in months.filter(stress.covid_flag(F.col("month"))).collect())
    assert len(flagged) == 9 and flagged[0] == dt.date(2020, 4, 1) and flagged[-1] == dt.date(2020, 12, 1)


def test_rolling_score_needs_enough_rows(spark):
    rows = [("s", dt.date(2020 + k // 12, k % 12 + 1, 1), float(k)) for k in range(15)]
    out = stress.rolling_z(spark.createDataFrame(rows, "k string, month date, v double"), ["v"], ["k"]).orderBy("month").collect()
    assert all(r["z_v"] is None for r in out[:11]) and all(r["z_v"] > 0 for r in out[11:])


def test_empty_tape(spark):
    assert metrics.trust_month_metrics(spark.createDataFrame([], LOAN)).count() == 0


def test_importances_take_the_whole_tape(spark, monkeypatch):
    from loanloom.operators import features
    from loanloom.plans import compare_queries  # noqa: F401  registers
    from loanloom.plans.registry import QUERIES
    from loanloom.plans.tape import loans

    seen, fit = [], features.importances

    def spy(df, columns, **more):
        seen.append((df.count(), more))
        return fit(df, columns, trees=2)

    monkeypatch.setattr(features, "importances", spy)
    rows = QUERIES["f2_importances"](spark, "/root/testdata/sf0.001").collect()
    assert seen == [(loans(spark, "/root/testdata/sf0.001").count(), {})]
    assert len(rows) == 4 and all(0 <= r["area"] <= 1 for r in rows)
    assert sum(r["importance"] for r in rows) == pytest.approx(1, abs=1e-5)

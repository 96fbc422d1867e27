"""The entry module's contract on the smallest tables."""
import duckdb
import pytest

import __spark_entry__ as entry

D = "/root/testdata/sf0.01"
FEW = ["u6_universe", "m4_trust_ratios", "q3_level_pay_life", "c8_rates_rescaled", "e13_e14_due_amount", "v7_v8_missing_and_extra", "r4_r5_summary", "r2_r5_all_strata", "v21_error_report", "v22_numeric_profile", "f2_roc", "f2_area", "f1_trust_flags", "z6_component_index", "q13_method_difference", "x4_margin_calls", "le13_scores_and_tiers", "le15_implied_rates", "lc5_makers_and_models", "lc6_rates_and_fees", "s2_listed_filings_only", "q1_composition", "q7_composition_report", "q8_month_aggregate", "e19_lean_projection"]


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    marks = entry.entry(spark)
    assert marks.count() == 96 and marks.filter("stress_index_zavg is not null").count() > 50


@pytest.mark.parametrize("name", FEW)
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("orders", "customer"):
        con.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, D).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    names = sorted(got.columns)
    text = lambda df: sorted(tuple("" if v != v or v is None else f"{v:.5f}" if isinstance(v, float) else str(v)[:10] if hasattr(v, "year") else str(v) for v in r) for r in df[names].itertuples(index=False, name=None))
    assert text(got) == text(want)

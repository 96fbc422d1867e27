"""What the steps store and move as the tables grow."""
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from loanloom.plans import tape as tp

D = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tape_stores_loans_in_buckets_that_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(tp, "_written", {})
    monkeypatch.setattr(tp, "BUCKET_LOANS", 100)
    tape = tp.tape(spark, D)
    loans = spark.read.parquet(f"{D}/orders.parquet").count()
    (name,) = tp._written.values()
    assert spark.table(name).count() == loans and tape.count() > 10 * loans
    assert int(re.search(r"SelectedBucketsCount: (\d+)", plan(tape.groupBy("sec", "asset").count())).group(1)) == -(-loans // 100)
    con = duckdb.connect()
    for t in ("orders", "customer"):
        con.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    want = con.execute(f"WITH {tp.tape_sql(True)} SELECT sec, asset, mi, beg, endb, co, rec, dpd FROM tape").fetchall()
    assert sorted(want) == sorted(tuple(r) for r in tape.select("sec", "asset", "mi", "beg", "endb", "co", "rec", "dpd").collect())


def test_cents_are_exact_beyond_the_whole_numbers_of_doubles(spark):
    from loanloom.plans.clean_queries import cents

    rows = spark.createDataFrame([(40_000_000_000_000.25,), (40_000_000_000_000.25,), (40_000_000_000_000.25,), (0.01,), (0.02,), (None,)], "x double")
    assert rows.agg(cents("x", "c")).collect()[0]["c"] == 12_000_000_000_000_078


@pytest.mark.parametrize("name", ["c8_rates_rescaled", "e4_principal_tie_out", "e12_months_delinquent", "e17_net_losses", "le2_le13_enriched_leases", "le15_implied_rates", "u7_apply_universe"])
def test_loan_rows_stay_where_they_are(spark, name):
    import __spark_entry__ as entry

    text = plan(entry.queries()[name](spark, D))
    assert not [m for m in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text) if re.search("asset|Manufacturer|Location|Term", m)]
    assert "SortMergeJoin" not in text


def test_a_restatement_is_told_beside_its_first_filing(spark):
    import __spark_entry__ as entry

    text = plan(entry.queries()["t3_restatement_wins"](spark, D))
    assert "Join" not in text and not re.findall(r"Exchange hashpartitioning\([^)]*asset", text)


def test_appearances_broadcast_no_loans(spark):
    import __spark_entry__ as entry
    from loanloom.operators import vetting

    text = plan(entry.queries()["v7_v8_missing_and_extra"](spark, D))
    assert text.count("BroadcastExchange") <= 1 and "SortMergeJoin" not in text and not re.findall(r"Exchange hashpartitioning\([^)]*asset", text)
    rows = [("t", "a", "2020-01-01", 1.0), ("t", "a", "2020-01-01", 0.0), ("t", "a", "2020-03-01", 1.0), ("t", "b", "2020-01-01", 1.0), ("t", "b", "2020-02-01", 0.0), ("t", "b", "2020-03-01", 5.0), ("t", None, "2020-01-01", 1.0), ("t", None, "2020-02-01", None), ("t", "c", None, 1.0), (None, "d", "2020-01-01", 1.0), ("u", "e", "2020-01-01", 1.0)]
    df = spark.createDataFrame(rows, "securitizationKey string, assetNumber string, d string, reportingPeriodActualEndBalanceAmount double").withColumn("reportingPeriodBeginningDate", F.col("d").cast("date"))
    # a lacks February, a null number matches nothing; a is new in March, b had no balance before March, the null number is new in February
    assert [tuple(r) for r in vetting.appearances(df).collect()] == [("t", 2, 3)]


def test_restatements_are_joined_without_a_broadcast_of_the_tape(spark):
    from loanloom.plans import source_queries as sq

    rows = spark.createDataFrame([], f"{sq.KEY} string, assetNumber string, reportingPeriodBeginningDate date, reportingPeriodActualEndBalanceAmount double")
    table = type("Held", (), {"read": lambda self: rows})()
    assert "BroadcastHashJoin" not in plan(sq._restated(spark, D, table))


@pytest.mark.parametrize("name", ["e12_months_delinquent", "e15_principal_prepaid", "e4_principal_tie_out", "e17_net_losses", "c8_rates_rescaled"])
def test_generated_methods_are_small_enough_to_be_compiled(spark, name):
    import __spark_entry__ as entry

    spark.conf.set("spark.sql.adaptive.enabled", "false")  # its plans show no code
    try:
        kind = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = entry.queries()[name](spark, D)._jdf.queryExecution().explainString(kind)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 7200  # the JVM compiles up to 8000 bytes


def test_written_filings_are_compressed_and_bounded(spark, monkeypatch, tmp_path):
    from loanloom.sources import readers

    monkeypatch.setattr(readers, "FILING_ROWS", 10)
    readers.write_tape(spark.range(30).coalesce(1).select(F.col("id").cast("string").alias("assetNumber")), str(tmp_path / "x"))
    files = [f.name for f in (tmp_path / "x").glob("part-*")]
    assert len(files) == 3 and all(f.endswith(".xml.gz") for f in files)
    assert sorted(int(r[0]) for r in readers.read_tape(spark, str(tmp_path / "x"), keep=["assetNumber"]).collect()) == list(range(30))


def test_state_and_gold_store_no_whole_tape(spark, monkeypatch, tmp_path):
    from loanloom.plans import source_queries as sq

    monkeypatch.setattr(sq, "_folder", lambda s: str(tmp_path / "z9"))
    sq._stored(spark, D)
    assert [f.name for f in (tmp_path / "z9").iterdir()] == ["state"]
    monkeypatch.setattr(sq, "_folder", lambda s: str(tmp_path / "t4"))
    sq._gold(spark, D)
    assert set(spark.read.parquet(str(tmp_path / "t4" / "loans" / "data")).columns) == {*sq.GOLD, "folder"}


def test_gold_moves_loans_before_months_are_made_and_months_once(spark, tmp_path):
    from loanloom.operators import metrics
    from loanloom.plans import source_queries as sq

    rows = tp.loans(spark, D, by_trust=True).select(*sq.GOLD)
    text = plan(rows)
    assert text.index("Generate explode") < text.index("Exchange rangepartitioning") and text.count("Exchange") == 1
    plain = tp.loans(spark, D).select(*sq.GOLD)
    assert rows.count() == plain.count() and rows.exceptAll(plain).isEmpty()
    plain.write.parquet(str(tmp_path / "rows"))
    held = spark.read.parquet(str(tmp_path / "rows"))
    once = metrics.current_to_30(held, deal=True)
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*asset", plan(once))) == 1
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, metrics.current_to_30(held).collect()))


def test_hedge_makes_the_index_once(spark, monkeypatch):
    import __spark_entry__ as entry
    from loanloom.plans import compare_queries as cq

    made, plain = [], cq._index
    monkeypatch.setattr(cq, "_index", lambda *a, **k: made.append(1) or plain(*a, **k))
    assert entry.queries()["x6_hedge"](spark, D).columns == ["position", "month", "net"] and len(made) == 1


def test_raw_texts_are_those_of_decimals_and_dates_but_made_from_whole_numbers(spark):
    from loanloom.plans import raw

    rows = spark.sql("SELECT c, c AS i, 24244 + c AS mi, 24200 + c AS om, make_date(CAST((24244 + c) div 12 AS INT), CAST((24244 + c) % 12 + 1 AS INT), 1) AS month, make_date(CAST((24200 + c) div 12 AS INT), CAST((24200 + c) % 12 + 1 AS INT), 1) AS orig_month FROM (SELECT id - 130 AS c FROM range(260))")
    money = spark.sql("SELECT id - 130 AS c FROM range(260) UNION ALL SELECT 123456789012 UNION ALL SELECT CAST(NULL AS BIGINT)")
    want = F.expr("CAST(CAST(CAST(c AS DECIMAL(20, 2)) / 100 AS DECIMAL(20, 2)) AS STRING)")
    assert money.filter(~F.expr(raw._MONEY.format("c")).eqNullSafe(want)).count() == 0
    dates = {"begin": F.when(F.col("i") % 2 == 0, F.date_format("month", "M-d-yyyy")).otherwise(F.date_format("month", "MM-dd-yyyy")), "end": F.date_format(F.last_day("month"), "MM-dd-yyyy"), "orig": F.date_format("orig_month", "MM/yyyy")}
    for name, text in dates.items():
        assert rows.filter(~F.expr(raw._DATES[name]).eqNullSafe(text)).count() == 0
    assert "date_format" not in plan(raw.raw_tape(spark, D)).lower() and "/ 100" not in plan(raw.raw_tape(spark, D).select("recoveredAmount"))

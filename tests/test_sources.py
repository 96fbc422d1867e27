"""Readers, writers and the ingest stream, on files of a temporary folder."""
import datetime as dt

from pyspark.sql import functions as F

from loanloom.operators import book, clean, compare, lease
from loanloom.sources import readers
from loanloom.streaming import ingest as ing

ROW = "<assets><assetNumber>{a}</assetNumber><reportingPeriodBeginningDate>{m}-1-2023</reportingPeriodBeginningDate><reportingPeriodActualEndBalanceAmount>{e}</reportingPeriodActualEndBalanceAmount><subvented>1</subvented><subvented>2</subvented></assets>"


def _file(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text('<?xml version="1.0"?><assetData xmlns="urn:x">' + "".join(ROW.format(a=a, m=m, e=e) for a, m, e in rows) + "</assetData>")


def _prepare(rows):
    typed = clean.typed(rows.select("assetNumber", "reportingPeriodBeginningDate", "reportingPeriodActualEndBalanceAmount", "filename"))
    return typed.withColumn("securitizationKey", F.substring_index("filename", "_", 1)).withColumn("reportDate", F.regexp_extract("filename", r"_(\d+)", 1))


def test_xml_round_trip(spark, tmp_path):
    _file(tmp_path / "in", "T1_20230201.xml", [("A", 1, 10), ("B", 1, 20)])
    rows = readers.read_tape(spark, str(tmp_path / "in")).orderBy("assetNumber").collect()
    assert [r["assetNumber"] for r in rows] == ["A", "B"] and rows[0]["subvented"] == ["1", "2"] and rows[0]["originalLoanTerm"] is None
    pruned = readers.read_tape(spark, str(tmp_path / "in"), keep=["assetNumber"])
    assert pruned.columns == ["assetNumber"] and pruned.count() == 2
    listing = spark.createDataFrame([("Big Auto Trust 2023-1", "T1_20230201.xml", "Trust", "Auto Loans", "20230201", "u")], readers.LISTING)
    joined = readers.read_tapes(spark, listing, str(tmp_path / "in"), "Trust", "Auto Loans").collect()
    assert len(joined) == 2 and joined[0]["shelf"] == "Big Auto Trust" and joined[0]["reportingPeriodBeginningDate"] == dt.date(2023, 1, 1)


def test_ingest_reads_new_files_once_and_later_reports_win(spark, tmp_path):
    folder, table, mark = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "mark")
    _file(folder, "T1_20230201.xml", [("A", 1, 10), ("B", 1, 20)])
    run = lambda: ing.ingest(ing.filings(spark, str(folder)), _prepare, table, mark).awaitTermination(120)
    assert run()
    assert spark.read.parquet(table).count() == 2
    _file(folder, "T1_20230301.xml", [("A", 1, 11), ("A", 2, 9)])
    _file(folder, "T2_20230301.xml", [("C", 1, 5)])
    assert run() and run()
    got = {(r["securitizationKey"], r["assetNumber"], r["reportingPeriodBeginningDate"].month): r["reportingPeriodActualEndBalanceAmount"] for r in spark.read.parquet(table).collect()}
    assert got == {("T1", "A", 1): 11.0, ("T1", "B", 1): 20.0, ("T1", "A", 2): 9.0, ("T2", "C", 1): 5.0}


def test_benchmarks(spark, tmp_path):
    (tmp_path / "b.csv").write_text("date,value\n2023-03-31,1.5\nnone,2\n2023-06-30,x\n2022-12-31,1\n")
    assert [r["value"] for r in readers.read_benchmark(spark, str(tmp_path / "b.csv")).collect()] == [1.0, 1.5]
    (tmp_path / "q.csv").write_text("label,value\n03:Q1,0.02\n201702,3.5\nbad,1\n")
    got = {r["date"]: r["value"] for r in readers.read_quarters(spark, str(tmp_path / "q.csv")).collect()}
    assert got == {dt.date(2003, 3, 31): 2.0, dt.date(2017, 6, 30): 3.5}
    readers.write_quarters(readers.read_quarters(spark, str(tmp_path / "q.csv")), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 2


def test_dictionaries_and_listing(spark, tmp_path):
    (tmp_path / "d.csv").write_text("old,new\nA,B\n")
    (tmp_path / "l.csv").write_text("secname,filename,entitytype,assetclass,reportdate,url\nX Trust,f.xml,Trust,Auto Loans,20230101,u\n")
    assert readers.read_dictionary(spark, str(tmp_path / "d.csv")).first()["new"] == "B"
    assert readers.read_listing(spark, str(tmp_path / "l.csv")).first()["secname"] == "X Trust"


def test_upsert_and_partitions(spark, tmp_path):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "securitizationKey string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "securitizationKey string, v int")
    assert {tuple(r) for r in readers.upsert(old, new, ["securitizationKey"]).collect()} == {("a", 1), ("b", 3), ("c", 4)}
    path = str(tmp_path / "t")
    readers.write_partitions(old, path, "securitizationKey")
    readers.write_partitions(new, path, "securitizationKey")
    assert {(r["securitizationKey"], r["v"]) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 3), ("c", 4)}


def test_payoffs(spark):
    """±20 % on 100 000; a short is liquidated at +100 % and healthy below the margin."""
    marks = spark.createDataFrame([(dt.date(2023, 1, 1), 100.0), (dt.date(2023, 2, 1), 120.0)], "month date, level double")
    book_ = spark.createDataFrame([(1, 1, 100_000.0), (2, -1, 100_000.0)], "position int, side int, notional double").withColumns({"entry": F.lit("2023-01-01").cast("date"), "exit": F.lit("2023-12-01").cast("date")})
    profit = book.profits(book.paths(book_, marks))
    assert {r["position"]: r["total"] for r in book.risk(profit).collect()} == {1: 20_000.0, 2: -20_000.0}
    out = {r["position"]: r for r in book.liquidations(profit).collect()}
    assert out[1]["liquidated"] is None and out[1]["payout"] == 40_000.0 and out[2]["liquidated"] == dt.date(2023, 2, 1) and out[2]["payout"] == 0.0
    calls = {r["position"]: (r["calls"], r["topped"], r["equity"]) for r in book.margin_calls(profit).collect()}
    assert calls == {1: (0, 0.0, 40_000.0), 2: (1, 20_000.0, 20_000.0)}


def test_implied_rate(spark):
    """A lease priced at 6 % gives 6 % back."""
    r, n, pay, rest = 0.005, 36, 300.0, 9000.0
    cost = sum(pay / (1 + r) ** k for k in range(n)) + rest / (1 + r) ** n
    df = spark.createDataFrame([(n, pay, cost, rest), (None, pay, cost, rest)], f"{lease.TERM} int, {lease.PAY} double, acquisitionCost double, contractResidualValue double")
    got = [x["originalInterestRatePercentage"] for x in lease.implied_rates(df).orderBy(lease.TERM).collect()]
    assert got[0] is None and abs(got[1] - 0.06) < 1e-6


def test_correlations_need_four_rows(spark):
    df = spark.createDataFrame([("k", float(i), float(i * i)) for i in range(5)] + [("few", 1.0, 2.0)], "k string, a double, b double")
    got = {r["k"]: r for r in compare.correlations(df, ["k"]).collect()}
    assert got["few"]["pearson"] is None and got["k"]["spearman"] == 1.0


def test_refresh_replaces_only_the_given_trusts(spark, tmp_path):
    from loanloom.plans.tape import loans
    from loanloom.operators.metrics import trust_month_metrics

    rows = loans(spark, "/root/testdata/sf0.001").filter("securitizationKey like 'Shelf 0%'")
    first, second = sorted(r[0] for r in rows.select("securitizationKey").distinct().collect())[:2]
    rows, gold = rows.filter(F.col("securitizationKey").isin(first, second)), str(tmp_path / "gold")
    ing.refresh(rows, gold)
    halved = rows.withColumn("reportingPeriodBeginningLoanBalanceAmount", (F.col("reportingPeriodBeginningLoanBalanceAmount") / 2).cast("long"))
    ing.refresh(halved, gold, [second])
    stored = spark.read.parquet(gold)
    for trust, source in ((first, rows), (second, halved)):
        own = trust_month_metrics(source.filter(F.col("securitizationKey") == trust))
        same = stored.filter(F.col("securitizationKey") == trust).select(own.columns)
        assert own.count() == same.count() and own.exceptAll(same).count() == 0

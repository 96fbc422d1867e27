"""The dirty raw tape over the fixture, as text, and its SQL twin."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import TAPE
from .tape import tape

# one text for both engines; money in dollars with two decimals, rates in percent for even nations
_MONEY = "concat(CASE WHEN ({0}) < 0 THEN '-' ELSE '' END, CAST(abs({0}) div 100 AS STRING), '.', substr(CAST(100 + abs({0}) % 100 AS STRING), 2))"
# texts are put together from whole numbers: decimals and date formats took most of the time of a loan month
_MM, _YYYY = "substr(CAST(100 + mi % 12 + 1 AS STRING), 2)", "CAST(mi div 12 AS STRING)"
_DATES = {
    "begin": f"CASE WHEN i % 2 = 0 THEN concat(CAST(mi % 12 + 1 AS STRING), '-1-', {_YYYY}) ELSE concat({_MM}, '-01-', {_YYYY}) END",
    "end": f"concat({_MM}, '-', CAST(day(last_day(month)) AS STRING), '-', {_YYYY})",
    "orig": "concat(substr(CAST(100 + om % 12 + 1 AS STRING), 2), '/', CAST(om div 12 AS STRING))",
}
_STATES = [("CA", "West"), ("TX", "South"), ("FL", "South"), ("OH", "Midwest"), ("NJ", "Northeast")]
BASE = f"""SELECT t.*, CASE WHEN co > 0 AND k % 14 = 0 THEN 0 WHEN co > 0 AND k % 21 = 0 THEN beg - co2 - repo ELSE rec END AS raw_rec,
  CASE WHEN co > 0 AND k % 14 = 0 THEN co WHEN co > 0 AND k % 21 = 0 THEN co2 ELSE co END AS raw_co FROM (
  SELECT t.*, CASE WHEN co > 0 AND k % 14 = 0 THEN co DIVOP 4 WHEN co > 0 AND k % 21 = 0 THEN beg DIVOP 4 ELSE 0 END AS repo, beg DIVOP 2 AS co2 FROM TAPE t) t"""
COLS = {
    "rate_text": "CASE WHEN nk % 2 = 0 THEN CAST(CAST(apr_bps AS DECIMAL(20, 4)) / 100 AS DECIMAL(20, 4)) WHEN k % 103 = 0 THEN CAST(7.5 AS DECIMAL(20, 4)) ELSE CAST(CAST(apr_bps AS DECIMAL(20, 4)) / 10000 AS DECIMAL(20, 4)) END",
    "fee": "CASE WHEN k % 7 = 0 THEN CAST(0.0004 AS DECIMAL(20, 4)) ELSE CAST(0.02 AS DECIMAL(20, 4)) END",
}


def base_sql(duck: bool) -> str:
    return BASE.replace("DIVOP", "//" if duck else "div")


#: The raw tape's rows in DuckDB, before duplicates.
RAW = TAPE + f", raw AS ({base_sql(True).replace('TAPE t', 'tape t')})"


def raw_rows(spark, d) -> DataFrame:
    """The tape with raw charge-off, recovery and repossession amounts."""
    return spark.sql(base_sql(False).replace("TAPE t", "{t} t"), t=tape(spark, d))


def raw_tape(spark, d, duplicates: bool = True) -> DataFrame:
    """Text columns as a filing has them; a second, later filing restates some loan months by a cent."""
    rows = raw_rows(spark, d)
    money = lambda c: F.expr(_MONEY.format(c))
    # a loan month's first filing and, of some, its restatement, beside each other: copies are made without another pass or move
    # without restatements it is one copy each: the step also parts the generated code of what is above and below it, as a
    # method of more than 8000 bytes is never compiled by the JVM and takes some ten times as long
    copies = F.when(F.col("k") % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))) if duplicates else F.array(F.lit(0))
    rows = rows.withColumn("again", F.explode(copies))
    return rows.select(
        F.col("sec").alias("securitizationKey"), F.col("asset").alias("assetNumber"),
        F.expr(_DATES["begin"]).alias("reportingPeriodBeginningDate"), F.expr(_DATES["end"]).alias("reportingPeriodEndingDate"), F.expr(_DATES["orig"]).alias("originationDate"),
        F.when(F.col("k") % 61 == 0, F.lit(None)).otherwise(money("beg")).alias("reportingPeriodBeginningLoanBalanceAmount"), money("endb + again").alias("reportingPeriodActualEndBalanceAmount"),
        money("prin").alias("actualPrincipalCollectedAmount"), money("raw_co").alias("chargedoffPrincipalAmount"), money("raw_rec").alias("recoveredAmount"), money("repo").alias("repossessedProceedsAmount"),
        money("interest").alias("actualInterestCollectedAmount"), money("sched_prin").alias("scheduledPrincipalAmount"), money("interest").alias("scheduledInterestAmount"), money("sched_prin + interest").alias("nextReportingPeriodPaymentAmountDue"),
        money("orig").alias("originalLoanAmount"), money("veh_value").alias("vehicleValueAmount"), F.col("term").cast("string").alias("originalLoanTerm"), F.expr("term - age").cast("string").alias("remainingTermToMaturityNumber"),
        F.when(F.col("k") % 101 == 0, F.lit("NONE")).otherwise(F.col("fico").cast("string")).alias("obligorCreditScore"), F.col("score_type").alias("obligorCreditScoreType"),
        F.expr(COLS["rate_text"]).cast("string").alias("reportingPeriodInterestRatePercentage"), F.expr(COLS["fee"]).cast("string").alias("servicingFeePercentage"),
        F.col("dpd").cast("string").alias("currentDelinquencyStatus"), F.col("state").alias("obligorGeographicLocation"), F.concat(F.lit("Brand#"), (F.col("k") % 10).cast("string")).alias("vehicleManufacturerName"),
        F.add_months("month", F.col("again") + 1).alias("reportDate"),
    )


def manufacturers(spark) -> DataFrame:
    """A small dictionary: half of the brands."""
    return spark.createDataFrame([(f"Brand#{k}", f"Maker {k // 2}") for k in range(0, 10, 2)], "old string, new string")


def states(spark) -> DataFrame:
    return spark.createDataFrame(_STATES, "state string, region string")

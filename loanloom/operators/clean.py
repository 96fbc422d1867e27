"""Cleaning of raw loan and lease tapes: typed fields, defaults, duplicates, lookups, rates."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import double
from ..sources.schemas import FIELDS


def parse_date(c: Column) -> Column:
    """``M-d-yyyy``, null if it is no date; dates stay."""
    return F.to_date(F.try_to_timestamp(c.cast("string"), F.lit("M-d-yyyy")))


def parse_month(c: Column) -> Column:
    """``MM/yyyy`` as the month's first day."""
    return F.to_date(F.try_to_timestamp(c.cast("string"), F.lit("MM/yyyy")))


def typed(df: DataFrame, kind: str = "loan") -> DataFrame:
    """Dates and numbers from text, null where they are neither."""
    fields, types = FIELDS[kind], dict(df.dtypes)
    out = {}
    for c in fields["date"]:
        if types.get(c) == "string":
            out[c] = F.coalesce(parse_date(F.col(c)), parse_month(F.col(c)))
    for c in (*fields["decimal"], *fields["integer"], *fields["rate"]):
        if c in types:
            out[c] = F.col(c).try_cast("double") if types[c] == "string" else double(c)
    return df.withColumns(out)


def defaults(df: DataFrame, kind: str = "loan") -> DataFrame:
    """0 for event amounts (made if absent), and for codes, scores and days if present."""
    zero, fill = FIELDS[kind]["zero"], [c for c in FIELDS[kind]["fill"] if c in df.columns]
    make = {c: F.coalesce(double(c), F.lit(0.0)) if c in df.columns else F.lit(0.0) for c in zero}
    return df.withColumns(make | {c: F.coalesce(double(c), F.lit(0.0)) for c in fill})


def keep_last(df: DataFrame, begin: str = "reportingPeriodBeginningDate", order: list[str] | None = None) -> DataFrame:
    """One row per asset, begin date and trust: that of the latest filing. Null keys are equal to each other."""
    order = [c for c in (order or ["reportDate", "filename"]) if c in df.columns]
    w = Window.partitionBy("securitizationKey", "assetNumber", begin).orderBy(*(F.col(c).desc() for c in order), F.monotonically_increasing_id().desc())
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def translated(df: DataFrame, column: str, names: DataFrame, missing: str = "N/A") -> DataFrame:
    """``column`` through a dictionary of ``old`` and ``new``: the new name, else the old, else ``missing``."""
    pairs = names.select(F.col("old").alias(column), F.col("new").alias("_new"))
    return df.join(F.broadcast(pairs), column, "left").withColumn(column, F.coalesce("_new", column, F.lit(missing))).drop("_new")


def rate_statistics(df: DataFrame, rates: list[str]) -> DataFrame:
    """Per trust and rate: share of values above 1 and the largest value, all rates in one pass."""
    measures = [m for c in rates for m in (F.avg(F.when(F.col(c).isNotNull(), (F.col(c) > 1).cast("int"))).alias(f"{c}_above"), F.max(c).alias(f"{c}_max"))]
    return df.groupBy("securitizationKey").agg(*measures)


def rescaled(df: DataFrame, rates: list[str], share: float = 0.4, most: float = 5.0) -> DataFrame:
    """Rates in percent become fractions where a trust mostly reports percent; what is still above 1 goes."""
    out = df.join(F.broadcast(rate_statistics(df, rates)), "securitizationKey", "left")  # a row for each trust
    new = {}
    for c in rates:
        x, big = F.col(c), F.coalesce(F.col(f"{c}_max") > most, F.lit(False))
        percent = big & F.coalesce(F.col(f"{c}_above") > share, F.lit(False))
        y = F.when(percent & (x > 1), x / 100).when(big & ~percent & (x > most), F.lit(None)).otherwise(x)
        new[c] = F.when(y > 1, F.lit(None)).otherwise(y)
    return out.withColumns(new).drop(*(f"{c}_{s}" for c in rates for s in ("above", "max")))


def fee_floor(df: DataFrame, least: float, column: str = "servicingFeePercentage", fee: float = 0.01) -> DataFrame:
    return df.withColumn(column, F.when(F.abs(column) < least, F.lit(fee)).otherwise(F.col(column)))


def clean(df: DataFrame, kind: str = "loan", manufacturers: DataFrame | None = None, models: DataFrame | None = None) -> DataFrame:
    """All steps over a raw tape."""
    begin = "reportingPeriodBeginningDate" if kind == "loan" else "reportingPeriodBeginDate"
    if kind == "lease":
        df = df.filter("securitizationKey is null or securitizationKey <> 'DAIMLER TRUST LEASING LLC'")
    out = defaults(typed(df, kind), kind)
    if kind == "lease":
        out = double_months(out)
    out = keep_last(out, begin)
    for column, names in (("vehicleManufacturerName", manufacturers), ("vehicleModelName", models)):
        if names is not None and column in out.columns:
            out = translated(out, column, names)
    rates = [c for c in FIELDS[kind]["rate"] if c in out.columns]
    out = rescaled(out, rates) if rates else out
    return fee_floor(out, 0.001 if kind == "loan" else 0.01) if "servicingFeePercentage" in out.columns else out


def double_months(df: DataFrame) -> DataFrame:
    """Lease rows that end in the month after they begin: they begin a month later, at the value the asset's row of
    the month they began in ended with (null if there is none)."""
    number = lambda c: F.year(c) * 12 + F.month(c)
    twice = F.coalesce(number("reportingPeriodEndDate") - number("reportingPeriodBeginDate") == 1, F.lit(False))
    moved = df.withColumn("_twice", twice).withColumn("reportingPeriodBeginDate", F.when(twice, F.add_months("reportingPeriodBeginDate", 1)).otherwise(F.col("reportingPeriodBeginDate")))
    w = Window.partitionBy("securitizationKey", "assetNumber").orderBy("reportingPeriodBeginDate")
    before = F.when(number(F.lag("reportingPeriodBeginDate").over(w)) == number("reportingPeriodBeginDate") - 1, F.lag("reportingPeriodEndActualSecuritizationAmount").over(w))
    value = "reportingPeriodSecuritizationValueAmount"
    return moved.withColumn(value, F.when(F.col("_twice"), before).otherwise(F.col(value))).drop("_twice")

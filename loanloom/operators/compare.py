"""Benchmarks against index series: quarters, correlations, standardised views."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import double


def quarter_end(c: Column) -> Column:
    return F.last_day(F.add_months(F.date_trunc("quarter", c).cast("date"), 2))


def label_quarter(label: Column) -> Column:
    """Quarter end of labels such as ``03:Q1`` (year 2003) or ``201702`` (second quarter of 2017)."""
    short = F.regexp_extract(label, r"^(\d{2}):Q([1-4])$", 1)
    year = F.when(short != "", F.lit(2000) + short.try_cast("int")).otherwise(F.regexp_extract(label, r"^(\d{4})0([1-4])$", 1).try_cast("int"))
    q = F.when(short != "", F.regexp_extract(label, r"^(\d{2}):Q([1-4])$", 2).try_cast("int")).otherwise(F.regexp_extract(label, r"^(\d{4})0([1-4])$", 2).try_cast("int"))
    return F.last_day(F.make_date(year, q * 3, F.lit(1)))


def quarterly(series: DataFrame, levels: list[str], flows: list[str]) -> DataFrame:
    """By quarter end: mean of levels; flows compounded, 1 less the product of 1 - x."""
    return series.groupBy(quarter_end(F.col("month")).alias("quarter")).agg(*(F.avg(c).alias(c) for c in levels), *((1 - F.product(1 - F.col(c))).alias(c) for c in flows))


def average_rank(c: str, by: list[str] | None = None) -> Column:
    """Rank with ties sharing their mean."""
    w = Window.partitionBy(*(by or []), c)
    return F.rank().over(Window.partitionBy(*(by or [])).orderBy(c)) + (F.count(F.lit(1)).over(w) - 1) / 2


def correlations(pairs: DataFrame, by: list[str], a: str = "a", b: str = "b", least: int = 4) -> DataFrame:
    """Per key: n, Pearson and Spearman over complete rows; null for fewer than ``least``."""
    rows = pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    ranked = rows.withColumn("_ra", average_rank(a, by)).withColumn("_rb", average_rank(b, by))
    enough = F.count(F.lit(1)) >= least
    return ranked.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.when(enough, F.corr(a, b)).alias("pearson"), F.when(enough, F.corr("_ra", "_rb")).alias("spearman"))


def correlation_grid(aligned: DataFrame, metrics: list[str], benchmarks: list[str], least_trusts: int = 4) -> DataFrame:
    """Correlations of each metric with each benchmark, over all rows and over rows with enough trusts."""
    scope = F.explode(F.when(F.col("n_trusts") >= least_trusts, F.array(F.lit("full"), F.lit("enough"))).otherwise(F.array(F.lit("full"))))
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.lit(b).alias("benchmark"), double(m).alias("a"), double(b).alias("b")) for m in metrics for b in benchmarks)))
    return correlations(aligned.withColumn("scope", scope).select("scope", pairs.alias("p")).select("scope", "p.*"), ["scope", "metric", "benchmark"])


def standardised(series: DataFrame, columns: list[str], first: str, last: str, key: str = "quarter") -> DataFrame:
    """Distances to a window's mean in its standard deviations; without spread only centred."""
    inside = F.col(key).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    stats = series.agg(*(x for c in columns for x in (F.avg(F.when(inside, F.col(c))).alias(f"_m_{c}"), F.stddev_samp(F.when(inside, F.col(c))).alias(f"_s_{c}"))))
    out = series.join(stats).withColumns({c: (F.col(c) - F.col(f"_m_{c}")) / F.coalesce(F.nullif(F.col(f"_s_{c}"), F.lit(0.0)), F.lit(1.0)) for c in columns})
    return out.drop(*(f"_{x}_{c}" for c in columns for x in "ms"))


def annualised(x: Column, periods: int) -> Column:
    return 1 - F.pow(1 - x, F.lit(float(periods)))

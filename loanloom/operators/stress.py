"""The stress composite: rolling scores of pooled metrics, weighted and combined."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import double
from . import metrics, universe

#: Scored metrics and their orientation: up is worse.
SIGNS = {"delq30plus": 1, "delq60plus": 1, "roll_c_to_30": 1, "net_loss_annl": 1, "recovery_rate": -1}
WINDOW, LEAST, CLAMP = 24, 12, 3.0


def rolling_z(series: DataFrame, columns: list[str], by: list[str], *, window: int = WINDOW, least: int = LEAST, clamp: float = CLAMP, signs: dict[str, int] | None = None) -> DataFrame:
    """Adds ``z_<column>``: distance to the mean of the last ``window`` rows, this one included, in sample standard
    deviations; null below ``least`` values or without spread."""
    w = Window.partitionBy(*by).orderBy("month").rowsBetween(1 - window, 0)
    out = {}
    for c in columns:
        sd = F.when(F.count(c).over(w) >= least, F.nullif(F.stddev_samp(c).over(w), F.lit(0.0)))
        z = (F.col(c) - F.avg(c).over(w)) / sd
        out[f"z_{c}"] = F.when(z.isNotNull(), F.greatest(F.least(z, F.lit(clamp)), F.lit(-clamp))) * (signs or {}).get(c, 1)
    return series.withColumns(out)


def inverse_volatility(scored: DataFrame, columns: list[str], by: list[str], expanding: bool = False) -> DataFrame:
    """Adds ``stress_index_zavg``: scores weighted by 1 over their standard deviation. Weights come from the whole
    series, or with ``expanding`` from the rows so far. A missing score counts 0; all missing give null."""
    w = Window.partitionBy(*by)
    if expanding:
        w = w.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    raw = {c: 1 / F.nullif(F.stddev_samp(c).over(w), F.lit(0.0)) for c in columns}
    out = scored.withColumns({f"_w_{c}": F.coalesce(x, F.lit(0.0)) for c, x in raw.items()})
    whole = sum((F.col(f"_w_{c}") for c in columns), F.lit(0.0))
    mean = sum((F.coalesce(F.col(c), F.lit(0.0)) * F.col(f"_w_{c}") for c in columns), F.lit(0.0)) / F.nullif(whole, F.lit(0.0))
    some = F.coalesce(*columns).isNotNull()
    return out.withColumn("stress_index_zavg", F.when(some, mean)).drop(*(f"_w_{c}" for c in columns))


def equal_weight(scored: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``stress_index_zavg``: mean of the scores there are."""
    n = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    s = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in columns), F.lit(0.0))
    return scored.withColumn("stress_index_zavg", s / F.nullif(n.cast("double"), F.lit(0.0)))


def principal_component(scored: DataFrame, columns: list[str], by: list[str], least: int = LEAST) -> DataFrame:
    """(by, loadings, explained, means): first component of the complete rows, signed like their mean score."""
    whole = scored.filter(" and ".join(f"{c} is not null" for c in columns))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    sums = whole.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.array(*(F.covar_samp(a, b) for a, b in pairs)).alias("cov"), F.array(*(F.avg(c) for c in columns)).alias("means"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            loads, shares = [], []
            for cov in pdf["cov"]:
                m = np.zeros((len(columns), len(columns)))
                for (a, b), v in zip(pairs, cov):
                    i, j = columns.index(a), columns.index(b)
                    m[i, j] = m[j, i] = v
                values, vectors = np.linalg.eigh(m)
                v = vectors[:, -1]
                v = v if (m @ v).sum() >= 0 else -v  # covariance with the row mean decides the sign
                loads.append(v.tolist())
                shares.append(float(values[-1] / max(values.sum(), 1e-300)))
            yield pdf[[*by]].assign(loadings=loads, explained=shares, means=pdf["means"])

    kinds = ", ".join(f"{c} {scored.schema[c].dataType.simpleString()}" for c in by)
    return sums.filter(F.col("n") >= least).mapInPandas(solve, f"{kinds}, loadings array<double>, explained double, means array<double>")


def with_component(scored: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Adds ``stress_index_pca``, brought to the spread of ``stress_index_zavg`` over common months."""
    found = principal_component(scored, columns, by)
    joined = scored.join(found, by, "left")
    raw = sum(((F.col(c) - F.col("means")[k]) * F.col("loadings")[k] for k, c in enumerate(columns)), F.lit(0.0))
    joined = joined.withColumn("_pc", raw)
    w = Window.partitionBy(*by)
    both = F.col("_pc").isNotNull() & F.col("stress_index_zavg").isNotNull()
    sd = lambda c: F.stddev_samp(F.when(both, F.col(c))).over(w)
    scale = F.coalesce(sd("stress_index_zavg") / F.nullif(sd("_pc"), F.lit(0.0)), F.lit(1.0))
    return joined.withColumn("stress_index_pca", F.col("_pc") * scale).drop("_pc", "loadings", "explained", "means")


def covid_flag(month, first: str = "2020-04-01", last: str = "2020-12-01"):
    return month.between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def build_stress_index(pooled: DataFrame, *, by: list[str] | None = None, inverse_vol_weight: bool = True, method: str = "zavg", weights: str = "full") -> DataFrame:
    """Scores, composites and the flag per month. ``by``: keys of independent series; ``method``: zavg or pca."""
    keys = by or ["series_key"]
    if not by:
        pooled = pooled.withColumn("series_key", F.lit("national"))
    names = [f"z_{c}" for c in SIGNS]
    out = rolling_z(pooled, list(SIGNS), keys, signs=SIGNS)
    out = inverse_volatility(out, names, keys, weights == "expanding") if inverse_vol_weight else equal_weight(out, names)
    if method == "pca":
        out = with_component(out, names, keys)
    out = out.withColumn("stress_index", F.col("stress_index_pca" if method == "pca" else "stress_index_zavg"))
    out = out.withColumn("covid_flag", covid_flag(F.col("month")))
    return out if by else out.drop("series_key")


def build_index(loans: DataFrame, *, fico_cutoff: float = universe.FICO_CUTOFF, min_pool_size: float = universe.MIN_POOL_SIZE, exit_fraction: float = universe.EXIT_FRACTION, inverse_vol_weight: bool = True, method: str = "zavg") -> DataFrame:
    """From loan months to index marks."""
    trusts = metrics.universe_metrics(loans, fico_cutoff=fico_cutoff, min_pool_size=min_pool_size, exit_fraction=exit_fraction)
    return build_stress_index(metrics.pool_metrics(trusts), inverse_vol_weight=inverse_vol_weight, method=method)


def longest_build(builds: DataFrame) -> DataFrame:
    """Of several builds of a deal (securitizationKey, build, month …), the rows of the one with most months."""
    sizes = builds.groupBy("securitizationKey", "build").agg(F.count_distinct("month").alias("_n"))
    w = Window.partitionBy("securitizationKey").orderBy(F.col("_n").desc(), "build")
    best = sizes.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("securitizationKey", "build")
    return builds.join(best, ["securitizationKey", "build"])


def pool_age(trusts: DataFrame, first_months: DataFrame) -> DataFrame:
    """Trust rows with ``age``: months since the trust's first."""
    rows = trusts.join(first_months.select("securitizationKey", "first_month"), "securitizationKey")
    return rows.withColumn("age", (F.year("month") * 12 + F.month("month")) - (F.year("first_month") * 12 + F.month("first_month"))).drop("first_month")


def mean_pool_age(aged: DataFrame) -> DataFrame:
    """(month, pool_age, n_trusts): balance-weighted."""
    weight = double("pool_end_balance")
    return aged.groupBy("month").agg((F.sum(F.col("age") * weight) / F.nullif(F.sum(weight), F.lit(0.0))).alias("pool_age"), F.count(F.lit(1)).alias("n_trusts"))


def cohort_index(aged: DataFrame, youngest: int = 6, oldest: int = 30) -> DataFrame:
    """The index over trusts of a fixed seasoning only."""
    return build_stress_index(metrics.pool_metrics(aged.filter(F.col("age").between(youngest, oldest))))


def cohort_diagnostics(index: DataFrame, ages: DataFrame, since: str, least_trusts: int = 3) -> DataFrame:
    """One row: months covered, months with enough trusts, spread of the pool age, mean net loss since a date."""
    return index.join(ages.select("month", "pool_age"), "month", "left").agg(
        F.count(F.lit(1)).alias("months"),
        F.count_if(F.col("n_trusts") >= least_trusts).alias("months_enough"),
        F.stddev_samp("pool_age").alias("pool_age_std"),
        F.avg(F.when(F.col("month") >= F.lit(since).cast("date"), F.col("net_loss_annl"))).alias("net_loss_since"),
    )

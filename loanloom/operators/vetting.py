"""Integrity counters and profiles of tapes, one row per trust."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import double
from ..functions.scratch import stored
from ..sources.schemas import FIELDS
from .quantiles import quantiles

KEY, ASSET, BEGIN, END = "securitizationKey", "assetNumber", "reportingPeriodBeginningDate", "reportingPeriodEndingDate"
B, E = "reportingPeriodBeginningLoanBalanceAmount", "reportingPeriodActualEndBalanceAmount"
CO, REC, REPO, PRIN, OTHER = "chargedoffPrincipalAmount", "recoveredAmount", "repossessedProceedsAmount", "actualPrincipalCollectedAmount", "otherPrincipalAdjustmentAmount"
CASH = [B, PRIN, CO, OTHER, E, "actualInterestCollectedAmount", REC, REPO]

#: Trust months that are broadcast at most: some tens of megabytes.
LISTED = 500_000


def _cells(df: DataFrame, fields: list[str], test) -> Column:
    """How many cells of the fields pass the test."""
    found = [F.count_if(test(double(c))) for c in fields if c in df.columns]
    return reduce(lambda a, b: a + b, found) if found else F.lit(0).cast("bigint")


def _counters(df: DataFrame, kind: str, sens: float, assets: Column) -> list[Column]:
    """Counters that need no other row of the loan."""
    has = lambda c: c in df.columns
    count = lambda name, test: F.count_if(test).alias(name) if test is not None else F.lit(0).cast("bigint").alias(name)
    co, b = double(CO), double(B)
    off = F.abs((b - double(E)) - (double(PRIN) + co + (double(OTHER) if has(OTHER) else F.lit(0.0)))) > sens
    return [
        assets.alias("Count"), F.min(BEGIN).alias("StartMonth"), F.max(BEGIN).alias("EndMonth"), count("Pmts", off),
        count("NegOpenBal", b < 0), count("NegCloseBal", double(E) < 0),
        _cells(df, FIELDS[kind]["rate"], lambda x: x < 0).alias("RateNeg"), _cells(df, FIELDS[kind]["rate"], lambda x: x > 1).alias("RatePos"),
        _cells(df, FIELDS[kind]["integer"], lambda x: F.pmod(x, F.lit(1.0)) != 0).alias("Integer"),
        count("NegCO", co < 0), count("PartialCO", (co < b) & (F.abs(co) > sens)), count("GreaterCO", (co > b) & (F.abs(co) > sens)),
        count("NegRepo", double(REPO) < 0 if has(REPO) else None), count("NegRecov", double(REC) < 0 if has(REC) else None),
    ]


def row_counters(df: DataFrame, kind: str = "loan", sens: float = 0.001) -> DataFrame:
    """Counters that need no other row, in one pass."""
    return df.groupBy(KEY).agg(*_counters(df, kind, sens, F.count_distinct(ASSET)))


def opening_balance(df: DataFrame) -> DataFrame:
    first = df.groupBy(KEY).agg(F.min(BEGIN).alias("_first"))
    return df.join(F.broadcast(first), KEY).filter(F.col(BEGIN) == F.col("_first")).groupBy(KEY).agg(F.sum(B).alias("OpenBal"))


def walks(df: DataFrame) -> DataFrame:
    """``Walk``: begin balance differs from the end of the asset's row before; ``IncrBal``: it grew since then."""
    w = Window.partitionBy(KEY, ASSET).orderBy(BEGIN)
    rows = df.select(KEY, F.col(B).alias("b"), F.lag(E).over(w).alias("e0"), F.lag(B).over(w).alias("b0"), F.row_number().over(w).alias("n"))
    return rows.groupBy(KEY).agg(F.count_if((F.col("n") > 1) & ~F.coalesce(F.col("b") == F.col("e0"), F.lit(False))).alias("Walk"), F.count_if(F.col("b0") < F.col("b")).alias("IncrBal"))


def missing_months(df: DataFrame) -> DataFrame:
    """Calendar month ends between a trust's first and last that no row has; trusts that lack none have no row."""
    ends = df.select(KEY, F.last_day(END).alias("m")).distinct()
    number = lambda c: F.year(c) * 12 + F.month(c)
    span = number(F.max("m")) - number(F.min("m")) + 1
    return ends.groupBy(KEY).agg((span - F.count("m")).cast("bigint").alias("MissingMonths")).filter("MissingMonths > 0")


def appearances(df: DataFrame, sens: float = 0.001) -> DataFrame:
    """``Missing``: assets with a balance that the trust's next observed month lacks; ``Extra``: assets in it that had none.

    Loan months see their neighbours in windows by (trust, asset), where their rows are; only the short list of trust months
    is broadcast. Rows without an asset number match no others."""
    here = df.groupBy(KEY, ASSET, BEGIN).agg(F.max(F.coalesce(F.abs(double(E)) > sens, F.lit(False))).alias("_open"))
    order, known = Window.partitionBy(KEY, ASSET).orderBy(BEGIN), F.col(ASSET).isNotNull()
    rows = here.join(_listed(df), [KEY, BEGIN]).withColumns({"_m0": F.lag(BEGIN).over(order), "_m1": F.lead(BEGIN).over(order), "_was_open": F.lag("_open").over(order)})
    stays = F.coalesce(known & (F.col("_m1") == F.col("_after")), F.lit(False))
    due = F.coalesce(known & (F.col("_m0") == F.col("_before")) & F.col("_was_open"), F.lit(False))
    some = lambda test: F.nullif(F.count_if(test), F.lit(0).cast("bigint"))
    out = rows.groupBy(KEY).agg(some(F.col("_open") & F.col("_after").isNotNull() & ~stays).alias("Missing"), some(F.col("_before").isNotNull() & ~due).alias("Extra"))
    return out.filter("Missing is not null or Extra is not null")


def after_charge_off(df: DataFrame, sens: float = 0.001) -> DataFrame:
    """``COExtra``: rows later than the asset's first charge-off."""
    first = df.filter(double(CO) > sens).groupBy(KEY, ASSET).agg(F.min(BEGIN).alias("_first"))
    return df.join(first, [KEY, ASSET]).filter(F.col(BEGIN) > F.col("_first")).groupBy(KEY).agg(F.count(F.lit(1)).alias("COExtra"))


def duplicates(df: DataFrame) -> DataFrame:
    groups = df.groupBy(KEY, ASSET, BEGIN).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return groups.groupBy(KEY).agg(F.sum("n").alias("Dupes"))


def months(df: DataFrame) -> DataFrame:
    """Per trust and observed month, that before it, that after it, and the trust's first: a row for each month, however
    many loans."""
    w = Window.partitionBy(KEY).orderBy(BEGIN)
    seen = df.filter(F.col(BEGIN).isNotNull()).select(KEY, BEGIN).distinct()
    return seen.select(KEY, BEGIN, F.lag(BEGIN).over(w).alias("_before"), F.lead(BEGIN).over(w).alias("_after"), F.min(BEGIN).over(Window.partitionBy(KEY)).alias("_first"))


def _listed(df: DataFrame) -> DataFrame:
    """``months``, to be broadcast if they are few."""
    listed = stored(months(df))
    return F.broadcast(listed) if listed.count() <= LISTED else listed  # a size that has been counted


def vet(df: DataFrame, kind: str = "loan", sens: float = 0.001) -> DataFrame:
    """All counters, one row per trust.

    Beside the short lists of a trust's months, one pass: rows sorted by month within (trust, asset) see their
    neighbours, the months before and after of their trust, and the loan's first charge-off. Row counters are taken along,
    and all is summed by trust at once. Rows without an asset number count as one loan of their trust."""
    listed = _listed(df)
    loan = Window.partitionBy(KEY, ASSET)
    order, same = loan.orderBy(BEGIN), Window.partitionBy(KEY, ASSET, BEGIN)
    rows = df.join(listed, [KEY, BEGIN], "left").withColumns({
        "_n": F.row_number().over(order),
        "_e0": F.lag(E).over(order), "_b0": F.lag(B).over(order), "_m0": F.lag(BEGIN).over(order), "_m1": F.lead(BEGIN).over(order),
        "_open": F.max(F.coalesce(F.abs(double(E)) > sens, F.lit(False))).over(same), "_copies": F.count(F.lit(1)).over(same),
        "_off": F.min(F.when(double(CO) > sens, F.col(BEGIN))).over(loan),
    }).withColumn("_was_open", F.lag("_open").over(order))
    first = (F.col("_n") == 1) | ~F.col("_m0").eqNullSafe(F.col(BEGIN))  # of the rows of a loan month
    last = ~F.coalesce(F.col("_m1") == F.col(BEGIN), F.lit(False))
    due = F.coalesce((F.col("_m0") == F.col("_before")) & F.col("_was_open"), F.lit(False))
    out = rows.groupBy(KEY).agg(
        *_counters(df, kind, sens, F.count_if((F.col("_n") == 1) & F.col(ASSET).isNotNull())),
        F.sum(F.when(F.col(BEGIN) == F.col("_first"), F.col(B))).alias("OpenBal"),
        F.count_if((F.col("_n") > 1) & ~F.coalesce(F.col(B) == F.col("_e0"), F.lit(False))).alias("Walk"),
        F.count_if(F.col("_b0") < F.col(B)).alias("IncrBal"),
        F.count_if(last & F.col("_open") & F.col("_after").isNotNull() & ~F.coalesce(F.col("_m1") == F.col("_after"), F.lit(False))).alias("Missing"),
        F.count_if(first & F.col("_before").isNotNull() & ~due).alias("Extra"),
        F.count_if(F.col(BEGIN) > F.col("_off")).alias("COExtra"),
        F.count_if(F.col("_copies") > 1).alias("Dupes"),
    )
    return out.join(missing_months(df), KEY, "left").fillna(0, ["MissingMonths"])


def cashflow(df: DataFrame) -> DataFrame:
    """Sums of the cash columns by trust and month, and by trust (null month)."""
    have = [c for c in CASH if c in df.columns]
    rows = df.rollup(KEY, BEGIN).agg(F.grouping_id().alias("_g"), *(F.sum(c).alias(c) for c in have))
    return rows.filter("_g < 3").drop("_g")


def long_report(counters: DataFrame) -> DataFrame:
    """(securitizationKey, counter, value)."""
    names = [c for c, t in counters.dtypes if c != KEY and t in ("bigint", "int", "double")]
    return counters.select(KEY, *(double(c).alias(c) for c in names)).unpivot(KEY, names, "counter", "value")


def numeric_profile(df: DataFrame, fields: list[str]) -> DataFrame:
    """Per trust and field: count, moments, quartiles, nulls, zeros, above 1, below 0 and not whole. Quartiles are exact."""
    x = F.col("x")
    moments = df.select(KEY, *(double(c).alias(c) for c in fields)).unpivot(KEY, fields, "field", "x").groupBy(KEY, "field").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"),
        F.max("x").alias("max"), F.count_if(x.isNull()).alias("nans"),
        F.count_if(x == 0).alias("zeros"), F.count_if(x > 1).alias("above_one"), F.count_if(x < 0).alias("negative"), F.count_if(F.pmod(x, F.lit(1.0)) != 0).alias("non_int"),
    )
    at = quantiles(df, [KEY], fields, [0.25, 0.5, 0.75])
    quartiles = at.groupBy(KEY, "field").agg(F.array_sort(F.collect_list(F.struct("share", "value")))["value"].alias("quartiles"))
    return moments.join(quartiles, [KEY, "field"], "left")


def text_profile(df: DataFrame, fields: list[str]) -> DataFrame:
    """Per trust and field: count, distinct values, the most frequent (ties: the greatest) and its count, nulls."""
    values = df.select(KEY, *(F.col(c).cast("string").alias(c) for c in fields)).unpivot(KEY, fields, "field", "v").groupBy(KEY, "field", "v").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("v").isNotNull()
    return values.groupBy(KEY, "field").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("count"), F.count("v").alias("unique"),
        F.max_by("v", F.when(known, F.struct("n", "v"))).alias("top"), F.max(F.when(known, F.col("n"))).alias("freq"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("nans"),
    )


def distinct_values(df: DataFrame, fields: list[str]) -> DataFrame:
    """Per trust and field: sorted distinct values and nulls. For coded fields, whose values are few."""
    long = df.select(KEY, *(F.col(c).cast("string").alias(c) for c in fields)).unpivot(KEY, fields, "field", "v")
    return long.groupBy(KEY, "field").agg(F.array_sort(F.collect_set("v")).alias("values"), F.count_if(F.col("v").isNull()).alias("nans"))


def parity(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(column, different, max_abs) of two frames matched on keys; nulls equal each other."""
    names = [c for c in a.columns if c not in keys and c in b.columns]
    x, y = a.select(*keys, *(F.col(c).alias(f"a_{c}") for c in names), F.lit(1).alias("_a")), b.select(*keys, *(F.col(c).alias(f"b_{c}") for c in names), F.lit(1).alias("_b"))
    both = x.join(y, keys, "full")
    here = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    numeric = {c for c, t in a.dtypes if t in ("int", "bigint", "double", "float", "smallint") or t.startswith("decimal")}
    size = lambda c: F.max(F.abs(double(f"a_{c}") - double(f"b_{c}"))) if c in numeric else F.lit(None).cast("double")
    rows = both.agg(*(F.struct(F.count_if(~(here & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")))).alias("different"), size(c).alias("max_abs")).alias(c) for c in names))
    return rows.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c)["different"].alias("different"), F.col(c)["max_abs"].alias("max_abs")) for c in names)))).select("col.*")

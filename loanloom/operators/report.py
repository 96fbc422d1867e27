"""Summary, comparison and performance reports in long form."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import double, present_value, ratio, wavg

KEY, ASSET = "securitizationKey", "assetNumber"
B, E = "reportingPeriodBeginningLoanBalanceAmount", "reportingPeriodActualEndBalanceAmount"
# States, labels and codes that the report shows.
STATES = ["CA", "TX", "FL", "OH", "NJ"]
BINS = 7
#: Numeric fields cut into equal bins, and coded fields taken as they are.
STRATIFIED = {"Term": "originalLoanTerm", "Size": "originalLoanAmount", "APR": "nextInterestRatePercentage", "Age": "age", "FICO": "consumerCreditScore", "CommScore": "commercialCreditScore", "LTV": "loanToValueRatio", "PTI": "paymentToIncomePercentage"}
LABELS = {"VehType": ("vehicleTypeCode", {1: "Car", 2: "Truck", 3: "SUV"}), "VehCond": ("vehicleNewUsedCode", {1: "New", 2: "Used"}), "VehYear": ("vehicleModelYear", {y: str(y) for y in range(2012, 2018)})}
UNIQUE = {"EmpVer": "obligorEmploymentVerificationCode", "IncVer": "obligorIncomeVerificationLevelCode", "VehManu": "vehicleManufacturerName"}


def measures(df: DataFrame) -> list[Column]:
    """The summary's aggregates over whatever columns there are. Last-month rows are those with summaryDate 1."""
    has = lambda *c: all(x in df.columns for x in c)
    last, first = F.col("summaryDate") == 1, F.col("monthsFromCutoffDate") == 0
    at = lambda c: F.when(last, double(c))
    n = F.count_if(last).cast("double")
    share = lambda test: ratio(F.count_if(last & test), n)
    end, open_ = F.sum(at(E)), F.sum(F.when(first, double(B)))
    late = lambda test: ratio(F.sum(F.when(last & test, double(E)).when(last, 0.0)), end)
    weighted = lambda c, test=None: wavg(F.when(last if test is None else last & test, double(c)), F.when(last if test is None else last & test, double("originalLoanAmount")))
    md = F.col("monthsDelinquent")
    out = {
        "total_def": ratio(F.sum("chargedoffPrincipalAmount"), open_),
        "n_loans": F.count_if(last), "avg_balance": F.avg(at(E)), "avg_balance_share": ratio(F.avg(at(E)), F.avg(at("originalLoanAmount"))), "avg_size": F.avg(at("originalLoanAmount")),
        "delq": late(F.col("currentDelinquencyStatus") > 0), "delq_1m": late(md == 1), "delq_2m": late(md == 2), "delq_3m": late(md == 3), "delq_3m_plus": late(md == 4),
        "def": ratio(F.sum(at("chargedoffPrincipalAmount")), end), "wavg_term": weighted("originalLoanTerm"), "wavg_age": weighted("age"), "wavg_mfc": weighted("monthsFromCutoffDate") + 1,
    }
    if has("principalPrepaid"):
        out |= {"total_pp": ratio(F.sum("principalPrepaid"), open_), "pp": ratio(F.sum(at("principalPrepaid")), F.sum(at(B)))}
    for name, c in (("wavg_ltv", "loanToValueRatio"), ("wavg_pti", "paymentToIncomePercentage")):
        if has(c):
            out[name] = weighted(c)
    for name, c in (("cons", "consumerCreditScore"), ("comm", "commercialCreditScore")):
        if has(c):
            some = F.coalesce(F.col(c) > 0, F.lit(False))
            out |= {f"wavg_{name}_score": weighted(c, some), name: share(some)}
    coded = {"new": ("vehicleNewUsedCode", 1), "used": ("vehicleNewUsedCode", 2), "car": ("vehicleTypeCode", 1), "truck": ("vehicleTypeCode", 2), "suv": ("vehicleTypeCode", 3), "y2015": ("vehicleModelYear", 2015), "y2016": ("vehicleModelYear", 2016), "y2017": ("vehicleModelYear", 2017)}
    out |= {k: share(F.col(c) == v) for k, (c, v) in coded.items() if has(c)}
    if has("vehicleModelYear"):
        out |= {f"before_{y}": share(F.col("vehicleModelYear") < y) for y in (2010, 2015)}
    out |= {s.lower(): share(F.col("obligorGeographicLocation") == s) for s in STATES} if has("obligorGeographicLocation") else {}
    out |= {k: share(F.col(c) >= 3) for k, c in (("inc_ver", UNIQUE["IncVer"]), ("emp_ver", UNIQUE["EmpVer"])) if has(c)}
    if has("baseResidualValue"):
        # the annual rate with monthly periods, as the report has always shown it
        pv = present_value(F.col("securitizationDiscountRate"), F.col("remainingTermToMaturityNumber"), F.lit(0.0), -double("baseResidualValue"), 1)
        gain = F.abs(double("saleGainOrLoss")) > 0
        out |= {
            "total_turn_in": ratio(F.count_if(F.col("terminationIndicator").isin(2, 4)), F.count_distinct(ASSET)), "wavg_apr": weighted("securitizationDiscountRate"),
            "base_residual_share": ratio(F.sum(at("baseResidualValue")), F.sum(at("vehicleValueAmount"))), "discounted_residual_share": ratio(F.sum(F.when(last, pv)), F.sum(at(B))),
            "total_sale_gain": ratio(F.sum(F.when(gain, double("saleGainOrLoss"))), F.sum(F.when(gain, double("contractResidualValue")))),
        }
    else:
        out["wavg_apr"] = weighted("originalInterestRatePercentage")
    return [c.alias(k) for k, c in out.items()]


def summary_row(df: DataFrame) -> DataFrame:
    return df.agg(*measures(df))


def comparison(df: DataFrame) -> DataFrame:
    """One row per trust, and one for all (null key)."""
    return df.filter(F.col(KEY).isNotNull()).rollup(KEY).agg(*measures(df))


def bins(df: DataFrame, field: str, number: int = BINS) -> DataFrame:
    """Adds ``bin`` (0 …): equal widths between least and greatest; the greatest value itself is in none."""
    span = df.agg(F.min(double(field)).alias("_lo"), F.max(double(field)).alias("_hi"))
    x = double(field)
    k = F.floor((x - F.col("_lo")) / F.nullif((F.col("_hi") - F.col("_lo")) / number, F.lit(0.0)))
    return df.join(span).withColumn("bin", F.when(x < F.col("_hi"), F.least(k, F.lit(number - 1))).cast("int")).drop("_lo", "_hi")


def _matters(df: DataFrame) -> Column:
    """Whether a row can change a measure: last-month rows, first-month rows and rows with an amount that is summed over all
    months. Amounts that are null count as 0, as cleaning leaves them. Of leases every row matters."""
    if "baseResidualValue" in df.columns:
        return F.lit(True)
    summed = [c for c in ("chargedoffPrincipalAmount", "principalPrepaid") if c in df.columns]
    tests = [F.col("summaryDate") == 1, F.col("monthsFromCutoffDate") == 0, *(double(c) != 0 for c in summed)]
    return F.coalesce(reduce(lambda x, y: x | y, [F.coalesce(t, F.lit(False)) for t in tests]), F.lit(False))


def strata(df: DataFrame, span: DataFrame) -> tuple[DataFrame, list[tuple[str, Column]]]:
    """The rows beside the ranges of numeric fields, and each dimension's label of a row."""
    out = []
    for d, f in ((d, f) for d, f in STRATIFIED.items() if f in df.columns):
        x, lo, hi = double(f), F.col(f"lo_{d}"), F.col(f"hi_{d}")
        k = F.least(F.floor((x - lo) / F.nullif((hi - lo) / BINS, F.lit(0.0))), F.lit(BINS - 1))
        out.append((d, F.when(x < hi, F.concat(F.lit("bin "), k.cast("string")))))
    for d, (f, names) in LABELS.items():
        if f in df.columns:
            label = F.lit(None).cast("string")
            for code, name in names.items():
                label = F.when(F.col(f) == code, F.lit(name)).otherwise(label)
            out.append((d, label))
    out += [(d, F.col(f).cast("string")) for d, f in UNIQUE.items() if f in df.columns]
    return df.join(span), out


def summary(df: DataFrame) -> DataFrame:
    """All strata (dimension, stratum) with the measures; an overall row for each dimension.

    Three reads of few columns or rows: the ranges of numeric fields; the strata there are, which needs no measure; and the
    measures, of rows that matter only, a small part of a tape. The overall row is summed once."""
    fields = {d: f for d, f in STRATIFIED.items() if f in df.columns}
    span = df.agg(*(x for d, f in fields.items() for x in (F.min(double(f)).alias(f"lo_{d}"), F.max(double(f)).alias(f"hi_{d}"))))
    rows, labels = strata(df, span)
    pair = lambda d, x: F.struct(d.alias("dimension"), x.alias("stratum"))
    titled = lambda d: lambda x: pair(F.lit(d), x)
    seen = rows.agg(*(F.collect_set(x).alias(d) for d, x in labels), F.count(F.lit(1)).alias("_n")).filter("_n > 0")
    names = F.flatten(F.array(*(F.transform(F.array_append(F.col(d), F.lit("Overall")), titled(d)) for d, _ in labels)))
    listed = seen.select(F.explode(names).alias("_s")).select("_s.*")
    pairs = [pair(F.lit(d), x) for d, x in labels] + [pair(F.lit(None).cast("string"), F.lit("Overall"))]
    some = rows.filter(_matters(df)).withColumn("_s", F.explode(F.array(*pairs))).filter("_s.stratum is not null")
    made = some.groupBy(F.col("_s.dimension").alias("dimension"), F.col("_s.stratum").alias("stratum")).agg(*measures(df))
    each = made.withColumn("dimension", F.explode(F.when(F.col("dimension").isNull(), F.array(*(F.lit(d) for d, _ in labels))).otherwise(F.array("dimension"))))
    return listed.join(each, ["dimension", "stratum"], "left").fillna(0, ["n_loans"])


def _by(df: DataFrame) -> DataFrame:
    """Rows of names with Trust in them under their name, and all rows once more under null, for all trusts."""
    own = F.when(F.col(KEY).contains("Trust"), F.array(F.col(KEY), F.lit(None).cast("string"))).otherwise(F.array(F.lit(None).cast("string")))
    return df.withColumn("_k", F.explode(own)).drop(KEY).withColumnRenamed("_k", KEY)


def _base(rows: DataFrame, axis: str) -> DataFrame:
    """Per trust: the mean age at the cutoff, by balance, and what losses are held against, the cutoff balance on the
    axis of months from the cutoff and the original amount on any other."""
    held = "beginningBalanceAtCutoffDate" if axis == "monthsFromCutoffDate" else "originalLoanAmount"
    age = wavg("ageFromCutoff", "beginningBalanceAtCutoffDate")
    return rows.groupBy(KEY).agg(age.alias("_age"), F.sum(F.when(F.col("monthsFromCutoffDate") == 0, double(held))).alias("_open")).withColumnRenamed(KEY, "_k2")


def performance(df: DataFrame, axis: str = "monthsFromCutoffDate") -> DataFrame:
    """Per trust (null: all) and axis value: ABS speed, prepay rate, delinquency shares, cumulative net loss."""
    rows = _by(df)
    known = F.col("monthsDelinquent").isNotNull()
    late = lambda k: ratio(F.sum(F.when(F.col("monthsDelinquent") == k, double(E)).otherwise(0.0)), F.sum(F.when(known, double(E))))
    other = double("otherPrincipalAdjustmentAmount") if "otherPrincipalAdjustmentAmount" in df.columns else F.lit(0.0)
    paid = double("actualPrincipalCollectedAmount") + other + double("chargedoffPrincipalAmount")
    smm = ratio(F.sum(paid) - F.sum(double("scheduledPrincipalAmount")), F.sum(double(B)) - F.sum(double("scheduledPrincipalAmount")))
    out = rows.filter(F.col(axis).isNotNull()).groupBy(KEY, axis).agg(
        smm.alias("smm"), late(1).alias("delq30"), late(2).alias("delq60"), late(3).alias("delq90"), late(5).alias("def"),
        (ratio(F.sum("principalPrepaid"), F.sum(B)) if "principalPrepaid" in df.columns else F.lit(None).cast("double")).alias("prepay"), F.sum(double("netLosses")).alias("_loss"),
    )
    w = Window.partitionBy(KEY).orderBy(axis)  # few rows: trusts by months
    out = out.join(_base(rows, axis), F.col(KEY).eqNullSafe(F.col("_k2")))
    out = out.withColumn("abs_speed", F.col("smm") / F.nullif(1 - F.col("smm") * (F.col("_age") - 1), F.lit(0.0)))
    return out.withColumn("cnl", F.sum("_loss").over(w) / F.nullif(F.col("_open"), F.lit(0.0))).drop("_loss", "_open", "_k2", "smm", "_age")


def lease_speed(df: DataFrame, axis: str = "monthsFromCutoffDate") -> DataFrame:
    """ABS speed of leases: how much further the balance fell, against schedule, than it had by the period's begin."""
    rows = _by(df)
    part = lambda c, plan: ratio(F.sum(double(c)), F.sum(double(plan)))
    left = part(B, "scheduledSecuritizationBeginValueAmount") / F.nullif(part(E, "scheduledSecuritizationEndValueAmount"), F.lit(0.0))
    out = rows.filter(F.col(axis).isNotNull()).groupBy(KEY, axis).agg((1 - left).alias("_s")).join(_base(rows, axis), F.col(KEY).eqNullSafe(F.col("_k2")))
    return out.select(KEY, axis, (F.col("_s") / F.nullif(1 + F.col("_s") * F.col("_age"), F.lit(0.0))).alias("abs_speed"))


def curves(df: DataFrame, axis: str = "age") -> DataFrame:
    """Cumulative begin balance by tier, state and axis value, over the sum of the tier's original amounts, row by row.
    A tier begins at its own first axis value; later gaps carry the last value."""
    rows = df.filter(F.col("primeIndicator").isNotNull() & F.col("monthsDelinquent").isNotNull() & F.col(axis).isNotNull())
    sums = rows.groupBy("primeIndicator", "monthsDelinquent", axis).agg(F.sum(double(B)).alias("v"))
    groups = sums.select("primeIndicator", "monthsDelinquent").distinct()
    tiers = df.groupBy("primeIndicator").agg(F.sum(double("originalLoanAmount")).alias("_whole"))
    begun = rows.groupBy("primeIndicator").agg(F.min(axis).alias("_begun"))
    spine = groups.crossJoin(df.select(axis).dropna().distinct())  # tiers by states by months
    spine = spine.join(tiers, "primeIndicator").join(begun, "primeIndicator").filter(F.col(axis) >= F.col("_begun"))
    w = Window.partitionBy("primeIndicator", "monthsDelinquent").orderBy(axis)
    rows = spine.join(sums, ["primeIndicator", "monthsDelinquent", axis], "left").withColumn("share", F.sum(F.coalesce("v", F.lit(0.0))).over(w))
    return rows.select("primeIndicator", "monthsDelinquent", axis, (F.col("share") / F.nullif(F.col("_whole"), F.lit(0.0))).alias("share"))


def _rolls(df: DataFrame, starts: int, *by: str) -> DataFrame:
    """Shares of the end balance of a state, by ``by``, that moves to each state with the loan's next row. Rows of the
    trust's last month do not count; those of loans that end earlier count below the line only."""
    w = Window.partitionBy(KEY, ASSET).orderBy("reportingPeriodBeginningDate")
    rows = df.withColumn("to_state", F.lead("monthsDelinquent").over(w)).filter(F.col("summaryDate") == 0)
    state, to = F.col("monthsDelinquent").cast("int").alias("from_state"), F.col("to_state").cast("int").alias("to_state")
    sums = rows.groupBy(*by, state, to).agg(F.sum(double(E)).alias("w"))
    total = sums.groupBy(*by, "from_state").agg(F.sum("w").alias("_all"))
    spine = df.select(*by).dropna().distinct() if by else df.sparkSession.range(1).drop("id")
    for name, n in (("from_state", starts), ("to_state", 7)):
        spine = spine.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    out = spine.join(sums, [*by, "from_state", "to_state"], "left").join(total, [*by, "from_state"], "left")
    return out.select(*by, "from_state", "to_state", F.coalesce(F.col("w") / F.nullif(F.col("_all"), F.lit(0.0)), F.lit(0.0)).alias("share"))


def roll_matrix(df: DataFrame) -> DataFrame:
    """Balance-weighted shares of moves between the seven states, 0 where there is none."""
    return _rolls(df, 7)


def roll_series(df: DataFrame, axis: str = "reportingPeriodBeginningDate") -> DataFrame:
    """Shares of moves from states 0-4 to 0-6 by axis value, 0 where there is none; the last value is left out."""
    last = df.agg(F.max(axis).alias("_last"))
    return _rolls(df, 5, axis).join(last).filter(F.col(axis) < F.col("_last")).drop("_last")


def describe(df: DataFrame, fields: list[str]) -> DataFrame:
    """Per trust profile of non-numeric fields."""
    from .vetting import text_profile

    return text_profile(df, fields)

"""Position books on index marks: range join, profit, margin, hedges.

``positions``: position, side (1 long, -1 short), entry, exit, notional. ``marks``: month, level.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _w():
    """A position's rows by month."""
    return Window.partitionBy("position").orderBy("month")


def paths(positions: DataFrame, marks: DataFrame) -> DataFrame:
    """Marks within each position's months, with the first level ``p0``; needs two points and a positive start."""
    known = marks.filter("level is not null")
    rows = positions.join(known, F.col("month").between(F.col("entry"), F.col("exit")))
    rows = rows.withColumn("p0", F.first("level").over(_w())).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("position")))
    return rows.filter("_n >= 2 and p0 > 0").drop("_n")


def profits(path: DataFrame) -> DataFrame:
    """Adds ``mtm`` of each step and the running ``pnl``."""
    step = F.col("side") * F.col("notional") * (F.col("level") - F.lag("level").over(_w())) / F.col("p0")
    return path.withColumn("mtm", F.coalesce(step, F.lit(0.0))).withColumn("pnl", F.sum("mtm").over(_w()))


def risk(profit: DataFrame) -> DataFrame:
    """Per position: total, volatility of steps (population) and deepest fall of the running profit."""
    peak = profit.withColumn("_fall", F.col("pnl") - F.max("pnl").over(_w()))
    return peak.groupBy("position").agg(F.max_by("pnl", "month").alias("total"), F.stddev_pop("mtm").alias("volatility"), F.min("_fall").alias("drawdown"))


def margin_calls(profit: DataFrame, initial: float = 0.2, maintenance: float = 0.1) -> DataFrame:
    """Per position: calls and money topped up, when equity below maintenance is brought back to the initial margin.

    Each call depends on those before, so the steps of a position are folded in order."""
    steps = profit.groupBy("position").agg(F.transform(F.array_sort(F.collect_list(F.struct("month", "mtm"))), lambda s: s["mtm"]).alias("steps"), F.first("notional").alias("notional"))
    im, mm = F.col("notional") * initial, F.col("notional") * maintenance
    state = lambda e, t, c: F.struct(e.cast("double").alias("equity"), t.cast("double").alias("topped"), c.cast("int").alias("calls"))

    def fold(s, x):
        e = s["equity"] + x
        low = e < mm
        return state(F.when(low, im).otherwise(e), s["topped"] + F.when(low, im - e).otherwise(F.lit(0.0)), s["calls"] + low.cast("int"))

    end = F.aggregate("steps", state(im, F.lit(0.0), F.lit(0)), fold)
    return steps.select("position", end.alias("s")).select("position", "s.calls", "s.topped", "s.equity")


def liquidations(profit: DataFrame, collateral: float = 0.2, maintenance: float = 0.1) -> DataFrame:
    """Per position: first month whose equity is below maintenance, and the payout there or at the end, 0 at least."""
    equity = F.col("notional") * collateral + F.col("pnl")
    rows = profit.withColumn("_e", equity)
    first = rows.groupBy("position").agg(F.min(F.when(F.col("_e") < F.col("notional") * maintenance, F.col("month"))).alias("liquidated"), F.max("month").alias("_last"))
    at = rows.join(first, "position").filter(F.col("month") == F.coalesce("liquidated", "_last"))
    return at.select("position", "liquidated", F.greatest("_e", F.lit(0.0)).alias("payout"))


def hedge(path: DataFrame, losses: DataFrame, value: float, ratio: float) -> DataFrame:
    """Running pool loss on ``value`` (annual percent by month), the hedge's running result and the sum of both."""
    rows = path.join(losses, "month")
    loss = F.sum(-F.lit(value) * F.col("net_loss") / 12 / 100).over(_w())
    gain = F.lit(ratio) * F.lit(value) * (F.col("level") / F.col("p0") - 1)
    return rows.withColumn("pool_loss", loss).withColumn("hedge", gain).withColumn("net", F.col("pool_loss") + F.col("hedge"))

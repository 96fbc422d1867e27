"""Column helpers shared by the operators."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def double(c: str | Column) -> Column:
    return col(c).cast("double")


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b as double, null where b is 0."""
    return double(a) / F.nullif(double(b), F.lit(0.0))


def total(c: str | Column) -> Column:
    """Sum that is 0 where nothing is summed."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def month_start(c: str | Column) -> Column:
    return F.trunc(col(c), "MM")


def month_number(c: str | Column) -> Column:
    return F.year(col(c)) * 12 + F.month(col(c))


def wavg(value: str | Column, weight: str | Column) -> Column:
    """Weighted mean whose denominator keeps the weights of null values, as the summary report does."""
    return ratio(F.sum(double(value) * double(weight)), F.sum(double(weight)))


def wavg_known(value: str | Column, weight: str | Column) -> Column:
    """Weighted mean over rows that have a value."""
    v, w = double(value), double(weight)
    return ratio(F.sum(v * w), F.sum(F.when(v.isNotNull(), w)))


def untrue(c: Column) -> Column:
    """Not true: false or null, as a negated mask over missing values."""
    return ~F.coalesce(c, F.lit(False))


def level_pay_wal(term: Column, rate: Column) -> Column:
    """Weighted average life in months of a level-pay loan: closed form of the amortisation sum."""
    n, i = double(term), double(rate) / 12
    q = 1 + i
    pay = i / (1 - F.pow(q, -n))
    level = (pay - i) * (1 - (n + 1) * F.pow(q, n) + n * F.pow(q, n + 1)) / (i * i)
    return F.when(n <= 0, F.lit(0.0)).when(double(rate) <= 0, (n + 1) / 2).otherwise(level)


def present_value(rate: Column, periods: Column, payment: Column, future: Column, due: int = 0) -> Column:
    """Present value of payments and a final amount, by the usual sign rule; ``due`` 1: paid at the start of a period."""
    r, n = double(rate), double(periods)
    growth = F.pow(1 + r, n)
    some = -(double(future) + double(payment) * (1 + r * due) * (growth - 1) / r) / growth
    return F.when(r == 0, -(double(future) + double(payment) * n)).otherwise(some)

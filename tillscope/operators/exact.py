"""Sums, means and deviations of money that do not depend on the order of addition.

Amounts are taken as decimals with ``scale`` digits behind the point (half up beyond those; ``unlike`` counts the amounts
that this changes). Whole numbers of the smallest unit are added, each task first adds its own rows, and sums of parts add
up to the sum of the whole. So results are equal, unrounded, for any partitioning.

NULL, NaN and infinite amounts, and those beyond 18 digits, are left out. Sums are NULL where nothing is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions import week_number, year_number

_DIGITS = 18


def decimal(amount: str | Column, scale: int = 2) -> Column:
    """The amount as a decimal; NULL if it is no finite number or too long."""
    value = F.col(amount) if isinstance(amount, str) else amount
    return value.cast("double").try_cast(f"decimal({_DIGITS},{scale})")


def total(amount: str | Column, scale: int = 2) -> Column:
    """Aggregate: the exact sum. It holds 10 digits more than an amount, so 10**10 of the largest amounts."""
    return F.sum(decimal(amount, scale))


def unlike(amount: str, scale: int = 2) -> Column:
    """Aggregate: number of amounts that have more digits than ``scale``, or none at all, and are not summed as they are."""
    value = F.col(amount).cast("double")
    as_it_is = F.coalesce(decimal(amount, scale).cast("double") == value, F.lit(False))
    return F.count_if(value.isNotNull() & ~as_it_is)


def weekly(
    df: DataFrame,
    year_basis: str = "calendar",
    *,
    customer: str = "customer_id",
    date: str = "transaction_date",
    amount: str = "total_amount",
    scale: int = 2,
) -> DataFrame:
    """Spending per customer, year and week as exact decimals."""
    return df.groupBy(
        F.col(customer).alias("customer_id"), year_number(date, year_basis).alias("year"), week_number(date).alias("week")
    ).agg(total(amount, scale).alias("weekly_spending"))


def power_sums(df: DataFrame, by: list[str], amount: str = "total_amount", scale: int = 2) -> DataFrame:
    """``by``, n, s (sum), q (sum of squares) in units of the last digit, and left_out; parts can be stored and added.

    Amounts of 10**14 units or more are not in the sums; ``left_out`` counts them and the amounts that are not finite.
    """
    units = F.when(F.abs(_units(amount, scale)) < 10**14, _units(amount, scale))
    return df.groupBy(*by).agg(
        F.count(units).alias("n"),
        F.sum(units).cast("decimal(38,0)").alias("s"),
        F.sum((units * units).cast("decimal(28,0)")).alias("q"),
        F.count_if(F.col(amount).isNotNull() & units.isNull()).alias("left_out"),
    )


def added(sums: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Power sums of parts, added up per group."""
    return sums.groupBy(*(by or [])).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n", "left_out")],
        *[F.sum(c).cast("decimal(38,0)").alias(c) for c in "sq"],
    )


def moments(sums: DataFrame, by: list[str] | None = None, scale: int = 2) -> DataFrame:
    """``by``, n, mean and stddev (of a sample) of power sums.

    Squares are taken around the whole number next to the mean, so that no digits cancel.
    """
    big = lambda c: c.cast("decimal(38,0)")
    n, s, q = (big(F.col(c)) for c in "nsq")
    base = big(F.expr("s div nullif(n, 0)"))
    rest = big(s - big(base * n)).cast("double")
    around = big(q - big(base * big(2 * s - big(base * n)))).cast("double")
    count, unit = F.col("n").cast("double"), float(10**scale)
    spread = F.try_divide(around - F.try_divide(rest * rest, count), F.when(F.col("n") > 1, count - 1))
    mean = (base.cast("double") + F.try_divide(rest, count)) / unit
    return sums.select(*(by or []), F.col("n").cast("long").alias("n"), mean.alias("mean"), (F.sqrt(spread) / unit).alias("stddev"))


def _units(amount: str, scale: int) -> Column:
    return (decimal(amount, scale) * F.lit(10**scale)).cast("decimal(18,0)")

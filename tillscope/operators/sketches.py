"""Summaries that are stored per period and merged, so that new days are added without reading the old rows again.

Quantile sketches (KLL) hold a sample of the values in levels. A value taken from one for probability p has a rank within
``1 / accuracy`` of p, with a confidence of 99 %; smallest and largest value and the count are exact. Distinct sketches (HLL)
have a relative standard error of ``distinct_error()``. Sketches of parts merge to a sketch of the whole with the same bounds.

NULL and NaN amounts are left out and not counted; infinite ones count as the smallest or largest values. Groups without
any value, and empty tables, have ``n`` 0, a NULL sketch and NULL quantiles. NULL group keys form a group of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 1_000
DISTINCT_LOG_K = 12
# Published error bound of KLL sketches, and the largest k that Spark takes.
_KLL_FACTOR, _KLL_POWER, _KLL_LARGEST = 2.296, 0.9021, 65_535
_KLL_SMALLEST = 8
#: Sketches of tasks meet in this many groups before one task merges those.
FAN_IN = 256


def kll_size(accuracy: int) -> int:
    """The parameter k for which ranks are within ``1 / accuracy``; about 3 k numbers make a sketch."""
    if accuracy < 1:
        raise ValueError(f"accuracy must be at least 1, got {accuracy}")
    size = math.ceil((_KLL_FACTOR * accuracy) ** (1 / _KLL_POWER))
    if size > _KLL_LARGEST:
        largest = int(_KLL_LARGEST**_KLL_POWER / _KLL_FACTOR)
        raise ValueError(f"sketches reach an accuracy of {largest}; beyond that leave it out, quantiles are exact then")
    return max(size, _KLL_SMALLEST)


def distinct_error(log_k: int = DISTINCT_LOG_K) -> float:
    """Relative standard error of a merged distinct count."""
    return 1.04 / math.sqrt(1 << log_k)


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def amount_sketches(df: DataFrame, by: list[str], amount: str = "total_amount", accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """``by``, n and the sketch of the amounts of each group. Tasks combine their rows before the shuffle."""
    value = _number(amount)
    return df.groupBy(*by).agg(
        F.count(value).alias("n"), F.kll_sketch_agg_double(value, F.lit(kll_size(accuracy))).alias("sketch")
    ).withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def merged(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``by``, n and sketch of all sketches of each group; without ``by`` one row, also for an empty table.

    A group of very many sketches is merged in two steps, so that no task reads more than a share of them.
    """
    keys = by or []
    step = F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("_share")
    some = sketches.select(*keys, "n", "sketch", step).groupBy(*keys, "_share").agg(*_merge())
    whole = some.groupBy(*keys).agg(*_merge())
    return whole.withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def _merge() -> list[Column]:
    return [F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")]


def quantile(probability: float | Column, sketch: str = "sketch", n: str = "n") -> Column:
    """The value at a probability, NULL without values; 0 gives the smallest value, 1 the largest."""
    p = F.lit(float(probability)) if isinstance(probability, (int, float)) else probability
    return F.when(F.col(n) > 0, F.kll_sketch_get_quantile_double(sketch, p))


def quantiles(df: DataFrame, amount: str, probabilities: list[float], accuracy: int = DEFAULT_ACCURACY) -> dict[float, float | None]:
    """Values of all amounts at the probabilities, from one scan; None where there are no values. Runs a job."""
    probabilities = [float(p) for p in probabilities]
    shares = df.select(amount, F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("_share"))
    whole = merged(amount_sketches(shares, ["_share"], amount, accuracy))
    row = whole.select(*[quantile(p).alias(f"q{i}") for i, p in enumerate(probabilities)]).first()
    return dict(zip(probabilities, row))


def customer_periods(
    df: DataFrame,
    period: str | Column,
    *,
    customer: str = "customer_id",
    transaction: str = "transaction_id",
    product: str = "product_id",
    log_k: int = DISTINCT_LOG_K,
) -> DataFrame:
    """customer_id, period, orders and the sketch of distinct products: what is kept of each period."""
    return df.groupBy(
        F.col(customer).alias("customer_id"), (F.col(period) if isinstance(period, str) else period).alias("period")
    ).agg(F.count(transaction).alias("orders"), F.hll_sketch_agg(product, F.lit(log_k)).alias("products"))


def customer_totals(periods: DataFrame) -> DataFrame:
    """customer_id, total_orders and unique_products (estimated) over all stored periods.

    A period may occur in several rows, as when late rows were added; their sketches are merged like others.
    """
    return periods.groupBy("customer_id").agg(
        F.sum("orders").alias("total_orders"), F.hll_sketch_estimate(F.hll_union_agg("products")).alias("unique_products")
    )

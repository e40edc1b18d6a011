"""Descriptive statistics of numeric columns, one row per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions.lenient import complete
from tillscope.operators.quantiles import quantiles

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
TAILS = {"p1": 0.01, "p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Number of NULLs in each column, as one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def null_loss(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, complete rows (no NULL, NaN or infinite value), and rows lost by dropping the others, from one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("all_rows"),
        F.count_if(complete(df, columns or df.columns)).alias("complete_rows"),
    ).withColumn("dropped_rows", F.col("all_rows") - F.col("complete_rows"))


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum; numbers, not text."""
    return _moments(df, columns, ["count", "mean", "stddev", "min", "max"])


def summary_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """``describe_numeric`` with quartiles. Finding the quartiles runs jobs."""
    return _with_quantiles(describe_numeric(df, columns), df, columns, QUARTILES).select(
        "metric", "count", "mean", "stddev", "min", *QUARTILES, "max"
    )


def tail_percentiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum, maximum and percentiles towards both ends. Finding the percentiles runs jobs."""
    extremes = _moments(df, columns, ["min", "max"])
    return _with_quantiles(extremes, df, columns, TAILS).select(
        "metric", "min", *TAILS, "max"
    )


def _moments(df: DataFrame, columns: list[str], statistics: list[str]) -> DataFrame:
    # All columns in one aggregate; reshaping its single row is free.
    functions = {
        "count": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    wide = df.agg(*[functions[s](c).alias(f"{c}_{s}") for c in columns for s in statistics])
    rows = [
        F.struct(F.lit(c).alias("metric"), *[F.col(f"{c}_{s}").alias(s) for s in statistics])
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def _with_quantiles(
    moments: DataFrame,
    df: DataFrame,
    columns: list[str],
    named: dict[str, float],
) -> DataFrame:
    found = quantiles(df, columns, list(named.values()))

    def pick(p: float) -> Column:
        return F.coalesce(
            *[F.when(F.col("metric") == c, F.lit(found[c][p]).cast("double")) for c in columns]
        )

    return moments.withColumns({name: pick(p) for name, p in named.items()})

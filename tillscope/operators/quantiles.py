"""Exact quantiles at any input size, without collecting values in one task.

The value at probability p is the smallest one whose cumulative count reaches p times the count of
non-NULL values, as with ``percentile_disc``.

Intervals are narrowed: each pass counts values per bucket, combined before the shuffle, and brings one row per column
and probability to the driver. Inputs of every size take this way.

1. logarithmic buckets over the whole range of doubles (at most about 4.3 million);
2. equal-width buckets inside the bucket that holds the wanted rank (at most 4.2 million);
3. the same inside the bucket found by 2, by then narrow enough to give each double its own bucket.

A bucket with a single value ends the search, so amounts in cents take two passes and small counts one.
Passes after the first filter on constant ranges, which reach the file scan.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PER_DOUBLING = 1024
_OFFSET = 1100 * _PER_DOUBLING  # more than the largest magnitude of a logarithmic bucket number
_INFINITE = 4 * _OFFSET
_NAN = 5 * _OFFSET
_WITHIN = 2**22

Ranks = dict[str, dict[float, int]]
Found = dict[str, dict[float, float | None]]


def quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> Found:
    """Value of every column at every probability; None for a column without values.

    Runs jobs, like ``DataFrame.approxQuantile``. The input is read once per pass, at most three times: give a
    stored frame if it is costly to compute.
    """
    probabilities = [float(p) for p in probabilities]
    found: Found = {c: dict.fromkeys(probabilities) for c in columns}
    values = _long_form(df, columns)
    # First the probabilities are searched; what is left to find inside a bucket is a rank.
    searched = {_Interval(c): [(p, p, None) for p in probabilities] for c in columns}
    while searched:
        located = _locate(values, searched)
        searched = {}
        for row in located:
            if row.low < row.high:
                interval = _Interval(row.metric, row.low, row.high)
                searched.setdefault(interval, []).append((row.probability, None, row.rank))
            else:
                found[row.metric][row.probability] = row.low
    return found


@dataclass(frozen=True)
class _Interval:
    """Values of one column, all of them or those between two bounds."""

    metric: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value, same = F.col("value"), F.col("metric") == self.metric
        return same if self.low is None else same & (value >= self.low) & (value <= self.high)

    def bucket(self) -> Column:
        """Bucket number that never decreases as the value grows."""
        value = F.col("value")
        if self.low is not None:
            return F.floor((value - self.low) / F.lit(self.high - self.low) * _WITHIN)
        size = F.abs(value)
        number = (
            F.when(size == math.inf, F.lit(_INFINITE).cast("long"))
            .when(value == 0, F.lit(0).cast("long"))
            .otherwise(F.floor(F.log2(size) * _PER_DOUBLING) + _OFFSET)
        )
        return (
            F.when(F.isnan(value), F.lit(_NAN).cast("long"))
            .when(value < 0, -number)
            .otherwise(number)
        )


def _long_form(df: DataFrame, columns: list[str]) -> DataFrame:
    if len(columns) == 1:
        # Not unpivoted, so that range filters reach the scan.
        value = F.col(columns[0]).cast("double")
        long = df.select(F.lit(columns[0]).alias("metric"), value.alias("value"))
    else:
        long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
            [], columns, "metric", "value"
        )
    return long.filter(F.col("value").isNotNull())


def _locate(values: DataFrame, searched: dict[_Interval, list[tuple[float, float | None, int | None]]]) -> list:
    """For each wanted rank the bucket that holds it, and the rank left to find inside it."""
    # The intervals of a column are disjoint, so a row belongs to one of them at most.
    intervals = list(enumerate(searched))
    counts = (
        values.filter(reduce(or_, [x.holds() for _, x in intervals]))
        .groupBy(
            "metric",
            F.coalesce(*[F.when(x.holds(), F.lit(i)) for i, x in intervals]).alias("interval"),
            F.coalesce(*[F.when(x.holds(), x.bucket()) for _, x in intervals]).alias("bucket"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
    )
    # This window sees buckets, whose number is bounded, never values.
    running = (
        Window.partitionBy("metric", "interval")
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    whole = Window.partitionBy("metric", "interval")
    before = F.col("upto") - F.col("n")
    # Of a probability, the rank among all values of the column; NaN counts as the largest.
    rank = lambda w: F.coalesce(w["rank"], F.greatest(F.ceil(w["share"] * F.col("all")), F.lit(1)))
    wanted = F.coalesce(
        *[F.when(F.col("interval") == i, _wanted(searched[x])) for i, x in intervals]
    )
    return (
        counts.withColumn("upto", F.sum("n").over(running))
        .withColumn("all", F.sum("n").over(whole))
        .withColumn(
            "hit",
            F.explode(F.filter(wanted, lambda w: (rank(w) > before) & (rank(w) <= F.col("upto")))),
        )
        .select(
            "metric",
            F.col("hit.probability").alias("probability"),
            (rank(F.col("hit")) - before).alias("rank"),
            "low",
            "high",
        )
        .collect()
    )


def _wanted(searched: list[tuple[float, float | None, int | None]]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(p).alias("probability"),
                F.lit(share).cast("double").alias("share"),
                F.lit(rank).cast("long").alias("rank"),
            )
            for p, share, rank in searched
        ]
    )

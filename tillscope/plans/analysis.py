"""Analyses of processed transactions, each writing its result and returning it from there.

Reading the written result back keeps follow-up questions from recomputing it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillscope.operators import customers, profiling, segments, spending, trends
from tillscope.schema import METRICS
from tillscope.sinks import store


@dataclass(frozen=True)
class SpendingReport:
    weekly: DataFrame
    active_weeks: DataFrame
    histogram: DataFrame


@dataclass(frozen=True)
class SegmentReport:
    status: str
    customers: DataFrame
    nulls: DataFrame
    statistics: DataFrame
    scores: DataFrame
    centers: DataFrame
    profile: DataFrame | None
    tails: DataFrame | None


def analyze_weekly_spending(
    transactions: DataFrame,
    output: str,
    *,
    year_basis: str = "calendar",
    ordered: bool = False,
    fmt: str = "parquet",
) -> SpendingReport:
    """Weekly spending per customer, with the number of active weeks and its distribution."""
    weekly = store(
        spending.weekly(transactions, year_basis),
        output,
        fmt,
        order_by=["customer_id", "year", "week"] if ordered else None,
    )
    active = spending.active_weeks(weekly)
    return SpendingReport(weekly, active, spending.activity_histogram(active, ordered=True))


def analyze_segments(
    transactions: DataFrame,
    output: str,
    *,
    cluster_counts: tuple[int, ...] = segments.CLUSTER_COUNTS,
    seed: int = segments.SEED,
    fmt: str = "parquet",
) -> SegmentReport:
    """Customer segments, or the metrics alone (with their tails) where these cannot be clustered."""
    found = segments.segment(
        customers.customer_metrics(transactions), cluster_counts=cluster_counts, seed=seed
    )
    stored = store(found.customers, output, fmt)
    clustered = found.status != segments.METRICS_ONLY
    return SegmentReport(
        found.status,
        stored,
        profiling.null_profile(found.metrics),
        profiling.describe_numeric(found.metrics, METRICS),
        segments.score_table(found),
        segments.center_table(found),
        segments.cluster_profile(stored, detailed=True, ordered=True) if clustered else None,
        None if clustered else profiling.tail_percentiles(found.metrics, METRICS),
    )


def analyze_declining_customers(
    transactions: DataFrame, output: str, *, fmt: str = "parquet"
) -> DataFrame:
    """Customers whose orders fell in each of their last two active months."""
    return store(trends.saved(trends.declining(transactions)), output, fmt)

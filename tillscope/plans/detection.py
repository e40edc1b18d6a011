"""Unusual amounts: detect, store, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.operators import anomalies
from tillscope.sinks import store


@dataclass(frozen=True)
class AnomalyReport:
    method: str
    suspects: DataFrame
    count: DataFrame
    highest: DataFrame
    lowest: DataFrame | None


def detect_anomalies(
    transactions: DataFrame,
    output: str,
    method: str = "median",
    *,
    threshold: float | None = None,
    multiplier: float | None = None,
    fmt: str = "parquet",
) -> AnomalyReport:
    """Write the suspects of one method; count and extremes come from the written rows.

    An explicit multiplier is always respected; without one each method has its own default.
    """
    found = anomalies.detect(
        transactions, method, threshold=threshold, multiplier=multiplier
    )
    suspects = store(anomalies.export_columns(found), output, fmt)
    lowest = None
    if method == "zscore":
        highest = anomalies.top(suspects, 10, "zscore", extra=["zscore"])
    elif method == "iqr":
        highest = anomalies.top(anomalies.high_side(suspects), 5)
        lowest = anomalies.top(anomalies.low_side(suspects), 5, ascending=True)
    else:
        highest = anomalies.top(suspects, 10, extra=["threshold"])
    count = suspects.agg(F.count(F.lit(1)).alias("anomalies"))
    return AnomalyReport(method, suspects, count, highest, lowest)

"""Unusual transaction amounts by z-score, interquartile range, or multiple of the median.

Mean and deviation enter the plan as one-row scalar subqueries, with no join and no job of their own.
Quartiles take a few passes, so finding them runs jobs (see ``quantiles``); the bounds are then constants
that Spark pushes down to the file scan. With ``accuracy`` they come from sketches, in one scan, and their ranks are within
``1 / accuracy`` of those of the exact ones (see ``sketches``, also for what is left out).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions.lenient import is_finite
from tillscope.operators import sketches
from tillscope.operators.quantiles import quantiles
from tillscope.schema import COLUMNS

AMOUNT = "total_amount"
# Thresholds used when the caller gives none.
DEFAULTS = {"zscore": 3.0, "iqr": 1.5, "median": 5.0}
# Method columns and columns shown in reports.
METHOD_COLUMNS = ["zscore", "threshold", "lower_bound", "upper_bound"]
SHOWN = ["transaction_id", "transaction_date", "customer_id", "total_amount"]


def moments(df: DataFrame, amount: str = AMOUNT) -> DataFrame:
    """Mean and sample standard deviation of the finite amounts."""
    value = F.when(is_finite(amount), F.col(amount))
    return df.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("stddev"))


@dataclass(frozen=True)
class Quartiles:
    """Quartiles of an amount; all None when there are no amounts."""

    q1: float | None
    median: float | None
    q3: float | None

    @property
    def iqr(self) -> float | None:
        return None if self.q1 is None else self.q3 - self.q1

    def bounds(self, multiplier: float = DEFAULTS["iqr"]) -> tuple[Column, Column]:
        """Limits ``multiplier`` interquartile ranges below and above the quartiles."""
        if self.q1 is None:
            return _constant(None), _constant(None)
        reach = multiplier * self.iqr
        return _constant(self.q1 - reach), _constant(self.q3 + reach)

    def limit(self, multiplier: float = DEFAULTS["median"]) -> Column:
        return _constant(None if self.median is None else self.median * multiplier)


def quartiles(df: DataFrame, amount: str = AMOUNT, accuracy: int | None = None) -> Quartiles:
    return Quartiles(*_quantiles(df, amount, [0.25, 0.5, 0.75], accuracy).values())


def median(df: DataFrame, amount: str = AMOUNT, accuracy: int | None = None) -> Quartiles:
    """Like ``quartiles``, with the median only."""
    return Quartiles(None, _quantiles(df, amount, [0.5], accuracy)[0.5], None)


def _quantiles(df: DataFrame, amount: str, probabilities: list[float], accuracy: int | None) -> dict[float, float | None]:
    if accuracy is None:
        return quantiles(df, [amount], probabilities)[amount]
    return sketches.quantiles(df, amount, probabilities, accuracy)


def zscores(df: DataFrame, amount: str = AMOUNT) -> DataFrame:
    """Add ``zscore``; NULL when the spread is zero or unknown, and for amounts that are not finite."""
    return df.withColumn("zscore", _zscore(df, amount))


def by_zscore(
    df: DataFrame, threshold: float = DEFAULTS["zscore"], amount: str = AMOUNT
) -> DataFrame:
    """Rows further than ``threshold`` standard deviations from the mean, on either side."""
    return zscores(df, amount).filter(F.abs("zscore") > threshold)


def by_iqr(
    df: DataFrame,
    multiplier: float = DEFAULTS["iqr"],
    amount: str = AMOUNT,
    accuracy: int | None = None,
) -> DataFrame:
    """Rows strictly outside the quartile bounds."""
    lower, upper = quartiles(df, amount, accuracy).bounds(multiplier)
    outside = (F.col(amount) < lower) | (F.col(amount) > upper)
    return df.filter(outside).withColumns(
        {"is_anomaly": F.lit(True), "lower_bound": lower, "upper_bound": upper}
    )


def high_side(anomalies: DataFrame, amount: str = AMOUNT) -> DataFrame:
    return anomalies.filter(F.col(amount) > F.col("upper_bound"))


def low_side(anomalies: DataFrame, amount: str = AMOUNT) -> DataFrame:
    return anomalies.filter(F.col(amount) < F.col("lower_bound"))


def by_median(
    df: DataFrame,
    multiplier: float = DEFAULTS["median"],
    amount: str = AMOUNT,
    accuracy: int | None = None,
) -> DataFrame:
    """Rows above ``multiplier`` times the median."""
    threshold = median(df, amount, accuracy).limit(multiplier)
    return df.filter(F.col(amount) > threshold).withColumns(
        {"threshold": threshold, "is_anomaly": F.lit(True)}
    )


def detect(
    df: DataFrame,
    method: str = "median",
    *,
    threshold: float | None = None,
    multiplier: float | None = None,
    amount: str = AMOUNT,
    accuracy: int | None = None,
) -> DataFrame:
    """Anomalies by the named method, with that method's own default threshold; ``accuracy`` is for quantiles only."""
    if method == "zscore":
        return by_zscore(df, DEFAULTS["zscore"] if threshold is None else threshold, amount)
    if method not in DEFAULTS:
        raise ValueError(f"method must be one of {tuple(DEFAULTS)}, got {method!r}")
    factor = DEFAULTS[method] if multiplier is None else multiplier
    detector = by_iqr if method == "iqr" else by_median
    return detector(df, factor, amount, accuracy)


def counts(
    df: DataFrame,
    threshold: float = DEFAULTS["zscore"],
    iqr_multiplier: float = DEFAULTS["iqr"],
    median_multiplier: float = DEFAULTS["median"],
    amount: str = AMOUNT,
) -> DataFrame:
    """Anomalies found by each method, from one pass over the rows."""
    value = F.col(amount)
    found = quartiles(df, amount)
    lower, upper = found.bounds(iqr_multiplier)
    limit = found.limit(median_multiplier)
    counted = df.agg(
        F.count_if(F.abs(_zscore(df, amount)) > threshold).alias("zscore"),
        F.count_if((value < lower) | (value > upper)).alias("iqr"),
        F.count_if(value > limit).alias("median"),
    )
    return counted.unpivot([], ["zscore", "iqr", "median"], "method", "anomalies")


def top(
    anomalies: DataFrame,
    n: int,
    by: str = AMOUNT,
    *,
    ascending: bool = False,
    extra: list[str] | None = None,
    tiebreak: str = "transaction_id",
) -> DataFrame:
    """The ``n`` most extreme rows; each task keeps only its own ``n``. Z-scores sort by sign."""
    order = F.col(by).asc() if ascending else F.col(by).desc()
    return anomalies.orderBy(order, F.col(tiebreak).asc()).limit(n).select(*SHOWN, *(extra or []))


def export_columns(anomalies: DataFrame) -> DataFrame:
    """The transaction columns followed by whichever method columns are present."""
    extra = [c for c in anomalies.columns if c in METHOD_COLUMNS]
    return anomalies.select(*COLUMNS, *extra)


def _zscore(df: DataFrame, amount: str) -> Column:
    stats = moments(df, amount)
    centred = F.when(is_finite(amount), F.col(amount)) - stats.select("mean").scalar()
    return F.try_divide(centred, stats.select("stddev").scalar())


def _constant(value: float | None) -> Column:
    return F.lit(value).cast("double")

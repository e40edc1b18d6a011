"""Weekly spending per customer and the activity derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions import week_number, year_number


def weekly(
    df: DataFrame,
    year_basis: str = "calendar",
    *,
    ordered: bool = False,
    customer: str = "customer_id",
    date: str = "transaction_date",
    amount: str = "total_amount",
) -> DataFrame:
    """Spending per customer, year and week.

    Sums are combined before the shuffle, so a dominant customer costs each task at most one row per
    week. ``ordered`` adds a global sort for presentation.
    """
    result = df.groupBy(
        F.col(customer).alias("customer_id"),
        year_number(date, year_basis).alias("year"),
        week_number(date).alias("week"),
    ).agg(F.sum(amount).alias("weekly_spending"))
    return result.orderBy("customer_id", "year", "week") if ordered else result


def active_weeks(weekly_spending: DataFrame) -> DataFrame:
    """Number of weeks with transactions per customer, from the weekly frame."""
    return weekly_spending.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("weeks_with_transactions")
    )


def activity_histogram(customer_weeks: DataFrame, *, ordered: bool = False) -> DataFrame:
    """Number of customers for each count of active weeks."""
    result = customer_weeks.groupBy("weeks_with_transactions").agg(F.count(F.lit(1)).alias("count"))
    return result.orderBy("weeks_with_transactions") if ordered else result

"""Monthly order counts and customers whose orders keep declining."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tillscope.functions import month_number, year_number

MONTHS = 3
SAVED_COLUMNS = [
    "customer_id",
    "year",
    "month",
    "order_count",
    "prev_month_orders",
    "prev_prev_month_orders",
]


def _newest_first() -> WindowSpec:
    """Months of a customer, latest first.

    The older months are then the following rows, so that the rank and both comparisons share one
    shuffle and one sort.
    """
    return Window.partitionBy("customer_id").orderBy(F.desc("year"), F.desc("month"))


def monthly_orders(
    df: DataFrame,
    *,
    customer: str = "customer_id",
    date: str = "transaction_date",
    transaction: str = "transaction_id",
) -> DataFrame:
    """Orders per customer and month; rows without a transaction id are not counted."""
    return df.groupBy(
        F.col(customer).alias("customer_id"),
        year_number(date).alias("year"),
        month_number(date).alias("month"),
    ).agg(F.count(transaction).alias("order_count"))


def rank_months(monthly: DataFrame) -> DataFrame:
    """Rank the active months of each customer, 1 being the latest.

    The window sees one row per customer and active month, never raw transactions.
    """
    return monthly.withColumn("month_rank", F.row_number().over(_newest_first()))


def last_three_months(ranked: DataFrame) -> DataFrame:
    """Each customer's three latest active months with the counts of one and two months before.

    Months without orders are skipped, and nothing before the three kept months is looked at.
    """
    return ranked.filter(F.col("month_rank") <= MONTHS).withColumns(
        {
            "prev_month_orders": F.lead("order_count", 1).over(_newest_first()),
            "prev_prev_month_orders": F.lead("order_count", 2).over(_newest_first()),
        }
    )


def declining(df: DataFrame, **columns: str) -> DataFrame:
    """Customers whose latest month is below the one before, itself below the one before that."""
    return (
        last_three_months(rank_months(monthly_orders(df, **columns)))
        .filter(F.col("month_rank") == 1)
        .filter(F.col("order_count") < F.col("prev_month_orders"))
        .filter(F.col("prev_month_orders") < F.col("prev_prev_month_orders"))
    )


def report(declining_customers: DataFrame, *, ordered: bool = False) -> DataFrame:
    """Presentation form with the month as text, such as ``2024-9``."""
    result = declining_customers.select(
        "customer_id", year_month().alias("year_month"), "order_count", "month_rank"
    )
    return result.orderBy("customer_id") if ordered else result


def saved(declining_customers: DataFrame) -> DataFrame:
    """Stored form with the three counts."""
    return declining_customers.select(*SAVED_COLUMNS)


def year_month(year: str = "year", month: str = "month") -> Column:
    return F.concat(F.col(year).cast("string"), F.lit("-"), F.col(month).cast("string"))


def declining_sql(df: DataFrame, *, ordered: bool = False) -> DataFrame:
    """The presentation form, written in SQL; equal to ``report(declining(df))``."""
    result = df.sparkSession.sql(
        """
        WITH counted AS (
            SELECT customer_id, year(transaction_date) AS year, month(transaction_date) AS month,
                   count(transaction_id) AS order_count
            FROM {tx}
            GROUP BY ALL
        ), ranked AS (
            SELECT *, row_number() OVER latest AS month_rank
            FROM counted
            WINDOW latest AS (PARTITION BY customer_id ORDER BY year DESC, month DESC)
        ), compared AS (
            SELECT *, lead(order_count) OVER latest AS before1,
                   lead(order_count, 2) OVER latest AS before2
            FROM ranked
            WHERE month_rank <= 3
            WINDOW latest AS (PARTITION BY customer_id ORDER BY year DESC, month DESC)
        )
        SELECT customer_id, year || '-' || month AS year_month, order_count, month_rank
        FROM compared
        WHERE month_rank = 1 AND order_count < before1 AND before1 < before2
        """,
        tx=df,
    )
    return result.orderBy("customer_id") if ordered else result


def declining_count(declining_customers: DataFrame) -> DataFrame:
    return declining_customers.agg(F.count(F.lit(1)).alias("declining_customers"))

"""Per-customer purchasing metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.lenient import complete


def customer_metrics(
    df: DataFrame,
    *,
    customer: str = "customer_id",
    transaction: str = "transaction_id",
    amount: str = "total_amount",
    product: str = "product_id",
    approximate_products: float | None = None,
) -> DataFrame:
    """Orders, spending and distinct products of each customer.

    The distinct count is exact: Spark first groups by customer and product, which spreads a dominant
    customer over all tasks, then by customer. ``approximate_products`` (a relative error) replaces
    that first shuffle by a sketch.
    """
    if approximate_products is None:
        products = F.count_distinct(F.col(product))
    else:
        products = F.approx_count_distinct(product, approximate_products)
    return df.groupBy(F.col(customer).alias("customer_id")).agg(
        F.count(transaction).alias("total_orders"),
        F.sum(amount).alias("total_spending"),
        products.alias("unique_products"),
    )


def complete_metrics(metrics: DataFrame) -> DataFrame:
    """Customers without any NULL, NaN or infinite metric."""
    return metrics.filter(complete(metrics, metrics.columns))

"""Transactions derived from a star schema of orders and line items, and from an event stream table.

No broadcast hints here: every dimension may grow, so the choice is left to Spark's size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def _id(prefix: str, *columns: str) -> Column:
    parts: list[Column] = [F.lit(prefix)]
    for i, c in enumerate(columns):
        parts += [F.lit("_")] if i else []
        parts.append(F.col(c).cast("string"))
    return F.concat(*parts)


def sales(spark: SparkSession, directory: str) -> DataFrame:
    """One row per line item with the columns that spending, customer and trend analyses need.

    Only line items and orders are joined; the dimensions would add shuffles and no used column.
    """
    lines = table(spark, directory, "lineitem")
    orders = table(spark, directory, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        _id("TXN_", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        _id("STD_", "o_custkey").alias("customer_id"),
        _id("PRT_", "l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("total_amount"),
    )


def transactions(spark: SparkSession, directory: str) -> DataFrame:
    """All ten transaction columns."""
    return _joined(spark, directory).select(*_ten_columns().values())


def _joined(spark: SparkSession, directory: str) -> DataFrame:
    # Orders meet their customers before the line items do, so that the largest table is shuffled for
    # two joins at most.
    lines = table(spark, directory, "lineitem")
    parts = table(spark, directory, "part")
    orders = table(spark, directory, "orders")
    customers = table(spark, directory, "customer")
    nations = table(spark, directory, "nation")
    bought = orders.join(
        customers.join(nations, customers.c_nationkey == nations.n_nationkey),
        orders.o_custkey == customers.c_custkey,
    )
    return lines.join(parts, lines.l_partkey == parts.p_partkey).join(
        bought, lines.l_orderkey == orders.o_orderkey
    )


def _ten_columns() -> dict[str, Column]:
    columns = {
        "transaction_id": _id("TXN_", "l_orderkey", "l_linenumber"),
        "transaction_date": F.col("o_orderdate").cast("date"),
        "transaction_time": F.lit("00:00:00"),
        "customer_id": _id("STD_", "o_custkey"),
        "product_id": _id("PRT_", "l_partkey"),
        "quantity": F.col("l_quantity").cast("int"),
        "unit_price": F.col("p_retailprice"),
        "total_amount": F.col("l_extendedprice"),
        "payment_method": F.col("o_orderpriority"),
        "store_location": F.col("n_name"),
    }
    return {name: column.alias(name) for name, column in columns.items()}


def event_amounts(spark: SparkSession, directory: str) -> DataFrame:
    """Events seen as single-item transactions; their amounts are heavy-tailed."""
    return table(spark, directory, "events").select(
        _id("TXN_", "event_id").alias("transaction_id"),
        F.col("ts").cast("date").alias("transaction_date"),
        F.substring(F.col("ts").cast("string"), 12, 8).alias("transaction_time"),
        _id("STD_", "user_id").alias("customer_id"),
        F.col("event_type").alias("product_id"),
        F.lit(1).alias("quantity"),
        F.col("value").alias("unit_price"),
        F.col("value").alias("total_amount"),
        F.lit("CASH").alias("payment_method"),
        F.lit("Hanoi").alias("store_location"),
    )


def damaged_transactions(spark: SparkSession, directory: str) -> DataFrame:
    """Every transaction as raw text, with fields damaged by a fixed rule on the order key.

    ``expected_customer`` keeps the undamaged customer id.
    """
    text = {name: column.cast("string") for name, column in _ten_columns().items()}
    customer, quantity, total = text["customer_id"], text["quantity"], text["total_amount"]

    def every(n: int) -> Column:
        return F.col("l_orderkey") % n == 0

    damaged = text | {
        "transaction_date": F.when(every(97), F.lit(None))
        .when(every(101), "2023-13-45")
        .otherwise(text["transaction_date"]),
        "customer_id": F.when(every(23), F.lit(None))
        .when(every(29), F.concat(F.lit(" "), customer))
        .otherwise(customer),
        "quantity": F.when(every(11), F.concat(quantity, F.lit("a")))
        .when(every(13), F.concat(F.lit("-"), quantity))
        .otherwise(quantity),
        "unit_price": F.when(every(89), "0").otherwise(text["unit_price"]),
        "total_amount": F.when(every(17), F.concat(total, F.lit("$")))
        .when(every(19), F.lit(None))
        .otherwise(total),
        "expected_customer": customer,
    }
    return _joined(spark, directory).select(*[c.alias(name) for name, c in damaged.items()])

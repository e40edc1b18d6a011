"""Column names and schemas of the transaction table."""

from __future__ import annotations

from pyspark.sql import types as T

# The ten transaction columns, in file order.
COLUMNS = [
    "transaction_id",
    "transaction_date",
    "transaction_time",
    "customer_id",
    "product_id",
    "quantity",
    "unit_price",
    "total_amount",
    "payment_method",
    "store_location",
]

# The four columns whose type changes on validation; the other six stay text.
CONVERTED = {
    "transaction_date": T.DateType(),
    "quantity": T.IntegerType(),
    "unit_price": T.DoubleType(),
    "total_amount": T.DoubleType(),
}

RAW = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
# Holds the whole line of a raw record that does not have the ten fields; NULL for all others.
MALFORMED = "malformed_record"
RAW_WITH_MALFORMED = T.StructType([*RAW, T.StructField(MALFORMED, T.StringType())])
TYPED = T.StructType([T.StructField(c, CONVERTED.get(c, T.StringType())) for c in COLUMNS])

# Features used to describe a customer's purchasing behaviour.
METRICS = ["total_orders", "total_spending", "unique_products"]

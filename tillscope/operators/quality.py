"""Validation of raw transactions: rules, split, typing, repair of totals, quality counts.

Everything is a row-wise expression or one map-side combined aggregate; nothing here shuffles rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions import lenient_date, lenient_double, lenient_int
from tillscope.schema import COLUMNS, MALFORMED

FLAG = "has_error"
NULL_FLAG_POLICIES = ("error", "drop")


def rules(
    expected_customer: str | Column | None = None, customer_pattern: str | None = None
) -> dict[str, Column]:
    """Name and condition of every rule; a row is in error when any condition holds.

    ``expected_customer`` is the only id accepted (a literal, or a column to compare with);
    ``customer_pattern`` is a regular expression ids must match. With neither, ids are not checked.
    Zero quantities and negative totals are valid.
    """
    typed = conversions()
    return {
        "date_missing": typed["transaction_date"].isNull(),
        "quantity_not_integer": typed["quantity"].isNull(),
        "quantity_negative": typed["quantity"] < 0,
        "price_not_numeric": typed["unit_price"].isNull(),
        "price_not_positive": typed["unit_price"] <= 0,
        "total_not_numeric": typed["total_amount"].isNull(),
    } | _customer_rules(expected_customer, customer_pattern)


def error_condition(
    expected_customer: str | Column | None = None, customer_pattern: str | None = None
) -> Column:
    """Whether any of the rules holds, reading each field once."""
    typed = conversions()
    checks = [
        typed["transaction_date"].isNull(),
        F.coalesce(typed["quantity"] < 0, F.lit(True)),
        F.coalesce(typed["unit_price"] <= 0, F.lit(True)),
        typed["total_amount"].isNull(),
        *_customer_rules(expected_customer, customer_pattern).values(),
    ]
    return reduce(or_, checks)


def _customer_rules(
    expected_customer: str | Column | None, customer_pattern: str | None
) -> dict[str, Column]:
    found = {}
    if expected_customer is not None:
        wanted = (
            F.lit(expected_customer) if isinstance(expected_customer, str) else expected_customer
        )
        found["wrong_customer"] = F.col("customer_id") != wanted
    if customer_pattern is not None:
        found["malformed_customer"] = ~F.col("customer_id").rlike(customer_pattern)
    return found


def flag(raw: DataFrame, condition: Column, on_null_flag: str = "error") -> DataFrame:
    """Add the boolean ``has_error``.

    The condition is three-valued: a NULL customer id makes it NULL when nothing else is wrong.
    ``error`` counts such a row as an error, so that clean and rejected rows add up to the input;
    ``drop`` keeps the NULL, and the row then belongs to neither side. Malformed records, as ``read_raw`` marks them, are
    always errors.
    """
    if MALFORMED in raw.columns:
        condition = F.when(F.col(MALFORMED).isNotNull(), True).otherwise(condition)
    if on_null_flag not in NULL_FLAG_POLICIES:
        raise ValueError(f"on_null_flag must be one of {NULL_FLAG_POLICIES}, got {on_null_flag!r}")
    if on_null_flag == "error":
        condition = F.coalesce(condition, F.lit(True))
    return raw.withColumn(FLAG, condition)


def clean_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col(FLAG)).drop(FLAG)


def rejected_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(FLAG).drop(FLAG)


def unflagged_rows(flagged: DataFrame) -> DataFrame:
    """Rows in neither set; empty unless the flag was built with ``on_null_flag="drop"``."""
    return flagged.filter(F.col(FLAG).isNull()).drop(FLAG)


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return clean_rows(flagged), rejected_rows(flagged)


def conversions() -> dict[str, Column]:
    """The columns that change type, read from text; what cannot be read becomes NULL."""
    return {
        "transaction_date": lenient_date("transaction_date"),
        "quantity": lenient_int("quantity"),
        "unit_price": lenient_double("unit_price"),
        "total_amount": lenient_double("total_amount"),
    }


def enforce_types(df: DataFrame) -> DataFrame:
    """The ten transaction columns with their types."""
    typed = conversions()
    return df.select(*[typed.get(c, F.col(c)).alias(c) for c in COLUMNS])


def repair_totals(df: DataFrame) -> DataFrame:
    """Make the total equal to quantity times price, keeping it where that product is NULL."""
    return df.withColumn(
        "total_amount", F.coalesce(F.col("quantity") * F.col("unit_price"), F.col("total_amount"))
    )


def rule_counts(raw: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule, one line per rule, from one pass; a row may break several."""
    counted = raw.agg(*[F.count_if(condition).alias(name) for name, condition in checks.items()])
    return counted.unpivot([], list(checks), "rule", "broken_rows")


def count_columns() -> list[Column]:
    """Aggregates over a flagged frame behind ``summary``; also usable with ``DataFrame.observe``."""
    return [
        F.count_if(~F.col(FLAG)).alias("clean_rows"),
        F.count_if(FLAG).alias("error_rows"),
    ]


def summary(flagged: DataFrame) -> DataFrame:
    """Clean, rejected and total rows and the error rate in percent (0 on empty input)."""
    return add_error_rate(flagged.agg(*count_columns()))


def add_error_rate(counts: DataFrame) -> DataFrame:
    total = F.col("clean_rows") + F.col("error_rows")
    return counts.withColumns(
        {
            "total_rows": total,
            "error_rate_pct": F.coalesce(
                F.try_divide(F.col("error_rows"), total) * 100, F.lit(0.0)
            ),
        }
    )

import math
from functools import reduce
from operator import or_

import pytest
from pyspark.sql import functions as F

from tests.rows import CUSTOMER, raw
from tillscope.operators import quality

# Damaged fields, each of which alone makes a row an error.
REJECTED = [
    *[
        {"customer_id": c}
        for c in [
            "STD123456789",
            "std_123456789",
            "STD_123456789_",
            "STD-123456789",
            "STD_54321",
            "STD_12",
            "STD_",
            "123456789",
            "ST_123456789",
            " STD_123456789",
        ]
    ],
    *[{"quantity": q} for q in ["5a", "5b", "5c", "-5", "2.7", "", None]],
    *[{"unit_price": p} for p in ["0", "-1", "abc", "", None, "NaN", "Infinity", "1e999", "5f", "5d"]],
    *[{"total_amount": t} for t in ["31.5$", "31.5€", "31.5£", "", None, "NaN", "-Infinity"]],
    *[{"transaction_date": d} for d in [None, "2023-13-45", "2023-1-5", "yesterday", "2023-01-1T", "2023-01-1 ", " 2023-1-1 ", "2023-01-01T"]],
]
# Unusual fields that are valid.
ACCEPTED = [
    {},
    {"quantity": "0"},
    {"quantity": " 5 "},
    {"unit_price": "1e3"},
    {"total_amount": "-3"},
    {"total_amount": "999"},
    *[{"payment_method": m} for m in ["cash", "Credit Card", "debit-card", "PAYPAL", "", None]],
    *[{"store_location": s} for s in ["ha noi", "HCMC", "Da-Nang", "HoChiMinh ", "", None]],
]


def flagged(spark, changes, **options):
    return quality.flag(raw(spark, *changes), quality.error_condition(CUSTOMER), **options)


def test_each_damage_is_rejected(spark):
    df = flagged(spark, REJECTED)
    assert quality.rejected_rows(df).count() == len(REJECTED)
    assert quality.clean_rows(df).count() == 0


def test_unusual_but_valid_rows_are_kept(spark):
    df = flagged(spark, ACCEPTED)
    assert quality.clean_rows(df).count() == len(ACCEPTED)


def test_rejected_rows_keep_their_text(spark):
    rows = quality.rejected_rows(flagged(spark, [{"total_amount": "31.5$"}])).collect()
    assert rows[0].total_amount == "31.5$"
    assert "has_error" not in rows[0].asDict()


def test_null_flag_policies(spark):
    changes = [{}, {"customer_id": None}, {"customer_id": None, "quantity": "-1"}]
    strict = flagged(spark, changes)
    clean, rejected = quality.split(strict)
    assert (clean.count(), rejected.count(), quality.unflagged_rows(strict).count()) == (1, 2, 0)
    loose = flagged(spark, changes, on_null_flag="drop")
    clean, rejected = quality.split(loose)
    assert (clean.count(), rejected.count(), quality.unflagged_rows(loose).count()) == (1, 1, 1)
    with pytest.raises(ValueError):
        flagged(spark, changes, on_null_flag="keep")


def test_customer_rule_variants(spark):
    changes = [{}, {"customer_id": "STD_5"}, {"customer_id": "std_5"}]

    def kept(**options):
        return quality.clean_rows(quality.flag(raw(spark, *changes), quality.error_condition(**options))).count()

    assert kept() == 3
    assert kept(expected_customer=CUSTOMER) == 1
    assert kept(expected_customer=F.lit("STD_5")) == 1
    assert kept(customer_pattern="^STD_[0-9]+$") == 2


def test_rule_counts_list_every_rule(spark):
    df = raw(spark, {"quantity": "-5"}, {"quantity": "5a", "unit_price": "0"}, {}, {"unit_price": "0"})
    counts = {r.rule: r.broken_rows for r in quality.rule_counts(df, quality.rules(CUSTOMER)).collect()}
    assert counts == {
        "date_missing": 0,
        "quantity_not_integer": 1,
        "quantity_negative": 1,
        "price_not_numeric": 0,
        "price_not_positive": 2,
        "total_not_numeric": 0,
        "wrong_customer": 0,
    }


def test_condition_equals_the_rules(spark):
    changes = [*REJECTED, *ACCEPTED, {"customer_id": None}, {"customer_id": None, "quantity": "-1"}]
    options = {"expected_customer": CUSTOMER, "customer_pattern": "^STD_"}
    any_rule = reduce(or_, quality.rules(**options).values())
    both = raw(spark, *changes).select(
        any_rule.alias("one"), quality.error_condition(**options).alias("two")
    )
    assert both.filter(~F.col("one").eqNullSafe(F.col("two"))).count() == 0
    assert both.filter("two IS NULL").count() == 1


def test_types_and_repair(spark):
    df = raw(
        spark,
        {"total_amount": "999"},
        {"total_amount": "31.5"},
        {"quantity": "5a", "total_amount": "7"},
        {"unit_price": "NaN"},
        {"quantity": "0"},
    )
    typed = quality.enforce_types(df)
    assert [t for _, t in typed.dtypes] == [
        "string", "date", "string", "string", "string", "int", "double", "double", "string", "string",
    ]
    totals = [r.total_amount for r in quality.repair_totals(typed).orderBy("transaction_id").collect()]
    assert totals[:3] == [31.5, 31.5, 7.0]
    assert totals[3] == 31.5 and totals[4] == 0.0


def test_repair_equals_the_conditional_form(spark):
    """Replacing a missing or different total gives the same as preferring the product."""
    amounts = "array(NULL, double('NaN'), 0d, -0d, 3.3d, 9.9d, -3.3d)"
    df = spark.sql(
        f"SELECT q AS quantity, p AS unit_price, t AS total_amount "
        f"FROM (SELECT explode(array(NULL, 0, 1, 3, -3)) AS q), (SELECT explode({amounts}) AS p), "
        f"(SELECT explode({amounts}) AS t)"
    )
    product = F.col("quantity") * F.col("unit_price")
    total = F.col("total_amount")
    conditional = F.when(total.isNull() | (total != product), product).otherwise(total)
    both = df.withColumn("conditional", conditional)
    both = quality.repair_totals(both)
    assert df.count() == 245
    # A missing product leaves a missing total either way.
    different = both.filter(~F.col("conditional").eqNullSafe(F.col("total_amount")))
    assert different.count() == 0


def test_summary(spark):
    row = quality.summary(flagged(spark, [{}, {}, {}, {"quantity": "-5"}])).first()
    assert (row.clean_rows, row.error_rows, row.total_rows, row.error_rate_pct) == (3, 1, 4, 25.0)
    empty = quality.summary(flagged(spark, [{}]).filter("false")).first()
    assert (empty.total_rows, empty.error_rate_pct) == (0, 0.0)

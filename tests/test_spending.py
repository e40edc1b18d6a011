import pytest
from pyspark.sql import functions as F

from tests.rows import sales
from tillscope.operators import customers, profiling, spending
from tillscope.schema import METRICS

ROWS = [
    ("a", "2023-01-01", 1.0),  # Sunday of ISO week 52 of 2022
    ("a", "2023-12-31", 2.0),
    ("a", "2024-12-30", 4.0),  # Monday of ISO week 1 of 2025
    ("a", "2024-01-01", 8.0),
    ("b", "2024-01-02", 16.0, "ELE_1"),
    ("b", "2024-01-03", 32.0, "ELE_2"),
    ("b", "2024-01-03", 64.0, "ELE_2"),
]


def weeks(df):
    return {(r.customer_id, r.year, r.week): r.weekly_spending for r in df.collect()}


def test_weekly_by_calendar_year(spark):
    assert weeks(spending.weekly(sales(spark, ROWS))) == {
        ("a", 2023, 52): 3.0,
        ("a", 2024, 1): 12.0,
        ("b", 2024, 1): 112.0,
    }


def test_weekly_by_iso_year(spark):
    assert weeks(spending.weekly(sales(spark, ROWS), "iso")) == {
        ("a", 2022, 52): 1.0,
        ("a", 2023, 52): 2.0,
        ("a", 2024, 1): 8.0,
        ("a", 2025, 1): 4.0,
        ("b", 2024, 1): 112.0,
    }
    with pytest.raises(ValueError):
        spending.weekly(sales(spark, ROWS), "fiscal")


def test_weekly_types_and_order(spark):
    df = spending.weekly(sales(spark, ROWS), ordered=True)
    assert df.dtypes == [
        ("customer_id", "string"), ("year", "int"), ("week", "int"), ("weekly_spending", "double"),
    ]
    keys = [(r.customer_id, r.year, r.week) for r in df.collect()]
    assert keys == sorted(keys)


def test_activity(spark):
    active = spending.active_weeks(spending.weekly(sales(spark, ROWS)))
    assert {r.customer_id: r.weeks_with_transactions for r in active.collect()} == {"a": 2, "b": 1}
    histogram = spending.activity_histogram(active, ordered=True)
    assert [tuple(r) for r in histogram.collect()] == [(1, 1), (2, 1)]


def test_sums_agree(spark):
    df = sales(spark, ROWS)
    total = df.agg(F.sum("total_amount")).first()[0]
    assert spending.weekly(df).agg(F.sum("weekly_spending")).first()[0] == total
    assert customers.customer_metrics(df).agg(F.sum("total_spending")).first()[0] == total


def test_customer_metrics(spark):
    df = sales(spark, ROWS)
    found = {r.customer_id: tuple(r)[1:] for r in customers.customer_metrics(df).collect()}
    assert found == {"a": (4, 15.0, 1), "b": (3, 112.0, 2)}
    rough = customers.customer_metrics(df, approximate_products=0.01)
    assert {r.customer_id: r.unique_products for r in rough.collect()} == {"a": 1, "b": 2}


def test_null_handling(spark):
    df = sales(spark, [("a", "2024-01-01", None), (None, "2024-01-01", 1.0), ("b", None, 2.0)])
    metrics = customers.customer_metrics(df)
    nulls = profiling.null_profile(metrics).first().asDict()
    assert nulls == {"customer_id": 1, "total_orders": 0, "total_spending": 1, "unique_products": 0}
    assert tuple(profiling.null_loss(metrics).first()) == (3, 1, 2)
    assert [r.customer_id for r in customers.complete_metrics(metrics).collect()] == ["b"]


def test_results_do_not_depend_on_partitions(spark):
    df = sales(spark, ROWS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    expected = weeks(spending.weekly(df))
    try:
        for n in (1, 3, 17):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert weeks(spending.weekly(df.repartition(n))) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_profiles(spark):
    rows = [("c%d" % i, i, float(i * i), 7) for i in range(1, 101)]
    schema = "customer_id string, total_orders bigint, total_spending double, unique_products bigint"
    metrics = spark.createDataFrame(rows, schema)
    described = {r.metric: r for r in profiling.describe_numeric(metrics, METRICS).collect()}
    assert described["total_orders"]["count"] == 100
    assert described["total_orders"]["mean"] == 50.5
    assert round(described["total_orders"]["stddev"], 9) == round((100 * 101 / 12) ** 0.5, 9)
    assert described["unique_products"]["stddev"] == 0.0
    tails = {r.metric: r for r in profiling.tail_percentiles(metrics, METRICS).collect()}
    assert tuple(tails["total_orders"])[1:] == (1, 1, 5, 25, 50, 75, 95, 99, 100)
    assert tails["total_spending"].p95 == 95.0**2
    summary = profiling.summary_numeric(metrics, ["total_orders"]).first()
    assert (summary.p25, summary.p50, summary.p75) == (25.0, 50.0, 75.0)


def test_profiles_of_nothing(spark):
    schema = "customer_id string, total_orders bigint, total_spending double, unique_products bigint"
    empty = spark.createDataFrame([], schema)
    row = profiling.summary_numeric(empty, ["total_spending"]).first()
    assert row["count"] == 0 and row.p50 is None and row["max"] is None
    assert spending.weekly(sales(spark, [])).count() == 0


def test_dominant_customer(spark):
    """A customer with a third of all rows, over several tasks, against plain counting."""
    df = spark.range(0, 30000, numPartitions=8).select(
        F.concat(F.lit("TXN_"), F.col("id")).alias("transaction_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 366).cast("int")).alias(
            "transaction_date"
        ),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias(
            "customer_id"
        ),
        F.concat(F.lit("p"), F.col("id") % 1000).alias("product_id"),
        F.lit(2.0).alias("total_amount"),
    )
    metrics = {r.customer_id: tuple(r)[1:] for r in customers.customer_metrics(df).collect()}
    assert metrics["hot"] == (10000, 20000.0, 1000)
    assert sum(m[0] for m in metrics.values()) == 30000
    found = weeks(spending.weekly(df))
    # Days repeat every 366 rows, a multiple of three, so the hot rows fall on every third day only.
    assert sum(v for (c, _, _), v in found.items() if c == "hot") == 20000.0
    assert sum(found.values()) == 60000.0

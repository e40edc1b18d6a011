import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.rows import amounts, sales
from tillscope.operators import anomalies, sketches

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def values(n=60_000):
    source = random.Random(3)
    return [round(source.lognormvariate(3, 1), 2) for _ in range(n)]


def far(ordered, p, value):
    """How far the ranks of a value are from p."""
    import bisect

    low, high = bisect.bisect_left(ordered, value) / len(ordered), bisect.bisect_right(ordered, value) / len(ordered)
    return max(low - p, p - high, 0)


def test_ranks_are_within_the_accuracy(spark):
    rows, ordered = values(), sorted(values())
    df = spark.createDataFrame([(v,) for v in rows], "v double").repartition(16)
    found = sketches.quantiles(df, "v", PROBABILITIES, 200)
    assert found[0.0] == ordered[0] and found[1.0] == ordered[-1]
    assert all(far(ordered, p, v) <= 1 / 200 for p, v in found.items())


def test_merged_days_keep_the_bound(spark):
    rows, ordered = values(), sorted(values())
    df = spark.createDataFrame([(i % 30, v) for i, v in enumerate(rows)], "day int, total_amount double")
    days = sketches.amount_sketches(df, ["day"], accuracy=200)
    halves = [sketches.merged(days.filter(c)) for c in ("day < 15", "day >= 15")]
    row = sketches.merged(halves[0].union(halves[1])).select("n", *[sketches.quantile(p) for p in PROBABILITIES]).first()
    assert row[0] == len(rows)
    assert all(far(ordered, p, v) <= 1 / 200 for p, v in zip(PROBABILITIES, row[1:]))


def test_one_scan(spark, tmp_path, capsys):
    amounts(spark, [1.0, 2.0]).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    sketches.merged(sketches.amount_sketches(df, ["transaction_date"])).explain("formatted")
    plan = capsys.readouterr().out.split("== Physical Plan ==")[1]
    assert plan.split("\n\n")[0].count("Scan parquet") == 1
    assert "ReadSchema: struct<transaction_date:date,total_amount:double>" in plan


def test_nulls_empty_groups_and_clashing_names(spark):
    rows = [(1, None, 0, 0), (1, math.nan, 0, 0), (2, 1.0, 0, 0), (None, math.inf, 0, 0), (None, -math.inf, 0, 0)]
    df = spark.createDataFrame(rows, "k int, total_amount double, n int, sketch int")
    per = sketches.amount_sketches(df, ["k"])
    got = {r[0]: tuple(r)[1:] for r in per.select("k", "n", sketches.quantile(0), sketches.quantile(1)).collect()}
    assert got == {1: (0, None, None), 2: (1, 1.0, 1.0), None: (2, -math.inf, math.inf)}
    none = sketches.merged(sketches.amount_sketches(df.filter("false"), ["k"]))
    assert [tuple(r) for r in none.collect()] == [(0, None)]
    assert sketches.quantiles(df.filter("false"), "total_amount", [0.5]) == {0.5: None}


def test_accuracy_beyond_sketches_is_refused():
    assert sketches.kll_size(9_000) < 65_536
    for wrong in (0, 10_000):
        with pytest.raises(ValueError):
            sketches.kll_size(wrong)


def test_anomalies_with_accuracy(spark):
    df = amounts(spark, [float(i) for i in range(1, 101)] + [1000.0])
    for method in ("iqr", "median"):
        exact = {r.transaction_id for r in anomalies.detect(df, method).collect()}
        assert {r.transaction_id for r in anomalies.detect(df, method, accuracy=1000).collect()} == exact == {"TXN_100"}
    assert anomalies.detect(df.filter("false"), "iqr", accuracy=100).count() == 0


def test_a_new_day_needs_no_old_rows(spark, tmp_path):
    many = [("A", f"2024-01-{1 + i % 28:02}", 1.0, f"P{i % 3000}") for i in range(9000)] + [("B", "2024-01-01", 1.0, "P1"), ("B", "2024-01-02", 1.0, None)]
    stored = f"{tmp_path}/periods"
    old = sales(spark, many).filter("transaction_date < '2024-01-28'")
    sketches.customer_periods(old, "transaction_date").write.parquet(stored)
    new = sales(spark, many).filter("transaction_date >= '2024-01-28'")
    sketches.customer_periods(new, "transaction_date").write.mode("append").parquet(stored)
    got = {r.customer_id: r for r in sketches.customer_totals(spark.read.parquet(stored)).collect()}
    assert got["A"].total_orders == 9000 and abs(got["A"].unique_products - 3000) <= 3000 * 4 * sketches.distinct_error()
    assert (got["B"].total_orders, got["B"].unique_products) == (2, 1)


def test_periods_by_expression_and_empty(spark):
    rows = sales(spark, [("A", "2024-01-31", 1.0), ("A", "2024-02-01", 1.0), (None, None, 1.0)])
    per = sketches.customer_periods(rows, F.trunc("transaction_date", "month"))
    assert {(r.customer_id, r.period, r.orders) for r in per.collect()} == {
        ("A", dt.date(2024, 1, 1), 1), ("A", dt.date(2024, 2, 1), 1), (None, None, 1)
    }
    assert sketches.customer_totals(per.filter("false")).count() == 0

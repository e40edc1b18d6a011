import math
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.rows import sales
from tillscope.operators import exact


def rows(spark, values, parts):
    data = [(i % 7, v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "k int, total_amount double").repartition(parts, F.rand(parts))


def cents(n=5000):
    source = random.Random(5)
    return [source.randint(-(10**9), 10**9) / 100 for _ in range(n)]


def test_same_sums_for_any_partitioning(spark):
    values = cents()
    expected = sum(Decimal(f"{v:.2f}") for v in values)
    found = set()
    for parts in (1, 3, 8):
        df = rows(spark, values, parts)
        moments = exact.moments(exact.added(exact.power_sums(df, ["k"]))).first()
        found.add((df.agg(exact.total("total_amount")).first()[0], *moments))
    assert len(found) == 1
    total, n, mean, deviation = found.pop()
    assert total == expected and n == len(values)
    assert mean == pytest.approx(float(expected) / n, rel=1e-15)
    assert deviation == pytest.approx(statistics.stdev(values), rel=1e-13)


def test_deviation_of_large_close_amounts(spark):
    values = [1e11 + i / 100 for i in range(10)]
    row = exact.moments(exact.power_sums(rows(spark, values, 3).withColumn("k", F.lit(1)), ["k"]), ["k"]).first()
    assert row.stddev == pytest.approx(statistics.stdev(i / 100 for i in range(10)), rel=1e-12)


def test_left_out_and_rounded(spark):
    df = rows(spark, [1.005, 2.5, None, math.nan, math.inf, 1e17], 2)
    assert df.agg(exact.total("total_amount")).first()[0] == Decimal("3.51")
    assert df.agg(exact.unlike("total_amount")).first()[0] == 4
    sums = exact.added(exact.power_sums(df, ["k"])).first()
    assert (sums.n, sums.left_out, sums.s) == (2, 3, 351)


def test_none_one_and_empty(spark):
    one = exact.moments(exact.added(exact.power_sums(rows(spark, [2.25], 1), ["k"]))).first()
    assert tuple(one) == (1, 2.25, None)
    empty = exact.moments(exact.added(exact.power_sums(rows(spark, [1.0], 1).filter("false"), ["k"]))).first()
    assert tuple(empty) == (0, None, None)
    none = exact.moments(exact.power_sums(rows(spark, [None], 1), ["k"]), ["k"]).first()
    assert tuple(none) == (0, 0, None, None)


def test_weeks(spark):
    df = sales(spark, [("A", "2024-01-01", 0.1), ("A", "2024-01-02", 0.2), (None, None, 1.0)])
    assert {tuple(r) for r in exact.weekly(df).collect()} == {
        ("A", 2024, 1, Decimal("0.30")), (None, None, None, Decimal("1.00"))
    }

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillscope.operators.quantiles import quantiles

PROBABILITIES = [0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]


def expected(values, probabilities=PROBABILITIES):
    ordered = sorted(values)
    return {p: ordered[max(math.ceil(p * len(ordered)), 1) - 1] for p in probabilities}


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double").repartition(4)


def awkward():
    source = random.Random(7)
    return (
        [source.choice([-1, 1]) * source.random() * 10 ** source.randint(-300, 300) for _ in range(500)]
        + [5e-324 * i for i in range(100)]
        + [0.0, -0.0] * 20
        + [math.inf, -math.inf] * 30
        + [1.5 + i * 2**-52 for i in range(700)]
        + [1.5] * 900
    )


@pytest.mark.parametrize(
    "values",
    [
        awkward(),
        [3.0],
        [2.0, 2.0, 2.0],
        [round(random.Random(1).expovariate(0.02), 2) for _ in range(1000)],
        list(map(float, range(-50, 51))),
    ],
    ids=["awkward", "one", "constant", "cents", "integers"],
)
def test_values_are_exact(spark, values):
    assert quantiles(frame(spark, values), ["v"], PROBABILITIES)["v"] == expected(values)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=60))
def test_narrowing_is_exact(spark, values):
    probabilities = [0.25, 0.5, 0.75]
    found = quantiles(frame(spark, values), ["v"], probabilities)["v"]
    assert found == expected(values, probabilities)


def test_nan_sorts_last_and_null_is_left_out(spark):
    df = frame(spark, [1.0, None, 2.0, math.nan, None])
    found = quantiles(df, ["v"], [0.5, 1.0])["v"]
    assert found[0.5] == 2.0 and math.isnan(found[1.0])


def test_several_columns_and_no_values(spark):
    df = spark.createDataFrame(
        [(i, float(-i), None) for i in range(1, 10)], "a int, b double, c double"
    )
    assert quantiles(df, ["a", "b", "c"], [0.5, 0.9]) == {
        "a": {0.5: 5.0, 0.9: 9.0},
        "b": {0.5: -5.0, 0.9: -1.0},
        "c": {0.5: None, 0.9: None},
    }
    empty = quantiles(df.filter("false"), ["a"], [0.5])
    assert empty == {"a": {0.5: None}}


def test_one_value_holding_most_rows(spark):
    values = [10.25] * 4000 + [i / 100 for i in range(2000)]
    assert quantiles(frame(spark, values), ["v"], PROBABILITIES)["v"] == expected(values)


def test_few_distinct_values_take_one_scan(spark):
    from tillscope.operators import quantiles as module

    passes, locate = [], module._locate
    module._locate = lambda *a: passes.append(1) or locate(*a)
    try:
        quantiles(frame(spark, [1.0, 2.0, 3.0] * 50), ["v"], PROBABILITIES)
        assert len(passes) == 1
        quantiles(frame(spark, awkward()), ["v"], PROBABILITIES)
        assert len(passes) - 1 <= 3
    finally:
        module._locate = locate

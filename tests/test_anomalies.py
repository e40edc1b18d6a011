import pytest
from pyspark.sql import functions as F

from tests.rows import amounts
from tillscope.operators import anomalies
from tillscope.schema import COLUMNS

# Mostly 10 to 30, with outliers on both sides.
VALUES = [float(v) for v in range(10, 31)] * 5 + [-200.0, 500.0, 120.0]


def found(df):
    return sorted(r.total_amount for r in df.collect())


def test_zscore_is_two_sided_and_signed(spark):
    df = anomalies.by_zscore(amounts(spark, VALUES), 3.0)
    assert found(df) == [-200.0, 500.0]
    assert [r.zscore > 0 for r in df.orderBy("total_amount").collect()] == [False, True]
    top = anomalies.top(df, 1, "zscore", extra=["zscore"])
    assert found(top) == [500.0]
    assert top.columns == [*anomalies.SHOWN, "zscore"]


def test_zscore_needs_spread(spark):
    assert anomalies.by_zscore(amounts(spark, [5.0])).count() == 0
    assert anomalies.by_zscore(amounts(spark, [5.0, 5.0, 5.0]), 0.0).count() == 0
    assert anomalies.by_zscore(amounts(spark, [])).count() == 0


def test_iqr_sides(spark):
    df = anomalies.by_iqr(amounts(spark, VALUES))
    assert found(df) == [-200.0, 120.0, 500.0]
    assert found(anomalies.high_side(df)) == [120.0, 500.0]
    assert found(anomalies.low_side(df)) == [-200.0]
    row = df.first()
    # Quartiles 15 and 25.
    assert (row.lower_bound, row.upper_bound, row.is_anomaly) == (0.0, 40.0, True)
    assert anomalies.high_side(df).count() + anomalies.low_side(df).count() == df.count()


def test_bounds_are_strict(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 8.0]
    quartiles = anomalies.quartiles(amounts(spark, values))
    assert (quartiles.q1, quartiles.median, quartiles.q3, quartiles.iqr) == (2.0, 3.0, 5.0, 3.0)
    assert found(anomalies.by_iqr(amounts(spark, values), 1.0)) == []
    assert found(anomalies.by_iqr(amounts(spark, values), 0.99)) == [8.0]
    assert found(anomalies.by_median(amounts(spark, [1.0, 2.0, 10.0]), 5.0)) == []
    assert found(anomalies.by_median(amounts(spark, [1.0, 2.0, 10.5]), 5.0)) == [10.5]


def test_median_looks_at_the_high_side_only(spark):
    df = anomalies.by_median(amounts(spark, VALUES))
    assert found(df) == [120.0, 500.0]
    assert {r.threshold for r in df.collect()} == {100.0}


def test_nothing_to_judge(spark):
    for method in anomalies.DEFAULTS:
        df = amounts(spark, [None, None])
        assert anomalies.detect(df, method).count() == 0
        assert anomalies.detect(df.filter("false"), method).count() == 0
    counts = anomalies.counts(amounts(spark, [])).collect()
    assert {r.method: r.anomalies for r in counts} == {"zscore": 0, "iqr": 0, "median": 0}


def test_counts_agree_with_the_rows(spark):
    df = amounts(spark, VALUES)
    counted = {r.method: r.anomalies for r in anomalies.counts(df).collect()}
    assert counted == {m: anomalies.detect(df, m).count() for m in anomalies.DEFAULTS}


def test_explicit_multiplier_is_respected(spark):
    df = amounts(spark, VALUES)
    limit = {r.threshold for r in anomalies.detect(df, "median", multiplier=1.4).collect()}
    assert limit == {28.0}
    with pytest.raises(ValueError):
        anomalies.detect(df, "mad")


def test_top_breaks_ties_by_id(spark):
    df = anomalies.by_median(amounts(spark, [1.0] * 20 + [50.0] * 12))
    ids = [r.transaction_id for r in anomalies.top(df, 3).collect()]
    assert ids == ["TXN_20", "TXN_21", "TXN_22"]
    low = anomalies.low_side(anomalies.by_iqr(amounts(spark, [*VALUES, -300.0])))
    assert [r.total_amount for r in anomalies.top(low, 5, ascending=True).collect()] == [-300.0, -200.0]


@pytest.mark.parametrize(
    "method, extra",
    [("zscore", ["zscore"]), ("iqr", ["lower_bound", "upper_bound"]), ("median", ["threshold"])],
)
def test_export_columns(spark, method, extra):
    df = anomalies.detect(amounts(spark, VALUES), method)
    assert anomalies.export_columns(df).columns == [*COLUMNS, *extra]


def test_one_nonfinite_amount_changes_nothing_else(spark):
    ordinary = [float(k % 10) for k in range(100)]
    for odd in (float("nan"), float("inf")):
        assert anomalies.by_zscore(amounts(spark, [*ordinary, odd])).count() == 0
        found = anomalies.by_zscore(amounts(spark, [*ordinary, 1000.0, odd])).collect()
        assert [r.total_amount for r in found] == [1000.0]


def test_other_amount_column(spark):
    df = amounts(spark, VALUES).select(F.col("total_amount").alias("paid"))
    assert anomalies.by_iqr(df, amount="paid").count() == 3
    assert anomalies.by_zscore(df, amount="paid").count() == 2

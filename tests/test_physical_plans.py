"""What the physical plans must look like to hold on large inputs."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as registry
from tillscope import sinks, sources
from tillscope.operators import anomalies, customers, quality, spending, trends
from tillscope.schema import RAW, TYPED

DIRECTORY = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()


@pytest.fixture
def stored(spark, tmp_path):
    """A typed transaction table in Parquet, so that scans are plain column scans."""
    path = str(tmp_path / "transactions")
    rows = [
        (f"TXN_{i}", None, "00:00:00", f"STD_{i % 7}", "FOO_1", 1, float(i), float(i), "CASH", "Hanoi")
        for i in range(100)
    ]
    spark.createDataFrame(rows, TYPED).write.parquet(path)
    return sources.read_processed(spark, path)


@pytest.mark.parametrize("name", sorted(registry._own_queries()))
def test_no_query_multiplies_rows(spark, name):
    text = plan(registry._own_queries()[name](spark, DIRECTORY))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text
    assert not re.search("EvalPython|InPandas|InArrow", text)


def scanned(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*)>", text)]


def test_scans_read_only_used_columns(stored):
    assert scanned(plan(spending.weekly(stored))) == [
        {"transaction_date", "customer_id", "total_amount"}
    ]
    assert scanned(plan(customers.customer_metrics(stored))) == [
        {"transaction_id", "customer_id", "product_id", "total_amount"}
    ]
    assert scanned(plan(trends.declining(stored))) == [
        {"transaction_id", "transaction_date", "customer_id"}
    ]
    assert scanned(plan(anomalies.moments(stored))) == [{"total_amount"}]


def test_bounds_reach_the_scan(stored):
    assert "GreaterThan(total_amount," in plan(anomalies.by_median(stored))
    text = plan(anomalies.by_iqr(stored))
    assert "Or(LessThan(total_amount," in text and "GreaterThan(total_amount," in text


def test_statistics_are_computed_once(stored):
    df = anomalies.by_zscore(stored)
    df.collect()
    text = plan(df, "simple")
    assert "mergedValue" in text


def test_spending_combines_before_the_shuffle(stored):
    text = plan(spending.weekly(stored))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1
    assert "partial_sum(total_amount" in text


def test_distinct_products_spread_a_dominant_customer(stored):
    text = plan(customers.customer_metrics(stored))
    assert "Expand" not in text
    arguments = re.findall(r"Arguments: hashpartitioning\((.*?), \d+\)", text)
    assert sorted(a.count("#") for a in arguments) == [1, 2]
    assert "partial_count(transaction_id" in text and "partial_sum(total_amount" in text


@pytest.mark.parametrize("form", [trends.declining, trends.declining_sql])
def test_trend_keeps_three_months_before_the_shuffle(stored, form):
    text = plan(form(stored))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2
    assert len(re.findall(r"^\(\d+\) WindowGroupLimit", text, re.M)) == 2
    # One sort before and one after the shuffle serve all windows.
    assert len(re.findall(r"^\(\d+\) Sort", text, re.M)) == 2


def test_top_is_not_a_global_sort(stored):
    text = plan(anomalies.top(anomalies.by_median(stored), 3))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_validation_does_not_shuffle(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([tuple("1" * 10)], RAW).write.option("header", True).csv(path)
    raw = sources.read_raw(spark, path)
    flagged = quality.flag(raw, quality.error_condition("STD_1"))
    for df in (*quality.split(flagged), quality.enforce_types(raw)):
        assert "Exchange" not in plan(df)
    assert "SinglePartition" in plan(quality.summary(flagged))


def test_split_is_read_by_partition(spark, tmp_path):
    path = str(tmp_path / "split")
    raw = spark.createDataFrame([tuple("1" * 10)], RAW)
    sinks.write_validated(quality.flag(raw, quality.error_condition("STD_1")), path)
    assert "PartitionFilters: [isnotnull(outcome" in plan(sinks.read_clean(spark, path))

"""Sources, sinks and the end-to-end analyses."""

import csv
from datetime import date

import pytest

from tests.rows import CUSTOMER, GOOD, raw, sales
from tests.test_trends import months
from tillscope import plans, sinks, sources
from tillscope.operators import quality, segments
from tillscope.schema import COLUMNS, RAW_WITH_MALFORMED, TYPED

CHANGES = [
    {},
    {"quantity": "4", "total_amount": "1"},
    {"quantity": "5a"},
    {"total_amount": "31.5€"},
    {"customer_id": " " + CUSTOMER},
    {"customer_id": None},
    {"payment_method": "", "store_location": " Hanoi"},
]


@pytest.fixture
def raw_file(tmp_path):
    path = tmp_path / "raw.csv"
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, COLUMNS)
        writer.writeheader()
        for i, change in enumerate(CHANGES):
            writer.writerow(GOOD | {"transaction_id": f"TXN_{i}"} | change)
    return str(path)


def test_raw_text_is_untouched(spark, raw_file):
    df = sources.read_raw(spark, raw_file)
    assert df.schema == RAW_WITH_MALFORMED
    rows = {r.transaction_id: r for r in df.collect()}
    assert rows["TXN_0"].transaction_time == "12:34:56"
    assert rows["TXN_4"].customer_id == " " + CUSTOMER
    assert rows["TXN_5"].customer_id is None
    assert rows["TXN_3"].total_amount == "31.5€"


def test_unexpected_header_is_refused(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text(",".join(reversed(COLUMNS)) + "\n" + ",".join("x" * 10) + "\n")
    with pytest.raises(Exception):
        sources.read_raw(spark, str(path)).collect()


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
@pytest.mark.parametrize("policy, rejected", [("error", 4), ("drop", 3)])
def test_preprocess(spark, raw_file, tmp_path, fmt, policy, rejected):
    output = str(tmp_path / "split")
    summary = plans.preprocess(
        spark, raw_file, output, expected_customer=CUSTOMER, on_null_flag=policy, fmt=fmt
    )
    row = summary.first()
    assert (row.clean_rows, row.error_rows) == (3, rejected)
    assert row.error_rate_pct == pytest.approx(rejected / (3 + rejected) * 100)

    clean = sinks.read_clean(spark, output, fmt)
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in TYPED]
    flagged = quality.flag(
        sources.read_raw(spark, raw_file), quality.error_condition(CUSTOMER), on_null_flag=policy
    )
    expected = quality.repair_totals(quality.enforce_types(quality.clean_rows(flagged)))
    assert sorted(clean.collect()) == sorted(expected.collect())
    first = clean.filter("transaction_id = 'TXN_1'").first()
    assert (first.transaction_date, first.total_amount) == (date(2023, 5, 6), 42.0)

    bad = sinks.read_rejected(spark, output, fmt)
    assert [(f.name, f.dataType) for f in bad.schema] == [(f.name, f.dataType) for f in RAW_WITH_MALFORMED]
    assert {tuple(r) for r in bad.collect()} == {
        tuple(r) for r in quality.rejected_rows(flagged).collect()
    }


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_ragged_lines_are_rejected_whole(spark, raw_file, tmp_path, fmt):
    good = ",".join((GOOD | {"transaction_id": "TXN_9"}).values())
    nine, eleven = good.rpartition(",")[0], good + ",extra"
    with open(raw_file, "a") as out:
        out.write("".join(line + "\n" for line in (nine, eleven, good)))
    output = str(tmp_path / "split")
    row = plans.preprocess(spark, raw_file, output, expected_customer=CUSTOMER, fmt=fmt).first()
    assert (row.clean_rows, row.error_rows) == (4, 6)
    bad = sinks.read_rejected(spark, output, fmt).filter("malformed_record IS NOT NULL").collect()
    assert sorted(r.malformed_record for r in bad) == sorted([nine, eleven])
    assert sinks.read_clean(spark, output, fmt).count() == 4


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_split_without_rejected_rows(spark, tmp_path, fmt):
    output = str(tmp_path / "split")
    flagged = quality.flag(raw(spark, {}), quality.error_condition(CUSTOMER))
    sinks.write_validated(flagged, output, fmt)
    assert sinks.read_clean(spark, output, fmt).count() == 1
    assert sinks.read_rejected(spark, output, fmt).count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_processed_files(spark, tmp_path, fmt):
    df = sales(spark, [("a", "2024-01-01", 1.25), ("b", "2024-02-01", 2.5)])
    output = str(tmp_path / "out")
    sinks.write_table(df.repartition(3), output, fmt)
    again = sources.read_processed(spark, output, fmt)
    assert again.dtypes == df.dtypes
    assert sorted(again.collect()) == sorted(df.collect())
    sinks.write_table(df.limit(1), output, fmt)
    assert sources.read_processed(spark, output, fmt).count() == 1


def test_registered_name(spark):
    sources.register(sales(spark, [("a", "2024-01-01", 1.0)]))
    assert spark.sql("SELECT count(*) FROM transactions").first()[0] == 1
    spark.catalog.dropTempView("transactions")


def shopping(spark):
    return sales(
        spark,
        months("a", [("2024-01", 9), ("2024-02", 5), ("2024-03", 2)])
        + months("b", [("2024-01", 1), ("2024-02", 5), ("2024-03", 7)])
        + [("c", "2024-01-01", 900.0, "ELE_1")] * 3,
    )


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_weekly_report(spark, tmp_path, fmt):
    report = plans.analyze_weekly_spending(
        shopping(spark), str(tmp_path / "weekly"), ordered=True, fmt=fmt
    )
    keys = [(r.customer_id, r.year, r.week) for r in report.weekly.collect()]
    assert keys == sorted(keys) and report.weekly.dtypes[-1] == ("weekly_spending", "double")
    assert sum(r["count"] for r in report.histogram.collect()) == report.active_weeks.count() == 3


def test_segment_report(spark, tmp_path):
    report = plans.analyze_segments(shopping(spark), str(tmp_path / "segments"))
    assert report.status == segments.SCALED
    assert report.customers.columns[-1] == "prediction"
    assert sum(r.customer_count for r in report.profile.collect()) == 3
    assert report.statistics.count() == 3 and report.tails is None
    assert report.nulls.first().total_spending == 0


def test_segment_report_of_one_customer(spark, tmp_path):
    one = sales(spark, months("a", [("2024-01", 4)]))
    report = plans.analyze_segments(one, str(tmp_path / "metrics"), fmt="csv")
    assert report.status == segments.METRICS_ONLY
    assert [tuple(r) for r in report.customers.collect()] == [("a", 4, 4.0, 1)]
    assert report.profile is None and report.scores.count() == report.centers.count() == 0
    assert {r.metric: r.p50 for r in report.tails.collect()}["total_orders"] == 4.0


def test_declining_report(spark, tmp_path):
    df = plans.analyze_declining_customers(shopping(spark), str(tmp_path / "declining"), fmt="csv")
    assert [tuple(r) for r in df.collect()] == [("a", 2024, 3, 2, 5, 9)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
@pytest.mark.parametrize("method, n", [("zscore", 1), ("iqr", 2), ("median", 1)])
def test_anomaly_report(spark, tmp_path, fmt, method, n):
    values = [float(v) for v in range(10, 31)] * 3 + [-60.0, 900.0]
    df = sales(spark, [("a", "2024-01-01", v) for v in values])
    report = plans.detect_anomalies(df, str(tmp_path / "suspects"), method, fmt=fmt)
    assert report.count.first().anomalies == report.suspects.count() == n
    assert [r.total_amount for r in report.highest.collect()] == [900.0]
    if method == "iqr":
        assert [r.total_amount for r in report.lowest.collect()] == [-60.0]
    else:
        assert report.lowest is None

from tests.rows import sales
from tillscope.operators import trends


def months(customer, counts):
    """Rows for (year-month, number of orders) pairs."""
    return [(customer, f"{month}-{i % 28 + 1:02d}", 1.0) for month, n in counts for i in range(n)]


def data(spark):
    return sales(
        spark,
        months("falls", [("2024-07", 9), ("2024-08", 5), ("2024-09", 4), ("2024-10", 3)])
        + months("gap", [("2024-01", 3), ("2024-05", 2), ("2024-09", 1)])
        + months("turns", [("2023-11", 3), ("2023-12", 2), ("2024-01", 1)])
        + months("ties", [("2024-01", 3), ("2024-02", 3), ("2024-03", 2)])
        + months("rises", [("2024-01", 1), ("2024-02", 2), ("2024-03", 3)])
        + months("older", [("2024-01", 9), ("2024-02", 5), ("2024-03", 1), ("2024-04", 2)])
        + months("short", [("2024-01", 5), ("2024-02", 1)]),
    )


def test_declining_customers(spark):
    found = trends.saved(trends.declining(data(spark)))
    assert found.columns == trends.SAVED_COLUMNS
    assert sorted(tuple(r) for r in found.collect()) == [
        ("falls", 2024, 10, 3, 4, 5),
        ("gap", 2024, 9, 1, 2, 3),
        ("turns", 2024, 1, 1, 2, 3),
    ]


def test_report_and_sql_agree(spark):
    df = data(spark)
    report = trends.report(trends.declining(df), ordered=True)
    expected = [
        ("falls", "2024-10", 3, 1),
        ("gap", "2024-9", 1, 1),
        ("turns", "2024-1", 1, 1),
    ]
    assert [tuple(r) for r in report.collect()] == expected
    sql = trends.declining_sql(df, ordered=True)
    assert sql.dtypes == report.dtypes
    assert [tuple(r) for r in sql.collect()] == expected
    assert trends.declining_count(trends.declining(df)).first()[0] == 3


def test_previous_months_stop_at_the_third(spark):
    ranked = trends.rank_months(trends.monthly_orders(data(spark)))
    rows = {
        r.month: (r.month_rank, r.prev_month_orders, r.prev_prev_month_orders)
        for r in trends.last_three_months(ranked).collect()
        if r.customer_id == "falls"
    }
    assert rows == {10: (1, 4, 5), 9: (2, 5, None), 8: (3, None, None)}


def test_rows_without_transaction_id_do_not_count(spark):
    df = sales(spark, months("a", [("2024-01", 3)]))
    df = df.withColumn("transaction_id", df.transaction_id.substr(1, 0).try_cast("int").cast("string"))
    assert [r.order_count for r in trends.monthly_orders(df).collect()] == [0]

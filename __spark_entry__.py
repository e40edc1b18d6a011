"""Registered queries with their SQL counterparts.

``entry`` runs the flagship query, ``queries`` maps each name to a callable of (spark, directory), and
``oracle_sql`` gives the equivalent SQL over the same tables wherever the result is deterministic.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillscope.operators import (  # noqa: E402
    anomalies,
    customers,
    exact,
    ladder,
    lloyd,
    ordering,
    profiling,
    quality,
    quantiles,
    segments,
    sketches,
    spending,
    trends,
)
from tillscope import plans, sinks  # noqa: E402
from tillscope.schema import COLUMNS, METRICS  # noqa: E402
from tillscope.sources.star import (  # noqa: E402
    damaged_transactions,
    event_amounts,
    sales,
    table,
)

try:  # the only place that allows for a library without the training-data package
    import corpus_pipeline
    from tillscope.llm import registry as llm
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "tillscope.llm"):
        raise
    llm = None

SMALL_REACH = 0.2  # IQR multiplier that gives the event amounts a low side
METRIC_TYPES = {"total_orders": "bigint", "total_spending": "double", "unique_products": "bigint"}
APART = {"total_orders": 100_000, "total_spending": 1e9, "unique_products": 100_000}
SKETCH_ACCURACY = 500
QUANTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def entry(spark: SparkSession) -> DataFrame:
    return _declining(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | _llm_queries()


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else {}


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # validation
        "valid_rows": lambda s, d: quality.clean_rows(_flagged(s, d)),
        "rejected_rows": lambda s, d: quality.rejected_rows(_flagged(s, d)),
        "rejected_rows_null_dropped": lambda s, d: quality.rejected_rows(_flagged(s, d, "drop")),
        "unflagged_rows": lambda s, d: quality.unflagged_rows(_flagged(s, d, "drop")),
        "validation_rule_counts": lambda s, d: quality.rule_counts(
            damaged_transactions(s, d), quality.rules(F.col("expected_customer"))
        ),
        "quality_summary": lambda s, d: quality.summary(_flagged(s, d)),
        "typed_transactions": _typed,
        "repaired_totals": lambda s, d: quality.repair_totals(_typed(s, d)),
        # spending
        "weekly_spending": lambda s, d: _rounded(
            spending.weekly(sales(s, d)), "weekly_spending", 2
        ),
        "weekly_spending_iso": lambda s, d: _rounded(
            spending.weekly(sales(s, d), "iso"), "weekly_spending", 2
        ),
        "active_weeks": lambda s, d: spending.active_weeks(spending.weekly(sales(s, d))),
        "activity_histogram": lambda s, d: spending.activity_histogram(
            spending.active_weeks(spending.weekly(sales(s, d))), ordered=True
        ),
        # customer metrics and profiling
        "customer_metrics": lambda s, d: _rounded(_metrics(s, d), "total_spending", 2),
        "metrics_null_profile": lambda s, d: profiling.null_profile(_damaged_metrics(s, d)),
        "metrics_null_loss": lambda s, d: profiling.null_loss(_damaged_metrics(s, d)),
        "metrics_without_nulls": lambda s, d: _rounded(
            customers.complete_metrics(_damaged_metrics(s, d)), "total_spending", 2
        ),
        "metrics_describe": lambda s, d: _rounded(
            profiling.describe_numeric(_metrics(s, d), METRICS), ["mean", "stddev", "min", "max"], 2
        ),
        "metrics_tail_percentiles": lambda s, d: _rounded(
            profiling.tail_percentiles(_metrics(s, d), METRICS),
            ["min", *profiling.TAILS, "max"],
            2,
        ),
        "amount_summary": lambda s, d: _rounded(
            profiling.summary_numeric(event_amounts(s, d), ["total_amount"]), ["mean", "stddev"], 6
        ),
        # segments
        "scaled_metrics": lambda s, d: _rounded(
            segments.scaled_metrics(_metrics(s, d)),
            [f"scaled_{c}" for c in METRICS],
            6,
        ),
        "silhouette_fixed_labels": _silhouette,
        "cluster_profile_fixed_labels": lambda s, d: _rounded(
            segments.cluster_profile(_labelled(s, d)), "sum_spending", 2
        ),
        "cluster_profile_detailed_fixed_labels": lambda s, d: _rounded(
            _rounded(
                segments.cluster_profile(_labelled(s, d), detailed=True), "sum_spending", 2
            ),
            ["avg_orders", "avg_spending", "avg_products"],
            4,
        ),
        "separated_clusters": lambda s, d: _rounded(
            segments.segment(_separated(s, d)).customers, "total_spending", 2
        ),
        "separated_centers": _separated_centers,
        "separated_choice": lambda s, d: segments.score_table(segments.segment(_separated(s, d)))
        .filter("chosen")
        .select("k"),
        "segment_ladder": lambda s, d: ladder.rungs(_cases(s, d), "case_name"),
        "k_selection": lambda s, d: _rounded(segments.score_table(_segments(s, d)), ["silhouette", "cost"], 6),
        "customer_clusters": lambda s, d: _rounded(_segments(s, d).customers, "total_spending", 2),
        "cluster_centers": lambda s, d: _rounded(
            segments.center_table(_segments(s, d)), [f"{x}center_{c}" for x in ("", "scaled_") for c in METRICS], 4
        ),
        "cluster_profile": lambda s, d: _rounded(segments.cluster_profile(_segments(s, d).customers), "sum_spending", 2),
        "cluster_profile_detailed": lambda s, d: _rounded(
            _rounded(segments.cluster_profile(_segments(s, d).customers, detailed=True), "sum_spending", 2),
            ["avg_orders", "avg_spending", "avg_products"],
            4,
        ),
        # trends
        "monthly_orders": lambda s, d: trends.monthly_orders(sales(s, d)),
        "month_rank": lambda s, d: trends.rank_months(trends.monthly_orders(sales(s, d))),
        "last_three_months": lambda s, d: trends.last_three_months(
            trends.rank_months(trends.monthly_orders(sales(s, d)))
        ),
        "declining_customers_df": _declining,
        "declining_customers_sql": lambda s, d: trends.declining_sql(sales(s, d)),
        "declining_customers_saved": lambda s, d: trends.saved(trends.declining(sales(s, d))),
        "declining_count": lambda s, d: trends.declining_count(trends.declining(sales(s, d))),
        # anomalies
        "amount_moments": lambda s, d: _rounded(
            anomalies.moments(event_amounts(s, d)), ["mean", "stddev"], 6
        ),
        "amount_quartiles": _quartiles,
        "amount_median": _median,
        "amount_quantiles_narrowed": _narrowed_quantiles,
        "zscores": lambda s, d: _rounded(
            anomalies.zscores(event_amounts(s, d)).select("transaction_id", "zscore"), "zscore", 6
        ),
        "anomalies_zscore": lambda s, d: _rounded(
            anomalies.by_zscore(event_amounts(s, d)), "zscore", 6
        ),
        "anomalies_iqr": lambda s, d: _round_bounds(anomalies.by_iqr(event_amounts(s, d))),
        "iqr_high": lambda s, d: _round_bounds(
            anomalies.high_side(anomalies.by_iqr(event_amounts(s, d)))
        ),
        "iqr_low": lambda s, d: _round_bounds(
            anomalies.low_side(anomalies.by_iqr(event_amounts(s, d), SMALL_REACH))
        ),
        "anomalies_median": lambda s, d: _rounded(
            anomalies.by_median(event_amounts(s, d)), "threshold", 6
        ),
        "anomaly_counts": lambda s, d: anomalies.counts(event_amounts(s, d)),
        "top_zscore": lambda s, d: _rounded(
            anomalies.top(
                anomalies.by_zscore(event_amounts(s, d)), 10, "zscore", extra=["zscore"]
            ),
            "zscore",
            6,
        ),
        "top_iqr_high": lambda s, d: anomalies.top(
            anomalies.high_side(anomalies.by_iqr(event_amounts(s, d))), 5
        ),
        "top_iqr_low": lambda s, d: anomalies.top(
            anomalies.low_side(anomalies.by_iqr(event_amounts(s, d), SMALL_REACH)),
            5,
            ascending=True,
        ),
        "top_median": lambda s, d: _rounded(
            anomalies.top(anomalies.by_median(event_amounts(s, d)), 10, extra=["threshold"]),
            "threshold",
            6,
        ),
        "anomaly_export_zscore": lambda s, d: _rounded(_export(s, d, "zscore"), "zscore", 6),
        "anomaly_export_iqr": lambda s, d: _round_bounds(_export(s, d, "iqr")),
        "anomaly_export_median": lambda s, d: _rounded(_export(s, d, "median"), "threshold", 6),
        # stored summaries and exact sums
        "daily_amount_sketches": lambda s, d: sketches.amount_sketches(event_amounts(s, d), ["transaction_date"]).select(
            "transaction_date", "n", sketches.quantile(0).alias("low"), sketches.quantile(1).alias("high")
        ),
        "sketched_quantiles": _sketched_quantiles,
        "merged_customer_products": _merged_customer_products,
        "weekly_spending_exact": lambda s, d: _plain_decimals(exact.weekly(sales(s, d)), "weekly_spending"),
        "amount_moments_exact": lambda s, d: exact.moments(
            exact.added(exact.power_sums(event_amounts(s, d), ["transaction_date"]))
        ),
        "customer_moments_exact": lambda s, d: exact.moments(exact.power_sums(sales(s, d), ["customer_id"]), ["customer_id"]),
        # written results, read back
        "written_clean_rows": lambda s, d: sinks.read_clean(s, _written_split(s, d)),
        "written_rejected_rows": lambda s, d: sinks.read_rejected(s, _written_split(s, d)).select(*COLUMNS),
        "written_weekly_spending": lambda s, d: _rounded(
            plans.analyze_weekly_spending(sales(s, d), sinks.new_folder(s), ordered=True).weekly, "weekly_spending", 2
        ),
        "written_declining_customers": lambda s, d: plans.analyze_declining_customers(sales(s, d), sinks.new_folder(s)),
        "published_weekly_spending": _published_weekly,
        "ordered_outputs": _ordered_outputs,
        "incremental_clean_rows": lambda s, d: plans.all_clean(s, _taken_in_steps(s, d)),
        "incremental_summary": lambda s, d: plans.summary(s, _taken_in_steps(s, d)),
    }


def _flagged(spark: SparkSession, directory: str, on_null_flag: str = "error") -> DataFrame:
    condition = quality.error_condition(F.col("expected_customer"))
    return quality.flag(damaged_transactions(spark, directory), condition, on_null_flag)


def _typed(spark: SparkSession, directory: str) -> DataFrame:
    return quality.enforce_types(quality.clean_rows(_flagged(spark, directory)))


def _metrics(spark: SparkSession, directory: str) -> DataFrame:
    return customers.customer_metrics(sales(spark, directory))


def _segments(spark: SparkSession, directory: str) -> segments.Segmentation:
    return lloyd.segment(_metrics(spark, directory))


def _cases(spark: SparkSession, directory: str) -> DataFrame:
    """Sets of customers made from the same metrics, from plain ones to such that cannot be clustered."""
    metrics = _metrics(spark, directory)
    first = metrics.agg(F.min("customer_id").alias("m")).scalar()
    orders, products = F.col("total_orders").cast("double"), F.col("unique_products").cast("double")
    spending, one = F.round("total_spending", 2), F.lit(1.0)
    alone = F.col("customer_id") == first
    made = {
        "as_they_are": (orders, spending, products),
        "one_customer": (orders, spending, products),
        "equal_points": (one, one, one),
        "two_points": (orders % 2, one, one),
        "one_infinite": (orders, F.when(alone, float("inf")).otherwise(spending), products),
        "one_null": (orders, F.when(~alone, spending), products),
        "all_null": (orders, F.lit(None).cast("double"), products),
        "beyond_scaling": (orders, spending * 1e200, products),
    }
    sets = [
        F.struct(F.lit(name).alias("case_name"), *[v.alias(c) for c, v in zip(METRICS, values)])
        for name, values in made.items()
    ]
    return metrics.select("customer_id", alone.alias("alone"), F.inline(F.array(*sets))).filter(
        "case_name <> 'one_customer' OR alone"
    )


def _separated(spark: SparkSession, directory: str) -> DataFrame:
    """Metrics moved apart by the customer number, so that three groups are the only good clustering."""
    group = F.substring_index("customer_id", "_", -1).cast("int") % 3
    return _metrics(spark, directory).withColumns(
        {c: F.col(c) + group.cast(t) * APART[c] for c, t in METRIC_TYPES.items()}
    )


def _separated_centers(spark: SparkSession, directory: str) -> DataFrame:
    centers = segments.center_table(segments.segment(_separated(spark, directory)))
    return centers.select("prediction", *[F.round(f"center_{c}", 2).alias(f"center_{c}") for c in METRICS])


def _damaged_metrics(spark: SparkSession, directory: str) -> DataFrame:
    """Metrics of rows that were typed but not validated, so that they contain NULLs."""
    return customers.customer_metrics(
        quality.enforce_types(damaged_transactions(spark, directory))
    )


def _labelled(spark: SparkSession, directory: str) -> DataFrame:
    """Metrics with a label that does not depend on a fit: every tenth order starts a new cluster."""
    label = F.floor(F.col("total_orders") / 10).cast("int")
    return _metrics(spark, directory).withColumn(segments.LABEL, label)


def _silhouette(spark: SparkSession, directory: str) -> DataFrame:
    orders = table(spark, directory, "orders").select(
        (F.col("o_totalprice") / 100000).alias("price"),
        F.dayofmonth("o_orderdate").cast("double").alias("day"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("label"),
    )
    score = segments.silhouette(orders, ["price", "day"], "label")
    return spark.createDataFrame([(round(score, 6),)], "silhouette double")


def _declining(spark: SparkSession, directory: str) -> DataFrame:
    return trends.report(trends.declining(sales(spark, directory)))


def _quartiles(spark: SparkSession, directory: str) -> DataFrame:
    found = anomalies.quartiles(event_amounts(spark, directory))
    lower, upper = found.bounds()
    quartiles = spark.createDataFrame(
        [(found.q1, found.median, found.q3)], "q1 double, median double, q3 double"
    )
    return _round_bounds(
        quartiles.withColumns(
            {
                "iqr": F.round(F.col("q3") - F.col("q1"), 6),
                "lower_bound": lower,
                "upper_bound": upper,
            }
        )
    )


def _median(spark: SparkSession, directory: str) -> DataFrame:
    found = anomalies.median(event_amounts(spark, directory))
    return spark.createDataFrame([(found.median,)], "median double")


def _narrowed_quantiles(spark: SparkSession, directory: str) -> DataFrame:
    """The form for inputs of any size, whatever the size of this one."""
    found = quantiles.quantiles(event_amounts(spark, directory), ["total_amount"], QUANTILES)
    return spark.createDataFrame(
        list(found["total_amount"].items()), "probability double, value double"
    )


def _sketched_quantiles(spark: SparkSession, directory: str) -> DataFrame:
    """Quantiles of days' sketches, between the exact values as far below and above as the accuracy allows."""
    amounts = event_amounts(spark, directory)
    whole = sketches.merged(sketches.amount_sketches(amounts, ["transaction_date"], accuracy=SKETCH_ACCURACY))
    reach = 1 / SKETCH_ACCURACY
    ends = {p: (round(p - reach, 9), round(p + reach, 9)) for p in QUANTILES}
    known = quantiles.quantiles(amounts, ["total_amount"], sorted({e for pair in ends.values() for e in pair}))["total_amount"]
    rows = spark.createDataFrame([(p, known[a], known[b]) for p, (a, b) in ends.items()], "probability double, low double, high double")
    found = whole.select("n", F.explode(F.array(*[F.struct(F.lit(p).alias("probability"), sketches.quantile(p).alias("value")) for p in QUANTILES])))
    return found.select("n", "col.*").join(rows, "probability").select("probability", "n", "low", "high", F.col("value").between(F.col("low"), F.col("high")).alias("inside"))


def _merged_customer_products(spark: SparkSession, directory: str) -> DataFrame:
    """Orders from stored months, and whether the merged distinct count is within four standard errors of the exact one."""
    rows = sales(spark, directory)
    totals = sketches.customer_totals(sketches.customer_periods(rows, F.trunc("transaction_date", "month")))
    known = customers.customer_metrics(rows).select("customer_id", F.col("unique_products").alias("known"))
    allowed = F.col("known") * F.lit(4 * sketches.distinct_error())
    near = F.abs(F.col("unique_products") - F.col("known")) <= allowed
    return totals.join(known, "customer_id").select("customer_id", "total_orders", F.col("known").alias("unique_products"), near.alias("near"))


def _written_split(spark: SparkSession, directory: str) -> str:
    path = sinks.new_folder(spark)
    sinks.write_validated(_flagged(spark, directory), path)
    return path


def _taken_in_steps(spark: SparkSession, directory: str) -> str:
    """Raw files that come in two lots, each validated when it is there."""
    raw, output, rows = sinks.new_folder(spark), sinks.new_folder(spark), damaged_transactions(spark, directory)
    first = F.crc32(F.col("transaction_id").cast("binary")) % 2 == 0
    for some in (first, ~first):
        sinks.write_table(rows.filter(some).select(*COLUMNS), raw, "csv", mode="append")
        plans.preprocess_new(spark, f"{raw}/*.csv", output)
    return output


def _published_weekly(spark: SparkSession, directory: str) -> DataFrame:
    """Years published with sums of doubled amounts, then each second year anew, then the others, with the right ones."""
    path, rows = sinks.new_folder(spark), sales(spark, directory)
    even = F.year("transaction_date") % 2 == 0
    doubled = rows.withColumn("total_amount", F.col("total_amount") * 2)
    for some in (doubled, rows.filter(even), rows.filter(~even)):
        sinks.publish(spending.weekly(some), path, "year")
    return _rounded(sinks.read_published(spark, path), "weekly_spending", 2)


def _ordered_outputs(spark: SparkSession, directory: str) -> DataFrame:
    """Rows and inversions of every result that is written in order."""
    rows, found = sales(spark, directory), None
    weeks = spending.weekly(rows)
    for name, df, order in (
        ("weekly", weeks.orderBy("customer_id", "year", "week"), ["customer_id", "year", "week"]),
        ("histogram", spending.activity_histogram(spending.active_weeks(weeks), ordered=True), ["weeks_with_transactions"]),
        ("declining", trends.report(trends.declining(rows), ordered=True), ["customer_id"]),
        ("declining_sql", trends.declining_sql(rows, ordered=True), ["customer_id"]),
        ("profile", segments.cluster_profile(_labelled(spark, directory), ordered=True), [segments.LABEL]),
    ):
        checked = ordering.inversions(sinks.store(df, sinks.new_folder(spark)), order)
        checked = checked.select(F.lit(name).alias("output"), "rows", "inversions")
        found = checked if found is None else found.union(checked)
    return found


def _plain_decimals(df: DataFrame, column: str) -> DataFrame:
    """Whole cents: decimals of engines differ in precision."""
    return df.withColumn(column, (F.col(column) * 100).cast("bigint"))


def _export(spark: SparkSession, directory: str, method: str) -> DataFrame:
    return anomalies.export_columns(anomalies.detect(event_amounts(spark, directory), method))


def _rounded(df: DataFrame, columns: str | list[str], digits: int) -> DataFrame:
    """Float sums depend on the order of addition in the last digits, in both engines."""
    names = [columns] if isinstance(columns, str) else columns
    return df.withColumns({c: F.round(c, digits) for c in names})


def _round_bounds(df: DataFrame) -> DataFrame:
    return _rounded(df, ["lower_bound", "upper_bound"], 6)


# --- SQL counterparts ---------------------------------------------------------------------------

_SALES = """
    SELECT 'TXN_' || l_orderkey || '_' || l_linenumber AS transaction_id,
           CAST(o_orderdate AS DATE) AS transaction_date,
           'STD_' || o_custkey AS customer_id,
           'PRT_' || l_partkey AS product_id,
           l_extendedprice AS total_amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

_EVENTS = """
    SELECT 'TXN_' || event_id AS transaction_id, CAST(ts AS DATE) AS transaction_date,
           strftime(ts, '%H:%M:%S') AS transaction_time, 'STD_' || user_id AS customer_id,
           event_type AS product_id, 1 AS quantity, value AS unit_price, value AS total_amount,
           'CASH' AS payment_method, 'Hanoi' AS store_location
    FROM events
"""

_DAMAGED = """
    SELECT transaction_id,
           CASE WHEN k % 97 = 0 THEN NULL WHEN k % 101 = 0 THEN '2023-13-45'
                ELSE day END AS transaction_date,
           '00:00:00' AS transaction_time,
           CASE WHEN k % 23 = 0 THEN NULL WHEN k % 29 = 0 THEN ' ' || customer
                ELSE customer END AS customer_id,
           product_id,
           CASE WHEN k % 11 = 0 THEN qty || 'a' WHEN k % 13 = 0 THEN '-' || qty
                ELSE qty END AS quantity,
           CASE WHEN k % 89 = 0 THEN '0' ELSE price END AS unit_price,
           CASE WHEN k % 17 = 0 THEN total || '$' WHEN k % 19 = 0 THEN NULL
                ELSE total END AS total_amount,
           payment_method, store_location, customer AS expected_customer
    FROM (
        SELECT l_orderkey AS k, 'TXN_' || l_orderkey || '_' || l_linenumber AS transaction_id,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
               'STD_' || o_custkey AS customer, 'PRT_' || l_partkey AS product_id,
               CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qty,
               CAST(p_retailprice AS VARCHAR) AS price, CAST(l_extendedprice AS VARCHAR) AS total,
               o_orderpriority AS payment_method, n_name AS store_location
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
             JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    )
"""

_BROKEN = {
    "date_missing": "try_strptime(transaction_date, '%Y-%m-%d') IS NULL",
    "quantity_not_integer": "TRY_CAST(quantity AS INTEGER) IS NULL",
    "quantity_negative": "TRY_CAST(quantity AS INTEGER) < 0",
    "price_not_numeric": "TRY_CAST(unit_price AS DOUBLE) IS NULL",
    "price_not_positive": "TRY_CAST(unit_price AS DOUBLE) <= 0",
    "total_not_numeric": "TRY_CAST(total_amount AS DOUBLE) IS NULL",
    "wrong_customer": "customer_id <> expected_customer",
}
_ANY_BROKEN = " OR ".join(_BROKEN.values())

_TYPED_COLUMNS = """
    transaction_id, CAST(try_strptime(transaction_date, '%Y-%m-%d') AS DATE) AS transaction_date,
    transaction_time, customer_id, product_id, TRY_CAST(quantity AS INTEGER) AS quantity,
    TRY_CAST(unit_price AS DOUBLE) AS unit_price, TRY_CAST(total_amount AS DOUBLE) AS total_amount,
    payment_method, store_location
"""

_METRICS_OF = """
    SELECT customer_id, count(transaction_id) AS total_orders, sum(total_amount) AS total_spending,
           count(DISTINCT product_id) AS unique_products
    FROM {source} GROUP BY customer_id
"""

_WEEKLY = """
    SELECT customer_id, CAST({year} AS INTEGER) AS year,
           CAST(week(transaction_date) AS INTEGER) AS week, sum(total_amount) AS weekly_spending
    FROM tx GROUP BY 1, 2, 3
"""

_MONTHLY = """
    SELECT customer_id, CAST(year(transaction_date) AS INTEGER) AS year,
           CAST(month(transaction_date) AS INTEGER) AS month, count(transaction_id) AS order_count
    FROM tx GROUP BY 1, 2, 3
"""

_RANKED = """
    SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY year DESC, month DESC)
                   AS INTEGER) AS month_rank
    FROM monthly
"""

_LAST_THREE = """
    SELECT *, lag(order_count, 1) OVER (PARTITION BY customer_id ORDER BY year, month)
                  AS prev_month_orders,
           lag(order_count, 2) OVER (PARTITION BY customer_id ORDER BY year, month)
                  AS prev_prev_month_orders
    FROM ranked WHERE month_rank <= 3
"""

_DECLINING = """
    SELECT * FROM last_three
    WHERE month_rank = 1 AND order_count < prev_month_orders
      AND prev_month_orders < prev_prev_month_orders
"""

_BOUNDS = """
    SELECT q1, median, q3, q3 - q1 AS iqr,
           q1 - {reach} * (q3 - q1) AS lower_bound, q3 + {reach} * (q3 - q1) AS upper_bound
    FROM (SELECT quantile_disc(total_amount, 0.25) AS q1, quantile_disc(total_amount, 0.5) AS median,
                 quantile_disc(total_amount, 0.75) AS q3 FROM ev)
"""

_TEN = """
    transaction_id, transaction_date, transaction_time, customer_id, product_id, quantity, unit_price,
    total_amount, payment_method, store_location
"""
_SHOWN = "transaction_id, transaction_date, customer_id, total_amount"
_OUTSIDE = "(total_amount < lower_bound OR total_amount > upper_bound)"
_ROUNDED_BOUNDS = "round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound"


def _with(body: str, **tables: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({sql})" for n, sql in tables.items()) + " " + body


def _on_damaged(body: str) -> str:
    broken = f"SELECT *, ({_ANY_BROKEN}) AS broken FROM raw"
    return _with(body, raw=_DAMAGED, flagged=broken)


def _on_weekly(body: str, year: str = "year(transaction_date)") -> str:
    return _with(body, tx=_SALES, weekly=_WEEKLY.format(year=year))


def _on_metrics(body: str) -> str:
    return _with(body, tx=_SALES, metrics=_METRICS_OF.format(source="tx"))


def _on_damaged_metrics(body: str) -> str:
    typed = f"SELECT {_TYPED_COLUMNS} FROM raw"
    return _with(body, raw=_DAMAGED, tx=typed, metrics=_METRICS_OF.format(source="tx"))


def _on_labelled(body: str) -> str:
    labelled = "SELECT *, CAST(total_orders // 10 AS INTEGER) AS prediction FROM metrics"
    return _with(
        body, tx=_SALES, metrics=_METRICS_OF.format(source="tx"), labelled=labelled
    )


def _on_months(body: str) -> str:
    return _with(
        body,
        tx=_SALES,
        monthly=_MONTHLY,
        ranked=_RANKED,
        last_three=_LAST_THREE,
        declining=_DECLINING,
    )


def _on_events(body: str, reach: float = 1.5) -> str:
    return _with(
        body,
        ev=_EVENTS,
        mo="SELECT avg(total_amount) AS mean, stddev_samp(total_amount) AS stddev FROM ev",
        bo=_BOUNDS.format(reach=reach),
        zs="SELECT ev.*, (total_amount - mean) / stddev AS zscore FROM ev, mo",
        iqr=f"SELECT ev.*, lower_bound, upper_bound FROM ev, bo WHERE {_OUTSIDE}",
        med="SELECT ev.*, median * 5.0::DOUBLE AS threshold FROM ev, bo "
        "WHERE total_amount > median * 5.0::DOUBLE",
    )


def _per_metric(template: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS metric, {template.format(c=c)} FROM metrics" for c in METRICS
    )


def _percentile_columns(column: str, named: dict[str, float]) -> str:
    return ", ".join(
        f"round(CAST(quantile_disc({column}, {p}) AS DOUBLE), 2) AS {n}" for n, p in named.items()
    )


def oracle_sql() -> dict[str, str]:
    return _own_sql() | (llm.ORACLE_SQL if llm else {})


def _own_sql() -> dict[str, str]:
    computed = _computed_sql()
    same = {
        "written_clean_rows": "repaired_totals",
        "written_weekly_spending": "weekly_spending",
        "written_declining_customers": "declining_customers_saved",
        "published_weekly_spending": "weekly_spending",
    }
    ordered = {
        "weekly": "weekly_spending",
        "histogram": "activity_histogram",
        "declining": "declining_customers_df",
        "declining_sql": "declining_customers_sql",
        "profile": "cluster_profile_fixed_labels",
    }
    broken = " OR ".join(f"coalesce({c}, false)" for rule, c in _BROKEN.items() if rule != "wrong_customer")
    counts = [f"SELECT '{o}' AS output, count(*) AS rows, 0::BIGINT AS inversions FROM ({computed[q]})" for o, q in ordered.items()]
    return computed | {name: computed[q] for name, q in same.items()} | {
        "written_rejected_rows": _on_damaged(f"SELECT {_TEN} FROM flagged WHERE coalesce(broken, true)"),
        "ordered_outputs": " UNION ALL ".join(counts),
        "incremental_clean_rows": _with(
            "SELECT * REPLACE (CASE WHEN total_amount IS NULL OR total_amount <> quantity * unit_price "
            f"THEN quantity * unit_price ELSE total_amount END AS total_amount) FROM (SELECT {_TYPED_COLUMNS} FROM d WHERE NOT ({broken}))",
            d=_DAMAGED,
        ),
        "incremental_summary": _with(
            f"SELECT count(*) FILTER (NOT ({broken})) AS clean_rows, count(*) FILTER ({broken}) AS error_rows, "
            f"count(*) AS total_rows, count(*) FILTER ({broken}) / count(*) * 100 AS error_rate_pct FROM d",
            d=_DAMAGED,
        ),
    }


def _computed_sql() -> dict[str, str]:
    kept = "SELECT * EXCLUDE (broken) FROM flagged WHERE "
    metrics_rounded = (
        "SELECT customer_id, total_orders, round(total_spending, 2) AS total_spending, "
        "unique_products FROM metrics"
    )
    profile = (
        "SELECT prediction, count(customer_id) AS customer_count, "
        "CAST(sum(total_orders) AS BIGINT) AS sum_orders, "
        "round(sum(total_spending), 2) AS sum_spending, "
        "CAST(sum(unique_products) AS BIGINT) AS sum_products{more} FROM labelled GROUP BY prediction"
    )
    averages = (
        ", round(sum(total_orders) / count(customer_id), 4) AS avg_orders"
        ", round(sum(total_spending) / count(customer_id), 4) AS avg_spending"
        ", round(sum(unique_products) / count(customer_id), 4) AS avg_products"
    )
    weekly = (
        "SELECT customer_id, year, week, round(weekly_spending, 2) AS weekly_spending FROM weekly"
    )
    active = "SELECT customer_id, count(*) AS weeks_with_transactions FROM weekly GROUP BY customer_id"
    report = (
        "SELECT customer_id, year || '-' || month AS year_month, order_count, month_rank FROM declining"
    )
    iqr_rows = f"SELECT {_TEN}, true AS is_anomaly, {_ROUNDED_BOUNDS} FROM iqr"
    return {
        "valid_rows": _on_damaged(kept + "NOT coalesce(broken, true)"),
        "rejected_rows": _on_damaged(kept + "coalesce(broken, true)"),
        "rejected_rows_null_dropped": _on_damaged(kept + "broken"),
        "unflagged_rows": _on_damaged(kept + "broken IS NULL"),
        "validation_rule_counts": _with(
            " UNION ALL ".join(
                f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {sql}) AS broken_rows FROM raw"
                for name, sql in _BROKEN.items()
            ),
            raw=_DAMAGED,
        ),
        "quality_summary": _on_damaged(
            "SELECT clean_rows, error_rows, clean_rows + error_rows AS total_rows, "
            "CASE WHEN clean_rows + error_rows = 0 THEN 0.0 "
            "ELSE error_rows / (clean_rows + error_rows) * 100 END AS error_rate_pct "
            "FROM (SELECT count(*) FILTER (WHERE NOT coalesce(broken, true)) AS clean_rows, "
            "count(*) FILTER (WHERE coalesce(broken, true)) AS error_rows FROM flagged)"
        ),
        "typed_transactions": _on_damaged(
            f"SELECT {_TYPED_COLUMNS} FROM flagged WHERE NOT coalesce(broken, true)"
        ),
        "repaired_totals": _on_damaged(
            "SELECT * REPLACE (CASE WHEN total_amount IS NULL OR total_amount <> quantity * unit_price "
            "THEN quantity * unit_price ELSE total_amount END AS total_amount) "
            f"FROM (SELECT {_TYPED_COLUMNS} FROM flagged WHERE NOT coalesce(broken, true))"
        ),
        "weekly_spending": _on_weekly(weekly),
        "weekly_spending_iso": _on_weekly(weekly, "isoyear(transaction_date)"),
        "active_weeks": _on_weekly(active),
        "activity_histogram": _on_weekly(
            f'SELECT weeks_with_transactions, count(*) AS "count" FROM ({active}) '
            "GROUP BY weeks_with_transactions"
        ),
        "customer_metrics": _on_metrics(metrics_rounded),
        "metrics_null_profile": _on_damaged_metrics(
            "SELECT "
            + ", ".join(
                f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in ["customer_id", *METRICS]
            )
            + " FROM metrics"
        ),
        "metrics_null_loss": _on_damaged_metrics(
            "SELECT all_rows, complete_rows, all_rows - complete_rows AS dropped_rows FROM ("
            "SELECT count(*) AS all_rows, count(*) FILTER (WHERE customer_id IS NOT NULL AND "
            + " AND ".join(f"{c} IS NOT NULL" for c in METRICS)
            + ") AS complete_rows FROM metrics)"
        ),
        "metrics_without_nulls": _on_damaged_metrics(
            metrics_rounded
            + " WHERE customer_id IS NOT NULL AND "
            + " AND ".join(f"{c} IS NOT NULL" for c in METRICS)
        ),
        "metrics_describe": _on_metrics(
            _per_metric(
                'count({c}) AS "count", round(avg({c}), 2) AS mean, '
                "round(stddev_samp({c}), 2) AS stddev, "
                'round(CAST(min({c}) AS DOUBLE), 2) AS "min", '
                'round(CAST(max({c}) AS DOUBLE), 2) AS "max"'
            )
        ),
        "metrics_tail_percentiles": _on_metrics(
            _per_metric(
                'round(CAST(min({c}) AS DOUBLE), 2) AS "min", '
                + _percentile_columns("{c}", profiling.TAILS)
                + ', round(CAST(max({c}) AS DOUBLE), 2) AS "max"'
            )
        ),
        "amount_summary": _on_events(
            "SELECT 'total_amount' AS metric, count(total_amount) AS \"count\", "
            "round(avg(total_amount), 6) AS mean, round(stddev_samp(total_amount), 6) AS stddev, "
            'min(total_amount) AS "min", quantile_disc(total_amount, 0.25) AS p25, '
            "quantile_disc(total_amount, 0.5) AS p50, quantile_disc(total_amount, 0.75) AS p75, "
            'max(total_amount) AS "max" FROM ev'
        ),
        "separated_clusters": _on_metrics(f"SELECT * REPLACE (round(total_spending, 2) AS total_spending) FROM ({_SEPARATED})"),
        "separated_centers": _on_metrics(
            "SELECT prediction, round(avg(total_orders), 2) AS center_total_orders, "
            "round(avg(total_spending), 2) AS center_total_spending, "
            f"round(avg(unique_products), 2) AS center_unique_products FROM ({_SEPARATED}) GROUP BY prediction"
        ),
        "separated_choice": _on_clusters("SELECT k FROM chosen", _SEPARATED),
        "segment_ladder": _on_metrics(_LADDER),
        "k_selection": _on_clusters(
            "SELECT s.k, round(s.silhouette, 6) AS silhouette, round(s.cost, 6) AS cost, s.k = c.k AS chosen FROM scores s, chosen c"
        ),
        "customer_clusters": _on_clusters(
            "SELECT customer_id, total_orders, round(total_spending, 2) AS total_spending, unique_products, prediction FROM labelled"
        ),
        "cluster_centers": _on_clusters(
            "SELECT CAST(label AS INTEGER) AS prediction, "
            + ", ".join(
                f"round((m{i} + d{i} * ({v} / 65536.0::DOUBLE)) / 100, 4) AS center_{c}, round({v} / 65536.0::DOUBLE, 4) AS scaled_center_{c}"
                for i, (v, c) in enumerate(zip("xyz", METRICS))
            )
            + " FROM final JOIN chosen USING (k), moments"
        ),
        "cluster_profile": _on_clusters(profile.format(more="")),
        "cluster_profile_detailed": _on_clusters(profile.format(more=averages)),
        "scaled_metrics": _on_metrics(
            "SELECT customer_id, "
            + ", ".join(
                f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS scaled_{c}"
                for c in METRICS
            )
            + " FROM metrics"
        ),
        "silhouette_fixed_labels": _SILHOUETTE,
        "cluster_profile_fixed_labels": _on_labelled(profile.format(more="")),
        "cluster_profile_detailed_fixed_labels": _on_labelled(profile.format(more=averages)),
        "monthly_orders": _on_months("SELECT * FROM monthly"),
        "month_rank": _on_months("SELECT * FROM ranked"),
        "last_three_months": _on_months("SELECT * FROM last_three"),
        "declining_customers_df": _on_months(report),
        "declining_customers_sql": _on_months(report),
        "declining_customers_saved": _on_months(
            "SELECT customer_id, year, month, order_count, prev_month_orders, "
            "prev_prev_month_orders FROM declining"
        ),
        "declining_count": _on_months("SELECT count(*) AS declining_customers FROM declining"),
        "amount_moments": _on_events(
            "SELECT round(mean, 6) AS mean, round(stddev, 6) AS stddev FROM mo"
        ),
        "amount_quartiles": _on_events(
            f"SELECT q1, median, q3, round(iqr, 6) AS iqr, {_ROUNDED_BOUNDS} FROM bo"
        ),
        "amount_median": _on_events("SELECT median FROM bo"),
        "amount_quantiles_narrowed": _on_events(
            " UNION ALL ".join(
                f"SELECT {p}::DOUBLE AS probability, quantile_disc(total_amount, {p}) AS value FROM ev"
                for p in QUANTILES
            )
        ),
        "zscores": _on_events("SELECT transaction_id, round(zscore, 6) AS zscore FROM zs"),
        "anomalies_zscore": _on_events(
            f"SELECT {_TEN}, round(zscore, 6) AS zscore FROM zs WHERE abs(zscore) > 3"
        ),
        "anomalies_iqr": _on_events(iqr_rows),
        "iqr_high": _on_events(iqr_rows + " WHERE total_amount > upper_bound"),
        "iqr_low": _on_events(iqr_rows + " WHERE total_amount < lower_bound", SMALL_REACH),
        "anomalies_median": _on_events(
            f"SELECT {_TEN}, round(threshold, 6) AS threshold, true AS is_anomaly FROM med"
        ),
        "anomaly_counts": _on_events(
            "SELECT 'zscore' AS method, count(*) AS anomalies FROM zs WHERE abs(zscore) > 3 "
            "UNION ALL SELECT 'iqr', count(*) FROM iqr UNION ALL SELECT 'median', count(*) FROM med"
        ),
        "top_zscore": _on_events(
            f"SELECT {_SHOWN}, round(zscore, 6) AS zscore FROM (SELECT * FROM zs "
            "WHERE abs(zscore) > 3 ORDER BY zs.zscore DESC, transaction_id LIMIT 10)"
        ),
        "top_iqr_high": _on_events(
            f"SELECT {_SHOWN} FROM iqr WHERE total_amount > upper_bound "
            "ORDER BY total_amount DESC, transaction_id LIMIT 5"
        ),
        "top_iqr_low": _on_events(
            f"SELECT {_SHOWN} FROM iqr WHERE total_amount < lower_bound "
            "ORDER BY total_amount, transaction_id LIMIT 5",
            SMALL_REACH,
        ),
        "top_median": _on_events(
            f"SELECT {_SHOWN}, round(threshold, 6) AS threshold FROM med "
            "ORDER BY total_amount DESC, transaction_id LIMIT 10"
        ),
        "anomaly_export_zscore": _on_events(
            f"SELECT {_TEN}, round(zscore, 6) AS zscore FROM zs WHERE abs(zscore) > 3"
        ),
        "anomaly_export_iqr": _on_events(f"SELECT {_TEN}, {_ROUNDED_BOUNDS} FROM iqr"),
        "anomaly_export_median": _on_events(
            f"SELECT {_TEN}, round(threshold, 6) AS threshold FROM med"
        ),
        "daily_amount_sketches": f"SELECT transaction_date, count(total_amount) AS n, min(total_amount) AS low, "
        f"max(total_amount) AS high FROM ({_EVENTS}) GROUP BY transaction_date",
        "sketched_quantiles": " UNION ALL ".join(
            f"SELECT {p}::DOUBLE AS probability, count(total_amount) AS n, "
            f"quantile_disc(total_amount, {round(p - 1 / SKETCH_ACCURACY, 9)}) AS low, "
            f"quantile_disc(total_amount, {round(p + 1 / SKETCH_ACCURACY, 9)}) AS high, TRUE AS inside FROM ({_EVENTS})"
            for p in QUANTILES
        ),
        "merged_customer_products": f"SELECT customer_id, count(transaction_id) AS total_orders, "
        f"count(DISTINCT product_id) AS unique_products, TRUE AS near FROM ({_SALES}) GROUP BY customer_id",
        "weekly_spending_exact": f"SELECT customer_id, CAST(year(transaction_date) AS INTEGER) AS year, "
        f"CAST(week(transaction_date) AS INTEGER) AS week, CAST(sum(CAST(total_amount AS DECIMAL(18, 2))) * 100 AS BIGINT) "
        f"AS weekly_spending FROM ({_SALES}) GROUP BY 1, 2, 3",
        "amount_moments_exact": _exact_moments(_EVENTS),
        "customer_moments_exact": _exact_moments(_SALES, "customer_id"),
    }


def _exact_moments(rows: str, by: str = "") -> str:
    """Mean and deviation by whole numbers of cents, around the whole number next to the mean."""
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""
        WITH cents AS (
            SELECT {key}CAST(CAST(total_amount AS DECIMAL(18, 2)) * 100 AS HUGEINT) AS u FROM ({rows})
        ), sums AS (
            SELECT {key}count(u) AS n, CAST(sum(u) AS HUGEINT) AS s, CAST(sum(u * u) AS HUGEINT) AS q FROM cents {group}
        ), centred AS (
            SELECT *, s // n AS base, (s - (s // n) * n)::DOUBLE AS rest,
                   (q - (s // n) * (2 * s - (s // n) * n))::DOUBLE AS around
            FROM sums
        )
        SELECT {key}n, (base::DOUBLE + rest / n::DOUBLE) / 100 AS mean,
               CASE WHEN n > 1 THEN sqrt((around - rest * rest / n::DOUBLE) / (n::DOUBLE - 1)) / 100 END AS stddev
        FROM centred
    """


_SEPARATED = (
    "SELECT customer_id, total_orders + g * 100000 AS total_orders, total_spending + g * 1e9 AS total_spending, "
    "unique_products + g * 100000 AS unique_products, g AS prediction "
    "FROM (SELECT *, CAST(split_part(customer_id, '_', 2) AS INTEGER) % 3 AS g FROM metrics)"
)

# K-means of whole numbers for all cluster counts at once; nothing here depends on the order of additions.
_CLUSTERS = """
    WITH RECURSIVE tx AS ({sales}), metrics AS ({metrics}), used AS ({used}), raw AS (
        SELECT customer_id, total_orders, total_spending, unique_products, CAST(round(total_orders::DOUBLE * 100) AS BIGINT) AS r0,
               CAST(round(total_spending * 100) AS BIGINT) AS r1, CAST(round(unique_products::DOUBLE * 100) AS BIGINT) AS r2
        FROM used
    ), totals AS (
        SELECT CAST(count(*) AS HUGEINT) AS n, sum(r0) AS s0, sum(r1) AS s1, sum(r2) AS s2, sum(r0::HUGEINT * r0) AS q0,
               sum(r1::HUGEINT * r1) AS q1, sum(r2::HUGEINT * r2) AS q2
        FROM raw
    ), moments AS (
        SELECT s0::DOUBLE / n::DOUBLE AS m0, s1::DOUBLE / n::DOUBLE AS m1, s2::DOUBLE / n::DOUBLE AS m2,
               sqrt((n * q0 - s0 * s0)::DOUBLE / (n * (n - 1))::DOUBLE) AS d0,
               sqrt((n * q1 - s1 * s1)::DOUBLE / (n * (n - 1))::DOUBLE) AS d1,
               sqrt((n * q2 - s2 * s2)::DOUBLE / (n * (n - 1))::DOUBLE) AS d2
        FROM totals
    ), points AS (
        SELECT raw.*, CAST(floor((r0 - m0) / d0 * 65536 + 0.5) AS BIGINT) AS p, CAST(floor((r1 - m1) / d1 * 65536 + 0.5) AS BIGINT) AS q,
               CAST(floor((r2 - m2) / d2 * 65536 + 0.5) AS BIGINT) AS r
        FROM raw, moments
    ), seeds AS (
        SELECT p, q, r, row_number() OVER (ORDER BY digest) - 1 AS c
        FROM (SELECT p, q, r, min(md5(customer_id)) AS digest FROM points GROUP BY p, q, r)
    ), steps AS (
        SELECT 0 AS step, k, c, p AS x, q AS y, r AS z FROM seeds, (SELECT unnest([2, 3, 4, 5]) AS k) WHERE c < k
        UNION ALL
        SELECT step + 1, k, c, coalesce(CAST(floor(sum(p) FILTER (WHERE c = near)::DOUBLE / (count(*) FILTER (WHERE c = near)) + 0.5) AS BIGINT), x),
               coalesce(CAST(floor(sum(q) FILTER (WHERE c = near)::DOUBLE / (count(*) FILTER (WHERE c = near)) + 0.5) AS BIGINT), y),
               coalesce(CAST(floor(sum(r) FILTER (WHERE c = near)::DOUBLE / (count(*) FILTER (WHERE c = near)) + 0.5) AS BIGINT), z)
        FROM (
            SELECT s.*, p, q, r, arg_min(c, ((p - x) * (p - x) + (q - y) * (q - y) + (r - z) * (r - z)) * 8 + c) OVER (PARTITION BY k, customer_id) AS near
            FROM steps s, points WHERE step < 20
        ) GROUP BY step, k, c, x, y, z
    ), final AS (
        SELECT k, x, y, z, row_number() OVER (PARTITION BY k ORDER BY y, x, z) - 1 AS label FROM steps WHERE step = 20
    ), near AS (
        SELECT k, customer_id, p, q, r, min(d) AS distance, arg_min(label, d * 8 + label) AS label
        FROM (SELECT *, (p - x) * (p - x) + (q - y) * (q - y) + (r - z) * (r - z) AS d FROM final, points)
        GROUP BY k, customer_id, p, q, r
    ), sums AS (
        SELECT k, label, count(*) AS n, sum(p) AS sp, sum(q) AS sq, sum(r) AS sr, sum(p * p + q * q + r * r) AS ss FROM near GROUP BY k, label
    ), sides AS (
        SELECT a.k, a.customer_id, any_value(distance) AS distance, max(n) FILTER (WHERE a.label = s.label) AS n,
               max(total / (n - 1)) FILTER (WHERE a.label = s.label AND n > 1) AS inside, min(total / n) FILTER (WHERE a.label <> s.label) AS outside
        FROM near a JOIN (SELECT * FROM sums) s ON a.k = s.k,
             LATERAL (SELECT s.ss::DOUBLE + s.n::DOUBLE * (a.p::DOUBLE * a.p + a.q::DOUBLE * a.q + a.r::DOUBLE * a.r)
                             - 2 * (a.p::DOUBLE * s.sp::DOUBLE + a.q::DOUBLE * s.sq::DOUBLE + a.r::DOUBLE * s.sr::DOUBLE) AS total)
        GROUP BY a.k, a.customer_id
    ), scores AS (
        SELECT CAST(k AS INTEGER) AS k, avg(CASE WHEN inside IS NULL OR inside = outside THEN 0 WHEN inside < outside THEN 1 - inside / outside ELSE outside / inside - 1 END) AS silhouette,
               sum(distance)::DOUBLE / 4294967296 AS cost
        FROM sides GROUP BY k
    ), chosen AS (
        SELECT k FROM scores ORDER BY round(silhouette, 9) DESC, k LIMIT 1
    ), labelled AS (
        SELECT customer_id, total_orders, total_spending, unique_products, CAST(label AS INTEGER) AS prediction
        FROM near JOIN chosen USING (k) JOIN used USING (customer_id)
    )
"""


def _on_clusters(body: str, used: str = "SELECT * FROM metrics") -> str:
    return _CLUSTERS.format(sales=_SALES, metrics=_METRICS_OF.format(source="tx"), used=used) + body


# A deviation cannot be had as a double where the square of a difference from the mean is beyond one.
_LADDER = """
    , firsts AS (
        SELECT *, total_orders::DOUBLE AS o, round(total_spending, 2) AS s, unique_products::DOUBLE AS u,
               customer_id = (SELECT min(customer_id) FROM metrics) AS alone
        FROM metrics
    ), cases AS (
        SELECT 'as_they_are' AS case_name, o, s, u FROM firsts
        UNION ALL SELECT 'one_customer', o, s, u FROM firsts WHERE alone
        UNION ALL SELECT 'equal_points', 1, 1, 1 FROM firsts
        UNION ALL SELECT 'two_points', o % 2, 1, 1 FROM firsts
        UNION ALL SELECT 'one_infinite', o, CASE WHEN alone THEN 'inf'::DOUBLE ELSE s END, u FROM firsts
        UNION ALL SELECT 'one_null', o, CASE WHEN NOT alone THEN s END, u FROM firsts
        UNION ALL SELECT 'all_null', o, NULL, u FROM firsts
        UNION ALL SELECT 'beyond_scaling', o, s * 1e200, u FROM firsts
    ), usable AS (
        SELECT *, avg(s) OVER (PARTITION BY case_name) AS mean FROM cases WHERE isfinite(s)
    ), points AS (
        SELECT case_name, count(*) AS n_usable, count(DISTINCT (o, s, u)) AS n_points, max(abs(s - mean)) AS far
        FROM usable GROUP BY case_name
    ), counted AS (
        SELECT case_name, count(*) AS n_customers FROM cases GROUP BY case_name
    ), decided AS (
        SELECT case_name, n_customers, coalesce(n_usable, 0) AS n_usable, coalesce(n_points, 0) AS n_points,
               CASE WHEN coalesce(n_points, 0) < 2 THEN 'metrics_only' WHEN far < 1.3e154 THEN 'scaled' ELSE 'unscaled' END AS status
        FROM counted LEFT JOIN points USING (case_name)
    )
    SELECT *, CAST(CASE status WHEN 'scaled' THEN least(5, n_points) WHEN 'unscaled' THEN 2 END AS INTEGER) AS most_clusters
    FROM decided
"""

# Sum of squared distances from a point to a cluster, from the cluster's count and sums.
_SILHOUETTE = """
    WITH points AS (
        SELECT row_number() OVER () AS id, o_totalprice / 100000 AS x,
               CAST(day(o_orderdate) AS DOUBLE) AS y, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS c
        FROM orders
    ), clusters AS (
        SELECT c, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x + y * y) AS sq
        FROM points GROUP BY c
    ), distances AS (
        SELECT p.id, p.c = k.c AS own, k.n,
               k.sq + k.n * (p.x * p.x + p.y * p.y) - 2 * (p.x * k.sx + p.y * k.sy) AS total
        FROM points p CROSS JOIN clusters k
    ), sides AS (
        SELECT id, max(n) FILTER (WHERE own) AS n,
               max(CASE WHEN own AND n > 1 THEN total / (n - 1) END) AS a,
               min(CASE WHEN NOT own THEN total / n END) AS b
        FROM distances GROUP BY id
    )
    SELECT round(avg(CASE WHEN n = 1 OR a = b THEN 0 WHEN a < b THEN 1 - a / b ELSE b / a - 1 END), 6)
           AS silhouette
    FROM sides
"""

"""From raw files to clean and rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from tillscope.operators import quality
from tillscope.sinks import write_validated
from tillscope.sources import read_raw


def preprocess(
    spark: SparkSession,
    raw_path: str | list[str],
    output: str,
    *,
    expected_customer: str | Column | None = None,
    customer_pattern: str | None = None,
    on_null_flag: str = "error",
    fmt: str = "parquet",
) -> DataFrame:
    """Validate raw CSV files and write the split to ``output``; returns the quality summary.

    The input is parsed once: both sides are written by the same job, which also counts them. Read the
    result with ``read_clean`` and ``read_rejected``.
    """
    condition = quality.error_condition(expected_customer, customer_pattern)
    flagged = quality.flag(read_raw(spark, raw_path), condition, on_null_flag)
    counted = Observation("quality")
    write_validated(flagged.observe(counted, *quality.count_columns()), output, fmt)
    counts = counted.get
    row = [(counts["clean_rows"], counts["error_rows"])]
    return quality.add_error_rate(
        spark.createDataFrame(row, "clean_rows bigint, error_rows bigint")
    )

"""Readers for raw and processed transaction files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillscope.schema import MALFORMED, RAW_WITH_MALFORMED, TYPED


def read_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw CSV with a header, every column as text.

    The schema is stated, so there is no inference pass over the input, and the header of each file is
    checked against it. A line with fewer or more fields keeps its text in ``malformed_record``, a further column that is
    NULL for all other rows.
    """
    return (
        spark.read.schema(RAW_WITH_MALFORMED)
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(path)
    )


def read_processed(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """Validated, typed transactions."""
    reader = spark.read.schema(TYPED)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    paths = [path] if isinstance(path, str) else path
    return reader.format(fmt).load(paths)


def register(df: DataFrame, name: str = "transactions") -> DataFrame:
    """Make the frame available to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df

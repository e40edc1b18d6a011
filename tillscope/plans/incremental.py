"""Validation of growing input: each run reads only the raw files that earlier runs have not.

The output is a folder with ``batches``, a split for each run, and ``files``, which names every raw file taken (path, size,
time) with its batch and that batch's counts. A batch counts once its lines stand in ``files``, which are written last, in
one small job. So a failed run leaves nothing that is read, and the next one takes its files again.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillscope.operators import quality
from tillscope.sinks import read_clean, read_rejected, write_validated
from tillscope.sources import read_raw

_FILES = "path string, length bigint, modificationTime timestamp, batch string, clean_rows bigint, error_rows bigint"


def preprocess_new(
    spark: SparkSession,
    raw_path: str | list[str],
    output: str,
    *,
    expected_customer: str | Column | None = None,
    customer_pattern: str | None = None,
    on_null_flag: str = "error",
    fmt: str = "parquet",
) -> DataFrame:
    """Validate the raw files that are new and return the quality summary of all files taken so far.

    Raw files must not change after they were taken: one with another size or time raises ValueError, and nothing is written.
    Files that went away keep their rows. Without new files nothing is written. Runs must not overlap.
    """
    # The files' contents are not read here.
    present = spark.read.format("binaryFile").load(raw_path).select("path", "length", "modificationTime")
    taken = taken_files(spark, output)
    known = taken.select("path", F.col("length").alias("old_length"), F.col("modificationTime").alias("old_time"))
    same = (F.col("length") == F.col("old_length")) & (F.col("modificationTime") == F.col("old_time"))
    changed = present.join(known, "path").filter(~same).select("path").first()
    if changed is not None:
        raise ValueError(f"{changed['path']} changed after it was taken")
    fresh = present.join(known, "path", "left_anti").collect()  # names of files, no rows of them
    if fresh:
        batch, counted = uuid.uuid4().hex, Observation("quality")
        condition = quality.error_condition(expected_customer, customer_pattern)
        flagged = quality.flag(read_raw(spark, [_literal(r["path"]) for r in fresh]), condition, on_null_flag)
        write_validated(flagged.observe(counted, *quality.count_columns()), _batch(output, batch), fmt)
        counts = counted.get
        lines = [(*r, batch, counts["clean_rows"], counts["error_rows"]) for r in fresh]
        spark.createDataFrame(lines, _FILES).coalesce(1).write.mode("append").parquet(f"{output}/files")
    return summary(spark, output)


def taken_files(spark: SparkSession, output: str) -> DataFrame:
    """path, length, modificationTime, batch, and the counts of that batch."""
    try:
        return spark.read.schema(_FILES).parquet(f"{output}/files")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _FILES)


def summary(spark: SparkSession, output: str) -> DataFrame:
    """The quality summary over all batches, from their counts."""
    batches = taken_files(spark, output).select("batch", "clean_rows", "error_rows").distinct()
    counts = ("clean_rows", "error_rows")
    return quality.add_error_rate(batches.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]))


def all_clean(spark: SparkSession, output: str, fmt: str = "parquet") -> DataFrame:
    """Typed clean rows of all batches."""
    return read_clean(spark, _batches(spark, output), fmt, f"{output}/batches")


def all_rejected(spark: SparkSession, output: str, fmt: str = "parquet") -> DataFrame:
    """Raw text of the rejected rows of all batches."""
    return read_rejected(spark, _batches(spark, output), fmt, f"{output}/batches")


def _literal(path: str) -> str:
    """A path whose signs of patterns stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _batch(output: str, batch: str) -> str:
    return f"{output}/batches/batch={batch}"


def _batches(spark: SparkSession, output: str) -> list[str]:
    found = [r["batch"] for r in taken_files(spark, output).select("batch").distinct().collect()]
    if not found:
        raise ValueError(f"no files were taken into {output}")
    return [_batch(output, b) for b in sorted(found)]

"""Writers, and readers for the split of validated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.operators.quality import FLAG, conversions, repair_totals
from tillscope.schema import COLUMNS, CONVERTED, MALFORMED, RAW, TYPED

OUTCOME = "outcome"
CLEAN, REJECTED = "clean", "rejected"


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    *,
    order_by: list[str] | None = None,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Write a result; CSV gets a header and keeps the spaces around values.

    Ordered results are files of consecutive ranges.
    """
    if order_by:
        df = df.orderBy(*order_by)
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
        writer = writer.option("ignoreLeadingWhiteSpace", False)
        writer = writer.option("ignoreTrailingWhiteSpace", False)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def store(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    *,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Write a result and return it as read from there, so that using it does not recompute it."""
    write_table(df, path, fmt, order_by=order_by)
    reader = df.sparkSession.read.schema(df.schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def write_validated(flagged: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write clean and rejected rows in one pass over the input, each in its own partition.

    Clean rows are typed and have repaired totals, rejected rows keep their raw text. Rows whose flag is
    NULL are in neither. In Parquet the converted columns exist twice, typed and raw, and one of the two
    is empty throughout a partition; CSV holds the text of either.
    """
    clean = ~F.col(FLAG)
    malformed = F.col(MALFORMED) if MALFORMED in flagged.columns else F.lit(None).cast("string").alias(MALFORMED)
    kept = flagged.filter(F.col(FLAG).isNotNull()).select(
        FLAG, *COLUMNS, malformed, *[F.col(c).alias(f"raw_{c}") for c in CONVERTED]
    )
    typed = repair_totals(kept.withColumns(conversions()))
    if fmt == "csv":
        columns = {
            c: F.when(clean, F.col(c).cast("string")).otherwise(F.col(f"raw_{c}")) for c in CONVERTED
        }
        rows = typed.withColumns(columns).select(*COLUMNS, MALFORMED, _outcome(clean))
    else:
        columns = {c: F.when(clean, F.col(c)) for c in CONVERTED}
        columns |= {f"raw_{c}": F.when(~clean, F.col(f"raw_{c}")) for c in CONVERTED}
        rows = typed.withColumns(columns).withColumn(OUTCOME, _outcome(clean)).drop(FLAG)
    write_table(rows, path, fmt, partition_by=[OUTCOME])


def read_clean(spark: SparkSession, path: str | list[str], fmt: str = "parquet", base: str | None = None) -> DataFrame:
    """Typed clean rows of a split; only their partition is scanned."""
    return _read(spark, path, fmt, TYPED, CLEAN, base).select(*COLUMNS)


def read_rejected(spark: SparkSession, path: str | list[str], fmt: str = "parquet", base: str | None = None) -> DataFrame:
    """Raw text of the rejected rows of a split, and the whole line of malformed ones; only their partition is scanned."""
    rows = _read(spark, path, fmt, RAW, REJECTED, base)
    if fmt == "csv":
        return rows.select(*COLUMNS, MALFORMED)
    return rows.select(
        *[F.col(f"raw_{c}").alias(c) if c in CONVERTED else F.col(c) for c in COLUMNS], MALFORMED
    )


def _outcome(clean: Column) -> Column:
    return F.when(clean, CLEAN).otherwise(REJECTED).alias(OUTCOME)


def _read(
    spark: SparkSession, path: str | list[str], fmt: str, csv_schema: T.StructType, outcome: str, base: str | None
) -> DataFrame:
    # The schema is stated because a split may be empty.
    partition = T.StructField(OUTCOME, T.StringType())
    malformed = T.StructField(MALFORMED, T.StringType())
    if fmt == "csv":
        schema = T.StructType([*csv_schema, malformed, partition])
        reader = spark.read.schema(schema).option("header", True)
    else:
        raw = [T.StructField(f"raw_{c}", T.StringType()) for c in CONVERTED]
        reader = spark.read.schema(T.StructType([*TYPED, *raw, malformed, partition]))
    if base is not None:  # several splits inside one folder
        reader = reader.option("basePath", base)
    return reader.format(fmt).load(path).filter(F.col(OUTCOME) == outcome)

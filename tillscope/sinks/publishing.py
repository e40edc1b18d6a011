"""Results that are replaced as a whole or by period, while the earlier ones stay readable until the new ones are complete.

A published table is a folder with ``data``, in partitions by period and version, and ``manifest``. Rows of a new version are
written first; readers do not see them. Appending a line per period to the manifest, in one small job, publishes them. The
version with the highest number counts for a period, so a failure at any time leaves what was readable before, and
publishing one period writes that period alone. Two runs at once that publish the same period get the same number; the
greater version name counts then.

Superseded versions stay on disk; ``superseded`` names them for cleaning.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

PERIOD, VERSION = "published_period", "published_version"
WHOLE = "all"
_MANIFEST = "period string, version string, number bigint, rows bigint, columns string"


def publish(df: DataFrame, path: str, period: str | None = None, periods: list[str] | None = None) -> DataFrame:
    """Publish the rows of ``df`` and return the manifest lines of this run (period, version, number, rows, columns).

    ``period`` names the column whose text parts the rows; without it there is one period, ``all``. Only periods that occur
    are replaced, and those in ``periods``, which become empty if no row belongs to them. NULL periods are one of their own.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    for name in (PERIOD, VERSION):
        if name in df.columns:
            raise ValueError(f"{name} is a column of the published table")
    of = F.lit(WHOLE) if period is None else F.col(f"`{period}`").cast("string")
    rows = df.withColumns({PERIOD: of, VERSION: F.lit(version)})
    rows.write.mode("append").partitionBy(PERIOD, VERSION).parquet(f"{path}/data")

    number = (_manifest(spark, path).agg(F.max("number")).first()[0] or 0) + 1
    expected = [WHOLE] if period is None else list(periods or [])
    written = _data(spark, path, df.schema).filter(F.col(VERSION) == version).groupBy(PERIOD).agg(F.count(F.lit(1)).alias("rows"))
    asked = spark.createDataFrame([(p,) for p in expected], "period string").distinct().withColumn("rows", F.lit(0).cast("long"))
    lines = written.select(F.col(PERIOD).alias("period"), "rows").union(asked).groupBy("period").agg(F.max("rows").alias("rows"))
    lines = lines.select("period", F.lit(version).alias("version"), F.lit(number).cast("long").alias("number"), "rows", F.lit(df.schema.json()).alias("columns"))
    lines.coalesce(1).write.mode("append").json(f"{path}/manifest", ignoreNullFields=False)
    return _manifest(spark, path).filter(F.col("version") == version)


def current(spark: SparkSession, path: str) -> DataFrame:
    """The manifest line that counts for each period."""
    line = F.struct("number", "version", "rows", "columns")
    return _manifest(spark, path).groupBy("period").agg(F.max(line).alias("line")).select("period", "line.*")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The rows that count now. Folders of other versions are not scanned."""
    lines = current(spark, path).collect()  # a line per period, no rows of the table
    if not lines:
        raise ValueError(f"nothing was published in {path}")
    newest = max(lines, key=lambda r: (r["number"], r["version"]))
    schema = T.StructType.fromJson(json.loads(newest["columns"]))
    wanted = [_key(r["period"], r["version"]) for r in lines if r["rows"]]
    if not wanted:
        return spark.createDataFrame([], schema)
    return _data(spark, path, schema).filter(_keys().isin(wanted)).select(*[F.col(f"`{c}`") for c in schema.names])


def superseded(spark: SparkSession, path: str) -> DataFrame:
    """period and version of published rows that no longer count."""
    counts = current(spark, path).select("period", "version")
    return _manifest(spark, path).select("period", "version").exceptAll(counts)


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_MANIFEST).json(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def _data(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    parts = [T.StructField(PERIOD, T.StringType()), T.StructField(VERSION, T.StringType())]
    return spark.read.schema(T.StructType([*schema, *parts])).parquet(f"{path}/data")


def _keys() -> Column:
    return F.concat(F.col(VERSION), F.coalesce(F.concat(F.lit("/"), F.col(PERIOD)), F.lit("")))


def _key(period: str | None, version: str) -> str:
    return version if period is None else f"{version}/{period}"

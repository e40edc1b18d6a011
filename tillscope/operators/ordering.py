"""Whether a stored result is in order, over all its files.

Files are taken by name, rows by their place in the file, and places in blocks. Each row is compared with the one before it
in its block, the first of a block with the last of the block before, and the first of a file with the last of the file
before that has rows. No task sees more than a block, the blocks of a file, or one row per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 17


def inversions(stored: DataFrame, order: list[str], block: int = BLOCK) -> DataFrame:
    """One row: files, rows, and inversions (neighbours of which the second sorts before the first).

    ``stored`` is read from Parquet files. Columns sort upwards, a name with ``-`` before it downwards; upwards NULLs come
    first, downwards last, as with ``orderBy``. Descending columns must be numbers. An empty result has no inversion.
    """
    key = F.struct(*[x for i, c in enumerate(order) for x in _parts(c, i)])
    rows = stored.select(
        F.col("_metadata.file_name").alias("file"),
        F.floor(F.col("_metadata.row_index") / block).alias("block"),
        F.col("_metadata.row_index").alias("at"),
        key.alias("key"),
    )
    inside = Window.partitionBy("file", "block").orderBy("at")
    blocks = (
        rows.withColumn("before", F.lag("key").over(inside))
        .groupBy("file", "block")
        .agg(*_ends("at", F.col("key"), F.col("key")), F.count(F.lit(1)).alias("rows"), F.count_if(F.col("key") < F.col("before")).alias("wrong"))
    )
    files = _joined(blocks, Window.partitionBy("file").orderBy("block")).groupBy("file").agg(
        *_ends("block", F.col("first"), F.col("last")), F.sum("rows").alias("rows"), F.sum("wrong").alias("wrong")
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return (
        _joined(files, Window.partitionBy(F.lit(0)).orderBy("file"))
        .agg(F.count(F.lit(1)).alias("files"), total("rows"), total("wrong"))
        .withColumnRenamed("wrong", "inversions")
    )


def _parts(column: str, i: int) -> list[Column]:
    if not column.startswith("-"):
        return [F.col(column).alias(f"k{i}")]
    value = F.col(column[1:])
    return [value.isNull().alias(f"n{i}"), (-value).alias(f"k{i}")]


def _ends(by: str, first: Column, last: Column) -> list[Column]:
    return [F.min_by(first, by).alias("first"), F.max_by(last, by).alias("last")]


def _joined(parts: DataFrame, window) -> DataFrame:
    """Adds to ``wrong`` whether a part starts below the end of the one before."""
    known = parts.withColumn("before", F.lag("last").over(window))
    return known.withColumn("wrong", F.col("wrong") + F.coalesce((F.col("first") < F.col("before")).cast("long"), F.lit(0)))

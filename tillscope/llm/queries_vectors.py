"""Query of the nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import neighbours
from .common import table

QUERY_STEP = 20
NEAREST = 20


def op5_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = neighbours.usable(table(spark, folder, "embeddings"), "vec_id", "embedding")
    router = neighbours.fit(vectors)
    return neighbours.search(vectors, F.col("id") % QUERY_STEP == 0, router, NEAREST).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score"
    )

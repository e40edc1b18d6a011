"""What a segmentation can do with its customers, decided for many sets of customers in one plan."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.operators.customers import complete
from tillscope.operators.segments import CLUSTER_COUNTS, METRICS_ONLY, SCALED, UNSCALED
from tillscope.schema import METRICS


def rungs(metrics: DataFrame, by: str, columns: list[str] = METRICS, cluster_counts: tuple[int, ...] = CLUSTER_COUNTS) -> DataFrame:
    """For each value of ``by``: status, n_customers, n_usable, n_points and most_clusters.

    Incomplete customers (a NULL, NaN or infinite metric) are not usable. Fewer than two distinct points leave the metrics
    alone. Features whose mean or deviation is beyond a double cannot be scaled; two clusters of them as they are remain. Else
    all cluster counts are tried, up to the number of distinct points. This decides what ``segments.segment`` tries; nothing is
    fitted. One aggregation: points are counted after grouping by them, so a set with most of the rows is spread over all tasks.
    """
    usable = complete(metrics, ["customer_id", *columns])
    values = [F.when(usable, F.col(c).cast("double")) for c in columns]
    sizes = [f(v).alias(f"_{f.__name__}{i}") for f in (F.avg, F.stddev_samp) for i, v in enumerate(values)]
    found = metrics.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.count_if(usable).alias("n_usable"),
        F.count_distinct(F.when(usable, F.struct(*columns))).alias("n_points"),
        *sizes,
    )
    finite = reduce(and_, [F.abs(F.col(c)) < F.lit(math.inf) for c in found.columns[4:]])  # NaN is above infinity
    status = F.when(F.col("n_points") < 2, METRICS_ONLY).when(finite, SCALED).otherwise(UNSCALED)
    most = F.when(F.col("status") == SCALED, F.least(F.lit(max(cluster_counts)).cast("long"), "n_points"))
    return found.withColumn("status", status).select(
        by,
        "status",
        "n_customers",
        "n_usable",
        "n_points",
        F.when(F.col("status") == UNSCALED, 2).otherwise(most).cast("int").alias("most_clusters"),
    )

"""Customer segments: scaled K-means with the number of clusters chosen by silhouette."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.operators.customers import complete_metrics
from tillscope.schema import METRICS
from tillscope.sinks.checkpoints import cut_lineage

RAW_FEATURES, FEATURES, LABEL = "raw_features", "features", "prediction"
CLUSTER_COUNTS = (2, 3, 4, 5)
SEED = 42

SCALED, UNSCALED, METRICS_ONLY = "scaled", "unscaled", "metrics_only"


@dataclass(frozen=True)
class Score:
    k: int
    silhouette: float
    cost: float


@dataclass
class Segmentation:
    """Outcome of ``segment``.

    ``status`` tells what the data allowed: clusters of scaled features, two clusters of unscaled
    features, or the metrics alone. ``metrics`` is the checkpointed input. Labels run from the lowest to
    the highest mean spending.
    """

    status: str
    metrics: DataFrame
    customers: DataFrame
    k: int | None = None
    scores: list[Score] = field(default_factory=list)
    centers: list[list[float]] = field(default_factory=list)
    scaled_centers: list[list[float]] = field(default_factory=list)


def fit_scaling(metrics: DataFrame, columns: list[str] = METRICS) -> PipelineModel:
    """Assemble the columns and standardise them: centred, in sample standard deviations."""
    assembler = VectorAssembler(inputCols=columns, outputCol=RAW_FEATURES)
    scaler = StandardScaler(
        inputCol=RAW_FEATURES, outputCol=FEATURES, withMean=True, withStd=True
    )
    return Pipeline(stages=[assembler, scaler]).fit(metrics)


def scaled_metrics(metrics: DataFrame, columns: list[str] = METRICS) -> DataFrame:
    """Each customer's standardised features as columns; a constant feature becomes 0."""
    values = vector_to_array(FEATURES)
    return (
        fit_scaling(metrics, columns)
        .transform(metrics)
        .select("customer_id", *[values[i].alias(f"scaled_{c}") for i, c in enumerate(columns)])
    )


def silhouette(df: DataFrame, columns: list[str], label: str = LABEL) -> float:
    """Mean silhouette of labelled rows under squared Euclidean distance.

    Computed from per-cluster sums, so each row is compared with clusters and not with other rows.
    """
    points = VectorAssembler(inputCols=columns, outputCol=FEATURES).transform(df)
    return ClusteringEvaluator(featuresCol=FEATURES, predictionCol=label).evaluate(points)


def segment(
    metrics: DataFrame,
    columns: list[str] = METRICS,
    cluster_counts: tuple[int, ...] = CLUSTER_COUNTS,
    seed: int = SEED,
    parallelism: int = 4,
) -> Segmentation:
    """Cluster customers, trying every cluster count and keeping the best silhouette.

    ``parallelism`` fits run at a time, sharing the executors.

    The metrics are checkpointed first: every fit makes many passes over them, one row per customer, and
    none over the transactions. Customers with a NULL metric are left out of the clusters.
    """
    metrics = cut_lineage(metrics)
    usable = complete_metrics(metrics)
    if not _has_distinct_points(usable, columns):
        return Segmentation(METRICS_ONLY, metrics, metrics)

    # Asked for more centres than there are points, a fit may fail or give fewer.
    distinct = usable.select(*columns).distinct().limit(max(cluster_counts)).count()
    cluster_counts = tuple(sorted({min(k, distinct) for k in cluster_counts}))
    scaling = fit_scaling(usable, columns)
    attempts = [(UNSCALED, RAW_FEATURES, (2,))]
    if all(math.isfinite(v) for v in [*scaling.stages[-1].mean, *scaling.stages[-1].std]):
        attempts.insert(0, (SCALED, FEATURES, cluster_counts))
    points = scaling.transform(usable).persist()
    try:
        points.count()  # fill the cache before several fits ask for it
        for status, features, counts in attempts:
            models = _fit_all(points, features, counts, seed, parallelism)
            if models:
                # The first of equal scores wins, hence the smallest cluster count.
                best, model = max(models, key=lambda m: m[0].silhouette)
                scores = [score for score, _ in models]
                return _labelled(metrics, columns, scaling, status, scores, best.k, model)
    finally:
        points.unpersist()
    return Segmentation(METRICS_ONLY, metrics, metrics)


def cluster_profile(
    customers: DataFrame, *, detailed: bool = False, ordered: bool = False
) -> DataFrame:
    """Customers and summed metrics of every cluster, with means per customer if ``detailed``."""
    averages = {
        "avg_orders": "total_orders",
        "avg_spending": "total_spending",
        "avg_products": "unique_products",
    }
    result = customers.groupBy(LABEL).agg(
        F.count("customer_id").alias("customer_count"),
        F.sum("total_orders").alias("sum_orders"),
        F.sum("total_spending").alias("sum_spending"),
        F.sum("unique_products").alias("sum_products"),
        *[F.avg(c).alias(name) for name, c in averages.items() if detailed],
    )
    return result.orderBy(LABEL) if ordered else result


def center_table(segmentation: Segmentation) -> DataFrame:
    """One row per cluster with its centre in original and in standardised units."""
    names = [f"center_{c}" for c in METRICS] + [f"scaled_center_{c}" for c in METRICS]
    rows = [
        (label, *map(float, plain), *map(float, scaled))
        for label, (plain, scaled) in enumerate(
            zip(segmentation.centers, segmentation.scaled_centers)
        )
    ]
    schema = f"{LABEL} int, " + ", ".join(f"{n} double" for n in names)
    return segmentation.metrics.sparkSession.createDataFrame(rows, schema)


def score_table(segmentation: Segmentation) -> DataFrame:
    """One row per cluster count tried, marking the chosen one."""
    rows = [(s.k, s.silhouette, s.cost, s.k == segmentation.k) for s in segmentation.scores]
    return segmentation.metrics.sparkSession.createDataFrame(
        rows, "k int, silhouette double, cost double, chosen boolean"
    )


def _has_distinct_points(metrics: DataFrame, columns: list[str]) -> bool:
    """Whether at least two customers differ in a feature, and no feature is NaN or infinite."""
    differs, finite = F.lit(False), F.lit(True)
    for c in columns:
        low, high = F.min(c).cast("double"), F.max(c).cast("double")
        differs = differs | (low < high)
        finite = finite & (low > -math.inf) & (high < math.inf)
    return bool(metrics.agg(F.coalesce(differs & finite, F.lit(False))).first()[0])


def _labelled(
    metrics: DataFrame,
    columns: list[str],
    scaling: PipelineModel,
    status: str,
    scores: list[Score],
    k: int,
    model: KMeansModel,
) -> Segmentation:
    centers, scaled_centers = _both_units(model, scaling, status)
    spending = columns.index("total_spending") if "total_spending" in columns else 0
    by_spending = sorted(range(k), key=lambda i: (centers[i][spending], centers[i]))
    new_label = F.array(*[F.lit(by_spending.index(i)) for i in range(k)])
    customers = (
        model.transform(scaling.transform(complete_metrics(metrics)))
        .withColumn(LABEL, new_label[F.col(LABEL)])
        .select("customer_id", *columns, LABEL)
    )
    return Segmentation(
        status,
        metrics,
        customers,
        k,
        scores,
        [centers[i] for i in by_spending],
        [scaled_centers[i] for i in by_spending],
    )


def _fit_all(
    points: DataFrame, features: str, cluster_counts: tuple[int, ...], seed: int, parallelism: int
) -> list[tuple[Score, KMeansModel]]:
    evaluator = ClusteringEvaluator(featuresCol=features, predictionCol=LABEL)

    def fit(k: int) -> tuple[Score, KMeansModel] | None:
        model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol=LABEL).fit(points)
        found = len(model.clusterCenters())
        if found < 2:
            return None
        score = evaluator.evaluate(model.transform(points))
        return Score(found, score, model.summary.trainingCost), model

    with ThreadPool(max(1, min(parallelism, len(cluster_counts)))) as pool:
        fitted = pool.map(inheritable_thread_target(points.sparkSession)(fit), sorted(cluster_counts))
    # Fewer centres than asked for means fewer distinct points than that; such a fit counts once.
    models: dict[int, tuple[Score, KMeansModel]] = {}
    for result in fitted:
        if result is not None:
            models.setdefault(result[0].k, result)
    return list(models.values())


def _both_units(
    model: KMeansModel, scaling: PipelineModel, status: str
) -> tuple[list[list[float]], list[list[float]]]:
    mean, std = scaling.stages[-1].mean, scaling.stages[-1].std
    centers = [list(c) for c in model.clusterCenters()]
    if status == SCALED:
        return [[m + s * v for m, s, v in zip(mean, std, c)] for c in centers], centers
    return centers, [[(v - m) / s if s else 0.0 for m, s, v in zip(mean, std, c)] for c in centers]

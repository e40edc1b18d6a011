"""Reproducible customer segments: K-means whose result depends on the rows alone, not on their order or partitions.

Features are whole numbers: the metrics in units of 10^-``digits``, standardised by mean and deviation from exact sums, then in
units of 2^-16. Sums of whole numbers are exact in any order, so each step gives the same centres for any partitioning.
First centres are the points of smallest id digest. Clusterings of all sizes take their steps together: a row has an array of
labels, one for each size, and one aggregation by size and label gives all sums. Silhouettes come from such sums as well.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.operators.customers import complete_metrics
from tillscope.operators.segments import CLUSTER_COUNTS, LABEL, METRICS_ONLY, SCALED, Score, Segmentation
from tillscope.schema import METRICS
from tillscope.sinks.checkpoints import cut_lineage

UNIT = 1 << 16
STEPS = 20
_SHARE = 10**12  # silhouettes are added in this unit

Centers = dict[int, list[tuple[int, ...]]]


def segment(
    metrics: DataFrame,
    columns: list[str] = METRICS,
    cluster_counts: tuple[int, ...] = CLUSTER_COUNTS,
    digits: int = 2,
    steps: int = STEPS,
) -> Segmentation:
    """Cluster customers for every count and keep the best silhouette, of equal ones the smallest count.

    Incomplete customers are left out of the clusters. Fewer than two distinct points give the metrics alone; a count beyond
    the distinct points counts as their number. Labels run from the lowest to the highest centre of spending.
    """
    metrics = cut_lineage(metrics)
    usable = complete_metrics(metrics)
    whole = [F.round(F.col(c).cast("double") * 10.0**digits).cast("long") for c in columns]
    raw = usable.select("customer_id", *columns, F.array(*whole).alias("raw"))
    mean, deviation = _moments(raw, len(columns))
    points = cut_lineage(raw.select("customer_id", *columns, F.array(*[_scaled(i, mean[i], deviation[i]) for i in range(len(columns))]).alias("point")))
    first = _first_centers(points, max(cluster_counts))
    counts = sorted({min(k, len(first)) for k in cluster_counts})
    if len(first) < 2:
        return Segmentation(METRICS_ONLY, metrics, metrics)
    centers: Centers = {k: first[:k] for k in counts}
    for _ in range(steps):
        moved = _step(points, centers)
        if moved == centers:
            break
        centers = moved
    spending = columns.index("total_spending") if "total_spending" in columns else 0
    centers = {k: sorted(c, key=lambda v: (v[spending], v)) for k, c in centers.items()}
    scores = _scores(points, centers)
    best = max(scores, key=lambda s: s.silhouette)  # the first of equal ones
    chosen = centers[best.k]
    customers = _labelled(points, {best.k: chosen}).select("customer_id", *columns, F.col("near")[0]["near"]["label"].alias(LABEL))
    scaled = [[v / UNIT for v in c] for c in chosen]
    plain = [[(m + d * v) / 10**digits for m, d, v in zip(mean, deviation, c)] for c in scaled]
    return Segmentation(SCALED, metrics, customers, best.k, scores, plain, scaled)


def _moments(raw: DataFrame, n: int) -> tuple[list[float], list[float]]:
    """Mean and sample deviation of each feature, from exact sums of values and squares."""
    exact = lambda c: c.cast("decimal(19,0)")
    value = [exact(F.col("raw")[i]) for i in range(n)]
    row = raw.agg(F.count(F.lit(1)), *[F.sum(v) for v in value], *[F.sum(v * v) for v in value]).first()
    count, sums, squares = row[0], [int(v or 0) for v in row[1 : n + 1]], [int(v or 0) for v in row[n + 1 :]]
    mean = [s / count if count else 0.0 for s in sums]
    spread = [math.sqrt((count * q - s * s) / (count * (count - 1))) if count > 1 else 0.0 for s, q in zip(sums, squares)]
    return mean, spread


def _scaled(i: int, mean: float, deviation: float) -> Column:
    if not deviation:
        return F.lit(0).cast("long")
    return F.floor((F.col("raw")[i].cast("double") - F.lit(mean)) / F.lit(deviation) * float(UNIT) + 0.5)


def _first_centers(points: DataFrame, n: int) -> list[tuple[int, ...]]:
    """Distinct points by the smallest digest of their customers' ids."""
    digest = F.md5(F.col("customer_id").cast("string").cast("binary"))
    rows = points.groupBy("point").agg(F.min(digest).alias("digest")).orderBy("digest", "point").limit(n).collect()
    return [tuple(r.point) for r in rows]


def _flat(points: DataFrame, centers: Centers) -> Column:
    """All centres as one array. A subquery, and not literals, so that the steps share their compiled code."""
    values = [v for own in centers.values() for c in own for v in c]
    return points.sparkSession.range(0, 1, 1, 1).select(F.expr(f"array({', '.join(f'{v}L' for v in values)})").alias("c")).scalar()


def _nearest(first: int, k: int, n: int) -> str:
    """SQL: distance (squared) and label of the nearest of k centres of n features, of equally near ones the first."""

    def distance(label: int) -> str:
        return " + ".join(f"(point[{i}] - centers[{c}]) * (point[{i}] - centers[{c}])" for i, c in enumerate(range(first + label * n, first + label * n + n)))

    return "array_min(array(" + ", ".join(f"named_struct('distance', {distance(j)}, 'label', {j})" for j in range(k)) + "))"


def _labelled(points: DataFrame, centers: Centers) -> DataFrame:
    """The points with ``near``: for each clustering k, label and distance of the nearest centre."""
    first, each = 0, []
    for k, own in centers.items():
        n = len(own[0])
        each.append(f"named_struct('k', {k}, 'near', {_nearest(first, len(own), n)})")
        first += len(own) * n
    return points.withColumn("centers", _flat(points, centers)).withColumn("near", F.expr(f"array({', '.join(each)})")).drop("centers")


def _sums(points: DataFrame, centers: Centers, *more: str) -> dict[tuple[int, int], tuple]:
    """Of each clustering and label: rows, sums of features, and what else is asked for."""
    n = len(next(iter(centers.values()))[0])
    rows = (
        _labelled(points, centers)
        .selectExpr("point", "explode(near) AS x")
        .selectExpr("x.k", "x.near.label", "x.near.distance", *[f"point[{i}] AS p{i}" for i in range(n)])
        .groupBy("k", "label")
        .agg(F.count(F.lit(1)), *[F.sum(f"p{i}") for i in range(n)], *[F.expr(e) for e in more])
        .collect()  # a row for each centre
    )
    return {(r[0], r[1]): (r[2], list(r[3 : n + 3]), *map(int, r[n + 3 :])) for r in rows}


def _step(points: DataFrame, centers: Centers) -> Centers:
    """Centres move to the mean of their points; one without points stays."""
    sums = _sums(points, centers)
    return {
        k: [tuple(math.floor(s / sums[k, j][0] + 0.5) for s in sums[k, j][1]) if (k, j) in sums else c for j, c in enumerate(own)]
        for k, own in centers.items()
    }


def _scores(points: DataFrame, centers: Centers) -> list[Score]:
    """Mean silhouette under squared Euclidean distance, and cost, of every clustering."""
    n = len(centers[min(centers)][0])
    square = " + ".join(f"CAST(p{i} AS decimal(19,0)) * CAST(p{i} AS decimal(19,0))" for i in range(n))
    sums = _sums(points, centers, f"sum({square})", "sum(CAST(distance AS decimal(19,0)))")
    length = sum((F.col("point")[i].cast("double") * F.col("point")[i].cast("double") for i in range(1, n)), F.col("point")[0].cast("double") * F.col("point")[0].cast("double"))

    def total(s: tuple) -> Column:
        """Of the squared distances from a point to all points of a cluster."""
        product = sum((F.col("point")[i].cast("double") * float(v) for i, v in enumerate(s[1][1:], 1)), F.col("point")[0].cast("double") * float(s[1][0]))
        return F.lit(float(s[2])) + float(s[0]) * length - 2.0 * product

    shares = []
    for place, (k, own) in enumerate(centers.items()):
        known = {j: sums[k, j] for j in range(len(own)) if (k, j) in sums}
        label = F.col("near")[place]["near"]["label"]
        inner = F.coalesce(*[F.when((label == j) & F.lit(s[0] > 1), total(s) / float(max(1, s[0] - 1))) for j, s in known.items()])
        outer = F.array_min(F.array(*[F.when(label != j, total(s) / float(s[0])) for j, s in known.items()]))
        share = F.when(inner.isNull() | (inner == outer), 0.0).when(inner < outer, 1 - inner / outer).otherwise(outer / inner - 1)
        shares.append(F.sum(F.round(share * float(_SHARE)).cast("decimal(19,0)")).alias(f"s{k}"))
    row = _labelled(points, centers).agg(F.count(F.lit(1)).alias("n"), *shares).first()
    return [
        Score(k, int(row[f"s{k}"]) / row.n / _SHARE, sum(s[3] for (q, _), s in sums.items() if q == k) / UNIT**2) for k in sorted(centers)
    ]

import pytest

from pyspark.sql import functions as F

from tillscope.operators import segments
from tillscope.schema import METRICS

SCHEMA = "customer_id string, total_orders bigint, total_spending double, unique_products bigint"


def metrics(spark, rows):
    return spark.createDataFrame([(f"c{i}", *r) for i, r in enumerate(rows)], SCHEMA)


def blobs(spark):
    """Three well separated groups of 20, 30 and 40 customers."""
    rows = []
    for size, centre in ((20, 10), (30, 100), (40, 1000)):
        rows += [(centre + i % 3, float(centre * 10 + i % 5), centre + i % 2) for i in range(size)]
    return metrics(spark, rows)


@pytest.fixture(scope="module")
def found(spark):
    return segments.segment(blobs(spark))


def test_chooses_the_separated_groups(found):
    assert found.status == segments.SCALED
    best = max(found.scores, key=lambda s: s.silhouette)
    assert found.k == best.k
    assert [s.k for s in found.scores] == [2, 3, 4, 5]
    costs = {s.k: s.cost for s in found.scores}
    assert costs[3] < costs[2]


def test_every_customer_once(found, spark):
    assert found.customers.count() == 90
    assert found.customers.select("customer_id").distinct().count() == 90
    labels = {r.prediction for r in found.customers.select("prediction").distinct().collect()}
    assert labels == set(range(found.k))


def test_labels_rise_with_spending(found):
    profile = segments.cluster_profile(found.customers, detailed=True, ordered=True).collect()
    assert [r.prediction for r in profile] == list(range(found.k))
    spending = [r.avg_spending for r in profile]
    assert spending == sorted(spending)
    assert sum(r.customer_count for r in profile) == 90
    for r in profile:
        assert r.avg_orders == pytest.approx(r.sum_orders / r.customer_count)
        assert r.avg_products == pytest.approx(r.sum_products / r.customer_count)


def test_centers_in_both_units(found):
    centers = {r.prediction: r for r in segments.center_table(found).collect()}
    for r in segments.cluster_profile(found.customers, detailed=True).collect():
        center = centers[r.prediction]
        assert center.center_total_spending == pytest.approx(r.avg_spending)
        assert center.center_total_orders == pytest.approx(r.avg_orders)


def test_score_table_marks_the_choice(found):
    rows = segments.score_table(found).collect()
    assert [r.k for r in rows if r.chosen] == [found.k]


def test_cost_is_stable_over_partitions(spark):
    data = blobs(spark)
    costs = [
        {s.k: s.cost for s in segments.segment(data.repartition(n), cluster_counts=(3,)).scores}[3]
        for n in (1, 5)
    ]
    assert costs[0] == pytest.approx(costs[1], rel=0.01)


def test_scaling(spark):
    df = segments.scaled_metrics(metrics(spark, [(1, 5.0, 10), (3, 5.0, 20), (5, 5.0, 30)]))
    rows = [tuple(r)[1:] for r in df.orderBy("customer_id").collect()]
    assert rows == [(-1.0, 0.0, -1.0), (0.0, 0.0, 0.0), (1.0, 0.0, 1.0)]


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, 2.0, 3)],
        [(1, 2.0, 3)] * 5,
        [(1, 2.0, 3), (4, None, 6)],
        [(1, float("nan"), 3), (4, 5.0, 6)],
        [(1, float("inf"), 3), (4, 5.0, 6)],
    ],
    ids=["empty", "one", "identical", "null", "nan", "infinite"],
)
def test_metrics_only(spark, rows):
    found = segments.segment(metrics(spark, rows))
    assert found.status == segments.METRICS_ONLY
    assert found.customers.columns == ["customer_id", *METRICS]
    assert found.customers.count() == len(rows)
    assert found.k is None and found.scores == []


def test_cluster_count_is_capped_by_distinct_points(spark):
    found = segments.segment(metrics(spark, [(1, 2.0, 3)] * 4 + [(5, 6.0, 7)] * 4))
    assert (found.status, found.k, [s.k for s in found.scores]) == (segments.SCALED, 2, [2])


def test_unscaled_when_scaling_overflows(spark):
    found = segments.segment(metrics(spark, [(1, 1e200, 3), (4, 3e200, 6), (5, -2e200, 8)]))
    assert found.status in (segments.UNSCALED, segments.METRICS_ONLY)
    assert found.customers.count() == 3


def test_customers_with_nulls_stay_out_of_clusters(spark):
    data = blobs(spark).union(metrics(spark, [(1, None, 2)]).withColumn("customer_id", F.lit("x")))
    data = data.union(metrics(spark, [(1, float("inf"), 2)]).withColumn("customer_id", F.lit("y")))
    found = segments.segment(data, cluster_counts=(3,))
    assert found.status == segments.SCALED
    assert found.customers.count() == 90 and found.metrics.count() == 92


def test_silhouette_by_brute_force(spark):
    points = [(0.0, 0.0, 0), (0.0, 1.0, 0), (4.0, 4.0, 1), (5.0, 4.0, 1), (9.0, 0.0, 2)]

    def mean_distance(i, label):
        x, y, _ = points[i]
        others = [
            (x - u) ** 2 + (y - v) ** 2
            for j, (u, v, c) in enumerate(points)
            if c == label and j != i
        ]
        return sum(others) / len(others) if others else None

    scores = []
    for i, (_, _, own) in enumerate(points):
        a = mean_distance(i, own)
        b = min(mean_distance(i, c) for c in {0, 1, 2} - {own})
        scores.append(0.0 if a is None else (b - a) / max(a, b))
    df = spark.createDataFrame(points, "x double, y double, label int")
    score = segments.silhouette(df, ["x", "y"], "label")
    assert score == pytest.approx(sum(scores) / len(scores), abs=1e-12)

import numpy as np
import pytest

from tillscope.operators import lloyd, segments

SCHEMA = "customer_id string, total_orders long, total_spending double, unique_products long"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = []
    for k in range(400):
        size = [5, 40, 200][k % 3]
        out.append((f"STD_{k}", int(rng.poisson(size)), float(round(rng.normal(size * 30, size * 4), 2)), int(rng.poisson(size / 2))))
    return out


def test_result_does_not_depend_on_partitions(spark, rows):
    found = []
    for parts, order in ((1, rows), (3, rows[::-1]), (8, rows)):
        result = lloyd.segment(spark.createDataFrame(order, SCHEMA).repartition(parts))
        found.append((result.k, result.scores, result.centers, sorted(map(tuple, result.customers.collect()))))
    assert found[0] == found[1] == found[2]
    k, scores, centers, customers = found[0]
    assert k == max(scores, key=lambda s: s.silhouette).k and len(centers) == k
    assert [s.k for s in scores] == [2, 3, 4, 5]
    assert [r[0] for r in customers] == sorted(r[0] for r in rows) and {r[4] for r in customers} == set(range(k))
    spending = [c[1] for c in centers]
    assert spending == sorted(spending)


def test_too_few_points(spark, rows):
    one = lloyd.segment(spark.createDataFrame(rows[:1], SCHEMA))
    assert (one.status, one.k, one.customers.count()) == (segments.METRICS_ONLY, None, 1)
    assert lloyd.segment(spark.createDataFrame([], SCHEMA)).status == segments.METRICS_ONLY
    same = [(f"c{k}", 3, 5.0, k % 2) for k in range(6)] + [("n", None, 1.0, 1), ("i", 1, float("inf"), 1)]
    two = lloyd.segment(spark.createDataFrame(same, SCHEMA))
    assert (two.status, two.k, len(two.scores)) == (segments.SCALED, 2, 1)
    assert sorted((r.customer_id, r.prediction) for r in two.customers.collect()) == [(f"c{k}", k % 2) for k in range(6)]

"""What the ladder decides is what the segmentation does."""

import pytest

from tillscope.operators import ladder, segments

CASES = {
    "one": [(1, 2.0, 3)],
    "equal": [(1, 2.0, 3)] * 5,
    "two": [(1, 2.0, 3)] * 4 + [(5, 6.0, 7)] * 4,
    "null": [(1, 2.0, 3), (4, None, 6)],
    "infinite": [(1, float("inf"), 3), (4, 5.0, 6)],
    "nan_beside_two": [(1, float("nan"), 3), (4, 5.0, 6), (7, 5.0, 6)],
    "many": [(k, float(k * k), k % 3) for k in range(30)],
}


@pytest.fixture(scope="module")
def rows(spark):
    flat = [(name, f"c{i}", *r) for name, own in CASES.items() for i, r in enumerate(own)]
    return spark.createDataFrame(
        flat + [("huge", f"c{i}", 1, x, 3) for i, x in enumerate((1e200, 3e200, -2e200))],
        "name string, customer_id string, total_orders long, total_spending double, unique_products long",
    )


@pytest.fixture(scope="module")
def found(rows):
    return {r.name: r for r in ladder.rungs(rows, "name").collect()}


@pytest.mark.parametrize("name", CASES)
def test_agrees_with_the_segmentation(rows, found, name):
    result = segments.segment(rows.filter(f"name = '{name}'").drop("name"))
    assert found[name].status == result.status
    assert found[name].most_clusters == max((s.k for s in result.scores), default=None)
    assert found[name].n_customers == len(CASES[name])


def test_beyond_scaling(found):
    r = found["huge"]
    assert (r.status, r.n_usable, r.n_points, r.most_clusters) == (segments.UNSCALED, 3, 3, 2)


def test_no_customers(rows):
    assert ladder.rungs(rows.limit(0), "name").count() == 0

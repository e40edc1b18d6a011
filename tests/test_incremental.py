import csv

import pytest

from tests.rows import CUSTOMER, GOOD
from tillscope import plans
from tillscope.schema import COLUMNS


def file(folder, name, *changes):
    with open(folder / name, "w", newline="") as out:
        writer = csv.DictWriter(out, COLUMNS)
        writer.writeheader()
        writer.writerows(GOOD | {"transaction_id": f"{name}_{i}"} | c for i, c in enumerate(changes))


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_two_runs_equal_one_over_all(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    out, pattern = f"{tmp_path}/out", f"{raw}/*.csv"
    options = {"expected_customer": CUSTOMER}
    file(raw, "a[1].csv", {}, {"quantity": "x"}, {"total_amount": "1"})
    first = plans.preprocess_new(spark, pattern, out, **options).first()
    assert (first.clean_rows, first.error_rows) == (2, 1)
    file(raw, "b c.csv", {"customer_id": "other"}, {})
    file(raw, "empty.csv")
    counts = plans.preprocess_new(spark, pattern, out, **options).first()
    once = plans.preprocess(spark, pattern, f"{tmp_path}/once", **options).first()
    assert tuple(counts) == tuple(once)
    from tillscope import sinks

    assert content(plans.all_clean(spark, out)) == content(sinks.read_clean(spark, f"{tmp_path}/once"))
    assert content(plans.all_rejected(spark, out)) == content(sinks.read_rejected(spark, f"{tmp_path}/once"))
    # Nothing new: nothing is written. Files that went away keep their rows.
    (raw / "a[1].csv").unlink()
    assert tuple(plans.preprocess_new(spark, pattern, out, **options).first()) == tuple(once)
    assert plans.taken_files(spark, out).select("batch").distinct().count() == 2


def test_a_changed_file_is_refused(spark, tmp_path):
    file(tmp_path, "a.csv", {})
    plans.preprocess_new(spark, f"{tmp_path}/*.csv", f"{tmp_path}/out")
    file(tmp_path, "a.csv", {}, {})
    with pytest.raises(ValueError, match="a.csv changed"):
        plans.preprocess_new(spark, f"{tmp_path}/*.csv", f"{tmp_path}/out")
    assert plans.all_clean(spark, f"{tmp_path}/out").count() == 1


def test_a_batch_without_its_lines_is_not_read(spark, tmp_path, monkeypatch):
    from tillscope.plans import incremental

    file(tmp_path, "a.csv", {}, {"quantity": "x"})
    done = incremental.write_validated

    def fails(*a):
        done(*a)
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "write_validated", fails)
    with pytest.raises(RuntimeError):
        plans.preprocess_new(spark, f"{tmp_path}/*.csv", f"{tmp_path}/out")
    with pytest.raises(ValueError):
        plans.all_clean(spark, f"{tmp_path}/out")
    monkeypatch.undo()
    counts = plans.preprocess_new(spark, f"{tmp_path}/*.csv", f"{tmp_path}/out").first()
    assert (counts.clean_rows, counts.error_rows) == (1, 1) and plans.all_clean(spark, f"{tmp_path}/out").count() == 1

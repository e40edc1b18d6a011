import os

import pytest
from pyspark.sql import functions as F

from tillscope.operators.ordering import inversions
from tillscope.sinks import publish, read_published, superseded


def days(spark, rows):
    return spark.createDataFrame(rows, "day string, period int")


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{path}/data/") for f in fs if f.endswith(".parquet")}


def test_a_day_is_replaced_alone(spark, tmp_path):
    path = f"{tmp_path}/t"
    publish(days(spark, [("a", 1), ("b", 2), (None, 3), ("c/d e=1", 4)]), path, "day")
    before = files(path)
    lines = publish(days(spark, [("b", 20), ("b", 21)]), path, "day").collect()
    assert [(r.period, r.number, r.rows) for r in lines] == [("b", 2, 2)]
    after = files(path)
    assert before.items() <= after.items()
    assert all("published_period=b/" in f for f in set(after) - set(before))
    assert content(read_published(spark, path)) == sorted([("a", 1), ("b", 20), ("b", 21), (None, 3), ("c/d e=1", 4)], key=str)
    assert [r.period for r in superseded(spark, path).collect()] == ["b"]


def test_a_failed_run_leaves_the_old_result(spark, tmp_path):
    path = f"{tmp_path}/t"
    publish(days(spark, [("a", 1)]), path)
    broken = days(spark, [("a", 5), ("a", 0)]).repartition(2).withColumn("period", F.expr("CAST(10 div period AS INT)"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        publish(broken, path)
    assert content(read_published(spark, path)) == [("a", 1)]


def test_whole_empty_and_expected_periods(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(ValueError):
        read_published(spark, path)
    publish(days(spark, [("a", 1), ("b", 2)]), path, "day")
    publish(days(spark, []), path, "day", ["a"])
    assert content(read_published(spark, path)) == [("b", 2)]
    publish(days(spark, []), path, "day", ["b"])
    assert read_published(spark, path).columns == ["day", "period"] and read_published(spark, path).count() == 0
    other = f"{tmp_path}/whole"
    for rows in ([("a", 1)], [], [("z", 9), ("z", 9)]):
        publish(days(spark, rows), other)
        assert content(read_published(spark, other)) == rows
    with pytest.raises(ValueError):
        publish(days(spark, []).withColumn("published_period", F.lit(1)), other)


def test_inversions(spark, tmp_path):
    numbers = spark.range(0, 1000, 1, 4).withColumn("id", F.when(F.col("id") > 0, F.col("id")))
    numbers.write.parquet(f"{tmp_path}/up")
    up = spark.read.parquet(f"{tmp_path}/up")
    assert tuple(inversions(up, ["id"], 16).first()) == (4, 1000, 0)
    assert inversions(up, ["-id"], 16).first().inversions == 999
    swapped = numbers.withColumn("id", F.when(F.col("id") == 500, 10).when(F.col("id") == 700, 1).when(F.col("id") == 16, 3).otherwise(F.col("id")))
    swapped.write.parquet(f"{tmp_path}/wrong")
    assert inversions(spark.read.parquet(f"{tmp_path}/wrong"), ["id"], 16).first().inversions == 3
    assert tuple(inversions(up.filter("false"), ["id"]).first()) == (0, 0, 0)
    down = numbers.withColumn("g", F.lit("x")).orderBy(F.col("g"), F.col("id").desc())
    down.write.parquet(f"{tmp_path}/down")
    assert inversions(spark.read.parquet(f"{tmp_path}/down"), ["g", "-id"], 16).first().inversions == 0

import math
from bisect import bisect_right

import pytest
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from ledgerloom.operators.ranges import bucket_column, bucketize, numeric_ranges, split_points


def test_one_pass_gives_the_range_of_every_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (9.0, None), (3.0, -3.0)], "a double, `b c` double")
    ranges = numeric_ranges(df, ["a", "b c"])
    assert [tuple(row) for row in ranges.collect()] == [("a", 1.0, 9.0, 2.0), ("b c", -3.0, 5.0, 2.0)]


def test_nan_is_not_part_of_a_range(spark):
    df = spark.createDataFrame([(math.nan,), (2.0,), (1.0,)], "a double")
    assert tuple(numeric_ranges(df, ["a"]).first()) == ("a", 1.0, 2.0, 0.25)


def test_split_points():
    assert split_points({"a": (0.0, 4.0)})["a"] == [-math.inf, 0.0, 1.0, 2.0, 3.0, 4.0, math.inf]
    assert split_points({"a": (7.0, 7.0)})["a"] == [-math.inf, 7.0, math.inf]


def test_split_points_of_neighbouring_doubles_still_increase():
    high = math.nextafter(1.0, 2.0)
    points = split_points({"a": (1.0, high)})["a"]
    assert all(a < b for a, b in zip(points, points[1:]))


@pytest.mark.parametrize("bounds", [(None, None), (-math.inf, 1.0), (0.0, math.inf), (-1e308, 1e308)])
def test_column_without_finite_range_is_named(bounds):
    with pytest.raises(ValueError, match="amount"):
        split_points({"amount": bounds})


def test_bucket_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (0.999,), (4.0,), (3.999,), (None,)], "a double").coalesce(1)
    assert [row[1] for row in bucketize(df, ["a"]).collect()] == [1.0, 2.0, 1.0, 5.0, 4.0, None]


def test_values_outside_the_range_have_buckets(spark):
    splits = split_points({"a": (0.0, 4.0)})["a"]
    df = spark.createDataFrame([(-0.1,), (99.0,), (math.inf,), (-math.inf,)], "a double").coalesce(1)
    assert [row[0] for row in df.select(bucket_column("a", splits)).collect()] == [0.0, 5.0, 5.0, 0.0]


def test_constant_column_is_bucket_one(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "a double")
    assert {row[1] for row in bucketize(df, ["a"]).collect()} == {1.0}


def test_empty_and_all_null_columns_are_named(spark):
    for rows in ([], [(None,)], [(math.nan,)]):
        with pytest.raises(ValueError, match="a: no value"):
            bucketize(spark.createDataFrame(rows, "a double"), ["a"])


def test_nan_raises_or_is_kept(spark):
    df = spark.createDataFrame([(math.nan,), (0.0,), (4.0,)], "a double").coalesce(1)
    assert [row[1] for row in bucketize(df, ["a"], nan="keep").collect()] == [6.0, 1.0, 5.0]
    with pytest.raises(Exception, match="a is NaN"):
        bucketize(df, ["a"]).collect()


def test_equals_spark_stage_and_brute_force(spark):
    df = spark.range(4000).select("id", (F.randn(3) * 1e3).alias("a"), F.rand(5).alias("b")).cache()
    out = bucketize(df, ["a", "b"])
    lows = df.agg(F.struct(F.min("a"), F.max("a")), F.struct(F.min("b"), F.max("b"))).first()
    points = split_points(dict(zip("ab", lows)))
    stage = Bucketizer(
        inputCols=["a", "b"], outputCols=["a_s", "b_s"], splitsArray=[points["a"], points["b"]]
    )
    for row in stage.transform(out).collect():
        for name in "ab":
            assert row[f"{name}_bucket"] == row[f"{name}_s"]
            assert row[f"{name}_bucket"] == bisect_right(points[name], row[name]) - 1
    df.unpersist()

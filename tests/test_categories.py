from collections import Counter

import pytest
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

from ledgerloom.operators.categories import (
    category_frequency,
    category_ranks,
    one_hot_entries,
    rank_size,
    string_index,
)
from ledgerloom.operators.vectors import vector_entries
from ledgerloom.plans.stages import CategoryModel


def _brute_ranks(values):
    counted = Counter(v for v in values if v is not None)
    ordered = sorted(counted.items(), key=lambda item: (-item[1], item[0].encode()))
    return {value: (n, idx) for idx, (value, n) in enumerate(ordered)}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one category, a tenth are NULL, the rest have thousands."""
    cat = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 10 == 1, None)
        .otherwise(F.concat(F.lit("c"), (F.col("id") % 4001).cast("string")))
    )
    df = spark.range(20000).select("id", cat.alias("cat")).cache()
    yield df
    df.unpersist()


def test_ties_rank_alphabetically(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", None]], "cat string")
    ranks = {row.value: (row.n, row.idx) for row in category_frequency(df, "cat").collect()}
    assert ranks == {"c": (2, 0), "a": (1, 1), "b": (1, 2)}


def test_ranks_over_many_sorted_parts(spark, skewed):
    ranks = {row.value: (row.n, row.idx) for row in category_frequency(skewed, "cat").collect()}
    assert ranks == _brute_ranks(row.cat for row in skewed.collect())


@pytest.mark.parametrize("name", ["value", "n", "idx", "slot", "part", "start", "odd `name"])
def test_any_column_name_can_be_ranked(spark, name):
    df = spark.createDataFrame([("x",), ("y",), ("x",)], "v string").withColumnRenamed("v", name)
    assert {row.value: row.idx for row in category_frequency(df, name).collect()} == {"x": 0, "y": 1}


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_index_is_whole_and_right_on_every_join_path(no_auto_broadcast, skewed, limit):
    out = string_index(skewed, "cat", broadcast_bytes=limit)
    assert out.columns == ["id", "cat", "cat_idx"]
    rows = skewed.collect()
    expected = _brute_ranks(row.cat for row in rows)
    want = {row.id: None if row.cat is None else float(expected[row.cat][1]) for row in rows}
    got = [(row.id, row.cat_idx) for row in out.collect()]
    assert len(got) == len(want)
    assert dict(got) == want


def _rows_per_task(spark, frame):
    """Rows that each task holds after the join with the ranks."""
    return [row["count"] for row in frame.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("hot", ["long", "unseen"])
def test_hot_values_are_spread_whatever_their_length(no_auto_broadcast, hot):
    spark = no_auto_broadcast
    value = "x" * 5000 if hot == "long" else "unseen"
    cat = F.when(F.col("id") % 2 == 0, F.lit(value)).otherwise(F.concat(F.lit("c"), (F.col("id") % 997).cast("string")))
    df = spark.range(8000).select("id", cat.alias("cat"))
    ranks = category_frequency(df if hot == "long" else df.where("id % 2 = 1"), "cat")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = string_index(df, "cat", "i", ranks, broadcast_bytes=0)
        tasks = _rows_per_task(spark, found)
        assert max(tasks) <= 2 * sum(tasks) / 8
        want = {row.value: float(row.idx) for row in ranks.collect()}
        assert all(row.i == want.get(row.cat) for row in found.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_numbers_can_be_categories(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS cat")
    for limit in (1 << 20, 0):
        got = string_index(df, "cat", "i", broadcast_bytes=limit).collect()
        assert {(row.cat, row.i) for row in got} == {(c, float(c)) for c in range(7)}
        assert len(got) == 100


def test_rank_tables_are_measured(spark, skewed):
    ranks = category_frequency(skewed, "cat")
    size = rank_size(ranks)
    assert size.categories == ranks.count()
    assert size.rows == skewed.where("cat IS NOT NULL").count()


def test_unranked_category_has_no_index(spark):
    known = spark.createDataFrame([("x",)], "cat string")
    ranks = category_frequency(known, "cat")
    other = spark.createDataFrame([("x",), ("zz",), (None,)], "cat string")
    for limit in (1 << 20, 0):
        got = string_index(other, "cat", "i", ranks, broadcast_bytes=limit).collect()
        assert sorted((row.cat or "", row.i) for row in got) == [("", None), ("x", 0.0), ("zz", None)]


def _indexed(df, columns, other=None, keep=False):
    return CategoryModel.fit_on(df, columns, keep).transform(df if other is None else other)


def test_indexes_are_those_spark_fits(spark, skewed):
    df = skewed.where("cat IS NOT NULL").withColumn("b", F.substring("cat", -1, 1))
    theirs = StringIndexer(inputCols=["cat", "b"], outputCols=["cat_idx", "b_idx"]).fit(df).transform(df)
    assert _indexed(df, ["cat", "b"]).exceptAll(theirs).count() == 0


def test_ranks_of_several_columns(spark):
    df = spark.createDataFrame([("x", "q"), ("y", None), ("y", "p")], "a string, `b c` string")
    found = {(row.field, row.value): row.idx for row in category_ranks(df, ["a", "b c"]).collect()}
    assert found == {("a", "y"): 0, ("a", "x"): 1, ("b c", "p"): 0, ("b c", "q"): 1}


def test_column_without_category_is_named(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    with pytest.raises(ValueError, match="no category in b"):
        CategoryModel.fit_on(df, ["a", "b"])


def test_unseen_category_raises_or_is_kept(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",)], "cat string")
    other = spark.createDataFrame([("zz",), (None,), ("y",)], "cat string").coalesce(1)
    kept = _indexed(df, ["cat"], other, keep=True)
    assert sorted((row.cat or "", row.cat_idx) for row in kept.collect()) == [("", 2.0), ("y", 1.0), ("zz", 2.0)]
    assert kept.schema["cat_idx"].metadata["ml_attr"]["num_vals"] == 3
    with pytest.raises(Exception, match="zz|NULL|null"):
        _indexed(df, ["cat"], other).collect()


def test_one_category_has_no_position(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "id long, cat string")
    entries = one_hot_entries(string_index(df, "cat", "i"), "id", "i", 1)
    assert entries.dtypes == [("id", "bigint"), ("size", "int"), ("pos", "int"), ("value", "double")]
    assert sorted(map(tuple, entries.collect())) == [(1, 0, None, None), (2, 0, None, None)]


@pytest.mark.parametrize("values", [["c", "c", "a", "b"], ["p", "q"]])
def test_one_hot_rows_equal_the_encoder(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id long, cat string")
    indexed = _indexed(df, ["cat"])
    encoded = OneHotEncoder(inputCol="cat_idx", outputCol="v").fit(indexed).transform(indexed)
    ours = one_hot_entries(string_index(df, "cat", "i"), "id", "i", len(set(values)))
    theirs = vector_entries(encoded, "id", "v")
    assert ours.dtypes == theirs.dtypes
    assert {tuple(row) for row in ours.collect()} == {tuple(row) for row in theirs.collect()}


def test_one_hot_of_many_categories_keeps_one_row_per_row(spark, skewed):
    known = skewed.where("cat IS NOT NULL")
    ranks = category_frequency(known, "cat")
    count = ranks.count()
    entries = one_hot_entries(string_index(known, "cat", "i", ranks), "id", "i", count)
    assert entries.count() == known.count()
    assert entries.where(f"size <> {count - 1}").count() == 0
    dropped = known.where(F.col("cat") == ranks.where(F.col("idx") == count - 1).first()["value"])
    assert entries.where("pos IS NULL").count() == dropped.count()

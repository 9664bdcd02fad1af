import math

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from ledgerloom.operators.vectors import vector_entries

SCHEMA = T.StructType([T.StructField("odd key", T.LongType()), T.StructField("v", VectorUDT())])


@pytest.mark.parametrize(
    ("vector", "entries"),
    [
        (Vectors.dense([0.0, 2.0, -1.0]), [(3, 1, 2.0), (3, 2, -1.0)]),
        (Vectors.sparse(5, [1, 4], [7.0, 0.0]), [(5, 1, 7.0)]),
        (Vectors.dense([0.0, 0.0]), [(2, None, None)]),
        (Vectors.sparse(1_000_000_000, [999_999_999], [1.0]), [(1_000_000_000, 999_999_999, 1.0)]),
        (Vectors.sparse(3, [], []), [(3, None, None)]),
        (Vectors.dense([]), [(0, None, None)]),
        (None, [(None, None, None)]),
    ],
)
def test_entries(spark, vector, entries):
    rows = vector_entries(spark.createDataFrame([(9, vector)], SCHEMA), "odd key", "v").collect()
    assert [tuple(row) for row in rows] == [(9, *entry) for entry in entries]


def test_nan_is_an_entry(spark):
    df = spark.createDataFrame([(1, Vectors.dense([math.nan]))], SCHEMA)
    (row,) = vector_entries(df, "odd key", "v").collect()
    assert row.pos == 0 and math.isnan(row.value)

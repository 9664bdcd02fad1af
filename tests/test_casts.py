from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.casts import decimal_columns, decimals_to_double, label_column, to_timestamp
from ledgerloom.operators.schema import schema_report


def test_decimals_become_doubles_in_place(spark):
    df = spark.createDataFrame(
        [(1, Decimal("12.34"), "a", Decimal("1.5")), (2, None, "b", None)],
        "id int, amount decimal(10,2), note string, `odd name` decimal(38,18)",
    )
    assert decimal_columns(df.schema) == ["amount", "odd name"]
    out = decimals_to_double(df)
    assert out.dtypes == [("id", "int"), ("amount", "double"), ("note", "string"), ("odd name", "double")]
    assert [tuple(row) for row in out.orderBy("id").collect()] == [(1, 12.34, "a", 1.5), (2, None, "b", None)]


def test_frame_without_decimals_is_unchanged(spark):
    df = spark.range(3)
    assert decimals_to_double(df) is df


@pytest.mark.parametrize(
    ("sql_type", "values", "labels"),
    [
        ("boolean", [True, False, None], [1.0, 0.0, None]),
        ("int", [1, 0, 2, None], [1.0, 0.0, 2.0, None]),
        ("bigint", [1, 0], [1.0, 0.0]),
        ("double", [1.0, 0.5], [1.0, 0.5]),
        ("decimal(3,1)", [Decimal("1.0"), Decimal("0.0")], [1.0, 0.0]),
    ],
)
def test_label(spark, sql_type, values, labels):
    df = spark.createDataFrame([(v,) for v in values], f"t {sql_type}").coalesce(1)
    assert [row[0] for row in df.select(label_column(df.schema, "t")).collect()] == labels


def test_text_label_is_refused(spark):
    df = spark.createDataFrame([("1",)], "t string")
    with pytest.raises(ValueError, match="target t must be boolean or numeric"):
        label_column(df.schema, "t")


def test_text_to_timestamp(spark):
    df = spark.createDataFrame([("2024-02-29 23:59:58.5",), (None,)], "t string").coalesce(1)
    assert [r[0] for r in df.select(to_timestamp("t").cast("timestamp_ntz")).collect()] == [
        datetime(2024, 2, 29, 23, 59, 58, 500000),
        None,
    ]


def test_bad_text_raises_or_is_null(spark):
    df = spark.createDataFrame([("yesterday",)], "t string")
    assert df.select(to_timestamp("t", strict=False)).first()[0] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(to_timestamp("t")).collect()


def test_schema_report(spark):
    df = spark.range(1).withColumn("amount", F.lit(Decimal("1.20")))
    rows = [tuple(row) for row in schema_report(df).orderBy("pos").collect()]
    assert rows == [(0, "id", "bigint", False), (1, "amount", "decimal(3,2)", False)]

"""Casts that bring source columns to the types the features need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.dates import quote


def decimal_columns(schema: T.StructType) -> list[str]:
    """Names of the decimal columns of a schema."""
    return [field.name for field in schema if isinstance(field.dataType, T.DecimalType)]


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Every decimal column as double, same name and place; NULL stays NULL."""
    decimals = set(decimal_columns(df.schema))
    if not decimals:
        return df
    return df.select(
        *[
            F.col(quote(name)).cast("double").alias(name) if name in decimals else F.col(quote(name))
            for name in df.columns
        ]
    )


def label_column(schema: T.StructType, target: str) -> Column:
    """The target as a double 0.0 / 1.0 label; booleans count as 0 and 1."""
    data_type = schema[target].dataType
    column = F.col(quote(target))
    if isinstance(data_type, T.BooleanType):
        return column.cast("int").cast("double")
    if isinstance(data_type, T.NumericType):
        return column.cast("double")
    raise ValueError(f"target {target} must be boolean or numeric, not {data_type.simpleString()}")


def to_timestamp(column: str, strict: bool = True) -> Column:
    """The column as a timestamp. A bad string raises, or is NULL when not ``strict``."""
    source = F.col(quote(column))
    return source.cast("timestamp") if strict else source.try_cast("timestamp")

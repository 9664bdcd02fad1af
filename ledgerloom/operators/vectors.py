"""Vector columns as plain rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import quote


def vector_entries(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(key, size, pos, value)`` for every position of a row's vector that is not zero.

    Sparse vectors are not filled up, so a one-hot vector gives one row whatever
    its size. A vector of zeros only keeps its row, with NULL ``pos`` and ``value``.
    """
    raw = F.unwrap_udt(F.col(quote(vector)))
    values = raw["values"]
    only_zeros = (F.array_max(values) == 0) & (F.array_min(values) == 0)
    stored = df.select(
        quote(key),
        F.coalesce(raw["size"], F.array_size(values)).alias("size"),
        raw["indices"].alias("indices"),
        F.posexplode_outer(F.when(only_zeros, F.array().cast("array<double>")).otherwise(values)).alias("at", "value"),
    )
    return stored.where("value <> 0 OR value IS NULL").select(
        quote(key), "size", F.coalesce(F.get("indices", "at"), "at").alias("pos"), "value"
    )

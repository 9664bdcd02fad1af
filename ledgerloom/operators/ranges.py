"""Value ranges of numeric columns and equal-width buckets over them."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import quote

# Fixed value: equal steps between the smallest and the largest value.
STEPS = 4


def range_column(column: str) -> Column:
    """Aggregate ``struct(mn, mx)`` of a column; NaN is no value here, it would win every max."""
    value = F.nanvl(F.col(quote(column)), F.lit(None).cast("double"))
    return F.struct(F.min(value).alias("mn"), F.max(value).alias("mx"))


def numeric_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(field, mn, mx, step)``, one row per column, from one pass over ``df``."""
    ranges = df.agg(*[range_column(name).alias(f"range_{pos}") for pos, name in enumerate(columns)])
    entries = [
        F.struct(
            F.lit(name).alias("field"),
            F.col(f"range_{pos}.mn").alias("mn"),
            F.col(f"range_{pos}.mx").alias("mx"),
            ((F.col(f"range_{pos}.mx") - F.col(f"range_{pos}.mn")) / STEPS).alias("step"),
        )
        for pos, name in enumerate(columns)
    ]
    return ranges.select(F.inline(F.array(*entries)))


def split_points(ranges: Mapping[str, tuple[float | None, float | None]]) -> dict[str, list[float]]:
    """Bucket borders per column, from its ``(mn, mx)``.

    Borders are -inf, the minimum, the three inner steps, the maximum and +inf.
    Equal borders (a constant column) are merged, which leaves -inf, the value
    and +inf. A column without a finite range is a ``ValueError``.
    """
    points = {}
    for name, (low, high) in ranges.items():
        if low is None or high is None:
            raise ValueError(f"{name}: no value to take a range from")
        step = (high - low) / STEPS
        inner = [low + i * step for i in range(STEPS)]
        if not all(math.isfinite(point) for point in [*inner, high]):
            raise ValueError(f"{name}: range from {low} to {high} is not finite")
        points[name] = [-math.inf, *sorted({*inner, high}), math.inf]
    return points


def fit_split_points(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """Bucket borders of every column, from one pass over ``df`` that returns one row."""
    ranges = df.agg(*[range_column(name).alias(f"range_{pos}") for pos, name in enumerate(columns)]).first()
    return split_points(dict(zip(columns, ranges)))


def bucket_column(column: str, splits: Sequence[float], nan: str = "error") -> Column:
    """Bucket number as double: i where ``splits[i] <= value < splits[i + 1]``.

    NULL stays NULL. NaN raises, or with ``nan="keep"`` gets a bucket of its own
    after the others.
    """
    value = F.col(quote(column))
    last = len(splits) - 2
    if nan == "keep":
        bucket = F.when(F.isnan(value), F.lit(float(last + 1)))
    else:
        bucket = F.when(F.isnan(value), F.raise_error(F.lit(f"{column} is NaN")).cast("double"))
    for i, border in enumerate(splits[1:-1]):
        bucket = bucket.when(value < border, F.lit(float(i)))
    return bucket.when(value.isNotNull(), F.lit(float(last)))


def bucketize(df: DataFrame, columns: Sequence[str], nan: str = "error") -> DataFrame:
    """``df`` plus ``<column>_bucket`` for every column.

    The borders are literals by then, so this is a plain projection without any join.
    """
    points = fit_split_points(df, columns)
    return df.withColumns({f"{name}_bucket": bucket_column(name, points[name], nan) for name in columns})

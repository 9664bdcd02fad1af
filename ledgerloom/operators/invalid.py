"""Counts of values that features cannot be built from, by field and kind, taken along with another pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.casts import to_timestamp
from ledgerloom.functions.dates import quote

#: What a value may be: absent, not a number, a text that is no date, a category that training has not seen.
KINDS = ("null", "nan", "unparsed", "unseen")


def source_counts(schema: T.StructType, fields: Sequence[str], dates: Sequence[str] = ()) -> list[Column]:
    """Aggregates ``<kind>:<field>`` over source rows, to be computed or observed.

    ``null`` for every field, ``nan`` for floating point numbers, and ``unparsed`` for
    those of ``dates`` that are texts.
    """
    found = []
    for name in fields:
        value, kind = F.col(quote(name)), schema[name].dataType
        found.append(F.count_if(value.isNull()).alias(f"null:{name}"))
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            found.append(F.count_if(F.isnan(value)).alias(f"nan:{name}"))
        if name in dates and isinstance(kind, T.StringType):
            bad = value.isNotNull() & to_timestamp(name, strict=False).isNull()
            found.append(F.count_if(bad).alias(f"unparsed:{name}"))
    return found


def unseen_counts(categories: Mapping[str, int]) -> list[Column]:
    """Aggregates ``unseen:<field>`` over indexed rows; ``categories`` has the number of known ones by field."""
    return [
        F.count_if(F.col(quote(name)).isNotNull() & (F.col(quote(f"{name}_idx")) >= known)).alias(f"unseen:{name}")
        for name, known in categories.items()
    ]


def count_rows(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """``field, kind, n`` from counts by ``<kind>:<field>``; one row for each, zeros included."""
    split = [(*reversed(key.split(":", 1)), n) for key, n in counts.items() if ":" in key]
    if not split:
        return spark.sql("SELECT '' AS field, '' AS kind, 0L AS n").where("false")
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(k).alias("kind"), F.lit(n).cast("long").alias("n")) for f, k, n in split])
    # Built from literals, so that reading it is no job.
    return spark.sql("SELECT 1").select(F.inline(rows))

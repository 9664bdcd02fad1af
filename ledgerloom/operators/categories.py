"""Frequency ranks of text columns, and the index and one-hot forms built on them.

Nothing here depends on how many categories there are: ranks come from a
range-parted sort, categories never reach the driver, and a lookup table too
large to broadcast is joined by a shuffle that spreads the frequent categories.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import quote
from ledgerloom.session import drop_table, shared_table

# A lookup table up to this many bytes is broadcast.
BROADCAST_BYTES = 8 * 1024 * 1024

# monotonically_increasing_id keeps the partition above this bit, the row below it.
_PARTITION_BIT = 33


def _ranked(counted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``counted`` (``value``, ``n`` and the columns ``by``) plus ``idx``, the rank within ``by``.

    The ranks come from a global sort, range-parted on (count, value) so that no
    task holds an unbounded run, plus the start of every part. The sorted counts
    are written once, as both uses must see the same parts.
    """
    ordered = shared_table(
        counted.orderBy(*by, F.desc("n"), F.asc("value")).withColumn("slot", F.monotonically_increasing_id())
    )
    part = F.shiftright("slot", _PARTITION_BIT)
    # One row per sorted part: at most spark.sql.shuffle.partitions rows, and one for each column.
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ordered.groupBy(*by, part.alias("part"))
        .agg(F.count("*").alias("size"), F.min("slot").alias("first"))
        .select(*by, "part", "first", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    )
    ranks = shared_table(
        ordered.withColumn("part", part)
        .join(F.broadcast(starts), [*by, "part"])
        .select(*by, "value", "n", (F.col("start") + F.col("slot") - F.col("first")).alias("idx"))
    )
    drop_table(ordered)
    return ranks


def category_frequency(df: DataFrame, column: str) -> DataFrame:
    """``(value, n, idx)``: every category, its rows, and its rank, 0 for the most frequent.

    Ties rank alphabetically; NULL is no category. Counts combine before the shuffle.
    """
    values = df.select(F.col(quote(column)).alias("value")).where(F.col("value").isNotNull())
    return _ranked(values.groupBy("value").agg(F.count("*").alias("n")))


def category_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(field, value, n, idx)``: ``category_frequency`` of several text columns from one pass.

    The columns are unpivoted and counted by (field, value), so counts combine
    before the shuffle.
    """
    values = df.unpivot([], [F.col(quote(name)) for name in columns], "field", "value")
    counted = values.where(F.col("value").isNotNull()).groupBy("field", "value").agg(F.count("*").alias("n"))
    return _ranked(counted, ["field"])


@dataclass(frozen=True)
class RankSize:
    """What decides how a rank table is joined: categories, bytes, and rows counted."""

    categories: int
    bytes: int
    rows: int


def _size_columns() -> list[Column]:
    length = F.octet_length(F.col("value").cast("string"))
    return [
        F.count("*").alias("categories"),
        F.coalesce(F.sum(length + 16), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    ]


def rank_size(ranks: DataFrame) -> RankSize:
    """Measure a rank table; one row comes back."""
    return RankSize(*ranks.agg(*_size_columns()).first())


def field_size(ranks: DataFrame, field: str) -> RankSize:
    """Measure one column's part of ``category_ranks``; one row comes back."""
    return rank_size(ranks.where(F.col("field") == field))


def _digest(column: str) -> list[Column]:
    """128 bits of a value, so that a lookup is as narrow for long values as for short ones."""
    value = F.col(column).cast("string")
    return [F.xxhash64(value), F.xxhash64(F.lit(1), value)]


def string_index(
    df: DataFrame,
    column: str,
    output: str | None = None,
    ranks: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    size: RankSize | None = None,
) -> DataFrame:
    """``df`` plus the category's rank as double; NULL for NULL or for an unranked category.

    A small rank table is broadcast. Beyond ``broadcast_bytes`` categories that
    alone would fill a shuffle partition are counted on ``df`` itself, so there are
    fewer of them than partitions; they, ranked or not, are looked up by digest in
    a broadcast, and their rows, like those of NULL, are not shuffled. The other
    rows, in a scan of their own, are shuffled to the ranks. So ``df`` must give the
    same rows each time it is read.
    """
    output = output or f"{column}_idx"
    if output in df.columns:
        raise ValueError(f"column {output} exists already")
    ranks = category_frequency(df, column) if ranks is None else ranks
    size = size or rank_size(ranks)
    columns = [F.col(quote(name)) for name in df.columns]
    lookup = ranks.select(F.col("value").alias("_rank_value"), F.col("idx").cast("double").alias("_rank_idx"))
    if size.bytes <= broadcast_bytes:
        same = F.col(quote(column)) == F.col("_rank_value")
        joined = df.join(F.broadcast(lookup), same, "left")
        return joined.select(*columns, F.col("_rank_idx").alias(output))
    first, second = _digest(quote(column))
    keyed = df.withColumns({"_rank_first": first, "_rank_second": second})
    hot = _hot_values(df, column).join(lookup, F.col("value") == F.col("_rank_value"), "left")
    first, second = _digest("value")
    hot = hot.select(
        first.alias("_rank_first"), second.alias("_rank_second"),
        F.lit(True).alias("_rank_hot"), F.col("_rank_idx").alias("_rank_hot_idx"),
    )
    marked = keyed.join(F.broadcast(hot), ["_rank_first", "_rank_second"], "left")
    settled = F.col("_rank_hot").isNotNull() | F.col(quote(column)).isNull()
    # Settled rows stay where they are; the others are read once more, and no value is frequent among them.
    done = marked.where(settled).select(*columns, F.col("_rank_hot_idx").alias(output))
    same = F.col(quote(column)) == F.col("_rank_value")
    rest = marked.where(~settled).join(lookup, same, "left")
    return done.unionByName(rest.select(*columns, F.col("_rank_idx").alias(output)))


def _hot_values(df: DataFrame, column: str) -> DataFrame:
    """``value`` of the categories with more rows than a shuffle partition holds on average."""
    counted = (
        df.select(F.col(quote(column)).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count("*").alias("n"))
    )
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.where(F.col("n") * parts > total).select("value")


def one_hot_entries(indexed: DataFrame, key: str, index: str, categories: int) -> DataFrame:
    """``(key, size, pos, value)`` of the one-hot vector of each row, last category dropped.

    One row per input row, however many categories there are: ``pos`` is where
    the 1.0 stands among the ``size`` positions, NULL for the dropped category.
    """
    size = max(categories - 1, 0)
    rank = F.col(quote(index))
    return indexed.select(
        quote(key),
        F.lit(size).alias("size"),
        F.when(rank < size, rank.cast("int")).alias("pos"),
        F.when(rank < size, F.lit(1.0)).alias("value"),
    )

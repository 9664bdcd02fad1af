"""Partitioned read of one table, or of one parenthesised query, over JDBC."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.predicates import ask_database, even_predicates


@dataclass(frozen=True)
class JdbcTable:
    """Where the table is and how to split its read.

    ``partition_column`` splits the range of a number, date or timestamp evenly.
    Where that column is unevenly filled, ``even_rows`` has the database count its
    rows by cells of the column, which must then be SQL for a whole number, and
    splits the rows evenly; the rows of one key only if ``spread``, SQL for another
    whole number that is not negative, tells them apart. Or give ``predicates``: one
    WHERE condition per task, together covering every row exactly once. A small
    table may be read by one task if ``single_task`` says so.
    """

    url: str
    table: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = "org.postgresql.Driver"
    partition_column: str | None = None
    num_partitions: int | None = None
    lower_bound: str | int | None = None
    upper_bound: str | int | None = None
    predicates: Sequence[str] | None = None
    fetch_size: int = 10_000
    single_task: bool = False
    even_rows: bool = False
    spread: str | None = None

    def __post_init__(self) -> None:
        if self.predicates is not None and self.partition_column is not None:
            raise ValueError("give either predicates or partition_column, not both")
        if self.single_task == (self.predicates is not None or self.partition_column is not None):
            raise ValueError("give partition_column or predicates, or single_task=True without them")
        if self.predicates is not None and not self.predicates:
            raise ValueError("predicates must hold at least one condition")
        if (self.partition_column is None) != (self.num_partitions is None):
            raise ValueError("partition_column and num_partitions go together")
        if (self.lower_bound is None) != (self.upper_bound is None):
            raise ValueError("lower_bound and upper_bound go together")
        if self.lower_bound is not None and self.partition_column is None:
            raise ValueError("bounds need a partition_column")
        if self.even_rows and (self.partition_column is None or self.lower_bound is not None):
            raise ValueError("even_rows needs a partition_column, and no bounds")
        if self.spread is not None and not self.even_rows:
            raise ValueError("spread needs even_rows")


def connection_options(source: JdbcTable) -> dict[str, str]:
    """Connection options; credentials stay out of the URL, so out of logs and plans."""
    options = {"url": source.url, "driver": source.driver, "fetchsize": str(source.fetch_size)}
    if source.user is not None:
        options["user"] = source.user
    if source.password is not None:
        options["password"] = source.password
    return options


def bounds_query(source: JdbcTable) -> str:
    """Query for the smallest and largest value of the partition column.

    ``table`` stands as Spark itself puts it after FROM, so a parenthesised query
    brings its own alias.
    """
    column = source.partition_column
    return f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {source.table}) bounds"


def read_jdbc(spark: SparkSession, source: JdbcTable) -> DataFrame:
    """The table as a DataFrame; filters and column choice reach the database.

    Bounds that are not given are asked of the database once, as one row. They
    only set the split points: rows outside them, and NULLs, are still read.
    """
    options = connection_options(source)
    predicates = source.predicates
    if source.even_rows:
        ask = ask_database(spark, options, source.table)
        predicates = even_predicates(ask, source.partition_column, source.num_partitions, source.spread)
    if predicates is not None:
        url = options.pop("url")
        return spark.read.jdbc(url, source.table, predicates=list(predicates), properties=options)
    options["dbtable"] = source.table
    if source.partition_column is not None:
        lower, upper = source.lower_bound, source.upper_bound
        if lower is None:
            asked = {**options, "dbtable": bounds_query(source)}
            lower, upper = spark.read.format("jdbc").options(**asked).load().first()
        if lower is not None:
            options.update(
                partitionColumn=source.partition_column,
                lowerBound=str(lower),
                upperBound=str(upper),
                numPartitions=str(source.num_partitions),
            )
    return spark.read.format("jdbc").options(**options).load()

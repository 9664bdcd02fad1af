"""Train / test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.dates import quote
from ledgerloom.session import drop_table, shared_table

BUCKETS = 100
BUCKET = "__split_bucket"
# Numbers that eight hexadecimal digits can write.
_DIGESTS = 1 << 32


def random_split(df: DataFrame, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Disjoint random parts that together are ``df``.

    Spark sorts every partition so that the parts stay disjoint when a task is
    run again. That costs a local sort of whole rows per part, and the parts
    change with the partitioning; ``keyed_split`` has neither drawback.
    """
    train, test = df.randomSplit([train_share, 1.0 - train_share], seed)
    return train, test


def key_bucket(keys: Sequence[str], null_by: Sequence[str] = ()) -> Column:
    """Place of a row in 0 to 100, from the md5 of its key: the same on every read and partitioning.

    Rows whose key is NULL throughout are placed by the columns ``null_by``
    instead, so that they do not all go to one part.
    """
    if not keys:
        raise ValueError("a keyed split needs at least one key column")
    texts = [F.col(quote(key)).cast("string") for key in keys]
    text = texts[0] if len(texts) == 1 else F.to_json(F.struct(*texts))
    if null_by:
        no_key = F.coalesce(*texts).isNull()
        text = F.when(no_key, F.to_json(F.struct(*[F.col(quote(name)) for name in null_by]))).otherwise(text)
    digest = F.md5(F.coalesce(text, F.lit("")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    # The remainder is the whole percent, and the quotient what is finer than that.
    return number % BUCKETS + F.floor(number / BUCKETS) / (_DIGESTS // BUCKETS + 1)


def split_label(keys: Sequence[str], train_share: float = 0.8, null_by: Sequence[str] = ()) -> Column:
    """'train' or 'test' by key."""
    return F.when(key_bucket(keys, null_by) < _train_limit(train_share), "train").otherwise("test")


def with_key_bucket(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` plus its key bucket, to compute it once where a frame is kept for many passes.

    Rows without a key are placed by all columns of ``df``.
    """
    return df.withColumn(BUCKET, key_bucket(keys, df.columns))


def with_random_bucket(df: DataFrame, seed: int = 42) -> DataFrame:
    """``df`` plus a random bucket. Write the frame before splitting it: a draw may not repeat."""
    return df.withColumn(BUCKET, F.rand(seed) * BUCKETS)


def bucket_split(df: DataFrame, train_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """The parts of a frame that has a bucket, without the bucket."""
    limit = _train_limit(train_share)
    return df.where(F.col(BUCKET) < limit).drop(BUCKET), df.where(F.col(BUCKET) >= limit).drop(BUCKET)


def keyed_split(
    df: DataFrame, keys: Sequence[str], train_share: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """Disjoint parts by key: two filters, with no shuffle and no sort.

    All rows of one key go to one part, so the share is met over keys, not rows.
    """
    return bucket_split(with_key_bucket(df, keys), train_share)


def row_digest(columns: Sequence[str], seed: int = 42) -> Column:
    """SHA-256 of the seed and of the content of a row: all of ``columns`` as JSON, NULLs included."""
    content = F.to_json(F.struct(*[F.col(quote(name)) for name in columns]), {"ignoreNullFields": "false"})
    return F.sha2(F.concat(F.lit(f"{seed}:"), content), 256)


def content_bucket(df: DataFrame, seed: int = 42) -> DataFrame:
    """``df`` plus a random bucket of each row that follows from the seed and the rows alone.

    A row is drawn by its content, and one of several equal rows by its number
    among them as well, so copies are drawn apart. Equal rows are alike, so only how
    many of them there are matters: they are counted by partition, the counts of
    the partitions are put one after the other, and the rows are made again from
    the counts, a partition's copies at a time, so no task has all copies of a row.
    Order and partitioning of ``df`` do not matter. What is counted is written to the
    shared folder.
    """
    names = df.columns
    part = F.spark_partition_id().alias("__part")
    keyed = df.select(row_digest(names, seed).alias("__digest"), part, F.struct(*[F.col(quote(name)) for name in names]).alias("__row"))
    copies = shared_table(keyed.groupBy("__digest", "__part").agg(F.first("__row").alias("__row"), F.count("*").alias("__n")))
    before = Window.partitionBy("__digest").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # Of a row at most one count for each partition, and without the row itself.
    starts = copies.select("__digest", "__part", "__n").withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    starts = starts.where("__start > 0").select("__digest", "__part", "__start")
    placed = copies.join(starts, ["__digest", "__part"], "left").withColumn("__start", F.coalesce("__start", F.lit(0)))
    # Counts above one become several rows, so they are dealt out to a stated number of tasks, which Spark does not merge.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    several = placed.where("__n > 1").repartition(tasks, "__digest", "__part")
    placed = placed.where("__n = 1").unionByName(several)
    number = F.explode(F.sequence(F.col("__start"), F.col("__start") + F.col("__n") - 1)).alias("__number")
    drawn = F.md5(F.concat_ws(":", F.col("__digest"), F.col("__number").cast("string")))
    share = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("long") * (BUCKETS / _DIGESTS)
    return placed.select("__digest", "__row", number).select("__row.*", share.alias(BUCKET))


def content_split(df: DataFrame, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Disjoint random parts that together are ``df``, the same for every order and partitioning of it."""
    return bucket_split(content_bucket(df, seed), train_share)


def key_place(keys: Sequence[str]) -> Column:
    """Place of a key in an order as good as random: 60 bits of the md5 of its text, NULL keys included."""
    texts = [F.col(quote(key)).cast("string") for key in keys]
    text = texts[0] if len(texts) == 1 else F.to_json(F.struct(*texts), {"ignoreNullFields": "false"})
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("long")


#: Bits of a place by which rows are summed at once; that many sums, at most, are put in order in one task.
_STEP = 15
_PLACE_BITS = 60


def row_share_limit(df: DataFrame, keys: Sequence[str], train_share: float = 0.8) -> int:
    """The place below which keys hold ``train_share`` of the rows of ``df``, within half the rows of one key.

    Rows are counted by place once. Then the counts are summed by ever finer cells
    of the place, down to the key in which the share is reached; it goes to the side
    that brings the share nearer. Two keys of one place count as one.
    """
    _train_limit(train_share)
    if not keys:
        raise ValueError("a split needs at least one key column")
    counts = shared_table(df.select(key_place(keys).alias("place")).groupBy("place").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    wanted, below, low, bits = train_share * total, 0, 0, _PLACE_BITS
    while bits:
        width = 1 << (bits - _STEP)
        inside = counts.where(F.col("place").between(low, low + (1 << bits) - 1))
        cells = inside.groupBy(F.shiftright(F.col("place") - low, bits - _STEP).alias("cell")).agg(F.sum("n").alias("n"))
        # At most 2 ** _STEP rows.
        upto = F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
        reached = cells.withColumn("upto", upto + below).where(F.col("upto") >= wanted).orderBy("cell").first()
        if reached is None:  # no rows
            break
        low, bits = low + reached["cell"] * width, bits - _STEP
        below, last = reached["upto"] - reached["n"], reached["n"]
        if not bits:
            low += wanted - below > below + last - wanted
    drop_table(counts)
    return low


def row_share_split(df: DataFrame, keys: Sequence[str], train_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Disjoint parts by key of which the first has ``train_share`` of the rows, within half the rows of one key.

    All rows of one key go to one part, rows of NULL keys too. ``keyed_split`` meets
    the share over keys, and one heavy key moves it; here keys are counted first,
    and the parts are two filters over the rows.
    """
    limit, place = row_share_limit(df, keys, train_share), key_place(keys)
    return df.where(place < limit), df.where(place >= limit)


def _train_limit(train_share: float) -> float:
    if not 0 < train_share < 1:
        raise ValueError("train_share must be above 0 and below 1")
    return round(train_share * BUCKETS, 9)

"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document gets the key ``-ln(u) / w``, where ``u`` is drawn from its id and
``w`` is its quality weight; the smallest keys make a sample without
replacement in which weight counts. Keys are sorted within their source and
sizes summed up to the source's budget. Where a source gives more than it holds,
whole epochs come first and the sample fills the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.words import map_rows, shielded, text_bytes
from ledgerloom.session import shared_table

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3.0
#: No document is left without a chance.
LEAST_QUALITY = 0.05
_NO_LETTER = bytes(b for b in range(0x80) if not chr(b).isalpha())
_SPACE = b"\t\n\x0b\x0c\r "


def text_quality(text: bytes) -> float:
    """Share of letters among visible bytes times share of lines that are new, at least ``LEAST_QUALITY``."""
    seen = len(text.translate(None, _SPACE))
    if not seen:
        return LEAST_QUALITY
    lines = text.split(b"\n")
    letters = len(text.translate(None, _NO_LETTER)) / seen
    return max(LEAST_QUALITY, letters * len(set(lines)) / len(lines))


def document_draw() -> Column:
    """Digest of id, source and text, the same for repeated rows."""
    source = F.coalesce("source", F.lit(""))
    size = F.coalesce(F.octet_length("source"), F.lit(-1)).cast("string")
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", doc_id, size, source, F.coalesce("text", F.lit(""))).cast("binary"))


def sized(documents: DataFrame) -> DataFrame:
    """``doc_id, source, size, quality, draw``: words of the whole text, its quality, a digest of the row."""
    keys = documents.select(
        "doc_id",
        "source",
        document_draw().alias("draw"),
        text_bytes().alias("text"),
    )

    def rows(batch: dict[str, list]):
        texts = [text or b"" for text in batch.pop("text")]
        batch["size"] = [len(text.split()) for text in texts]
        batch["quality"] = [text_quality(text) for text in texts]
        yield batch

    return map_rows(keys, rows, "doc_id bigint, source string, size bigint, quality double, draw string")


def source_targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, most_epochs: float = MOST_EPOCHS
) -> DataFrame:
    """``target`` of each source, from one row ``source, source_size`` for each.

    Sources by code point, null last, take the weights in turn and share the sum
    of all sizes by weight. A target stops at ``most_epochs`` times its source;
    what is beyond is shared anew among the others. In order of the size at
    which each source fills up, the first source that does not fill up sets the
    rate for itself and all after it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*map(F.lit, weights))
    weight = F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    most = most_epochs * F.col("source_size")
    full = sources.withColumn("weight", weight).withColumn("full_at", most / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rate = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum(most).over(before), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    rated = full.withColumn("rate", rate)
    settled = F.min(F.when(F.col("rate") <= F.col("full_at"), F.struct("full_at", "rate"))).over(everything)
    share = F.coalesce(settled["rate"] * F.col("weight"), most)
    return rated.select("source", "source_size", F.least(share, most).alias("target"))


def exponential_key(draw: Column, quality: Column, seed: int) -> Column:
    """``-ln(u) / w`` with ``u`` in (0, 1) from 52 bits of a digest."""
    bits = F.conv(F.substring(F.md5(F.concat(draw, F.lit(f":{seed}")).cast("binary")), 1, 13), 16, 10).cast("long")
    return -F.log((bits + 0.5) / F.lit(float(1 << 52))) / quality


def sorted_sums(keyed: DataFrame) -> DataFrame:
    """Rows ranged by source and key, with the sum of sizes up to and with the row in its partition.

    Equal rows are told apart by a number, so that many of them are several tasks.
    """
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("draw"), F.col("doc_id"), F.col("row")]
    numbered = keyed.withColumn("row", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema)
    arrow_columns = keyed.columns
    state: dict[tuple[int, str | None], int] = {}

    def rows(batch: dict[str, list]):
        part = TaskContext.get().partitionId()
        sums = []
        for source, size in zip(batch["source"], batch["size"], strict=True):
            total = state[part, source] = state.get((part, source), 0) + size
            sums.append(total)
        yield {name: batch[name] for name in arrow_columns} | {
            "part": np.full(len(sums), part),
            "local_sum": sums,
        }

    return map_rows(ranged, rows, schema + ", part int, local_sum bigint")


def mix(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most_epochs: float = MOST_EPOCHS,
    seed: int = 0,
) -> DataFrame:
    """``doc_id, source, size, quality, draw, source_size, target, taken`` for every document.

    ``taken`` is the number of words the mix takes of the document, repeats
    counted. A source whose target is ``e`` times its size and a rest takes
    every document ``e`` times, then documents by key while the middle of a
    document lies within the rest, so it ends within half a document of its
    target. Draws depend on row and text alone, so reruns agree.

    A null or empty text has size 0 and is never taken; null is a source; a
    repeated row has the key of its copy and is taken on its own; an empty table
    gives no row; other columns are not read.
    """
    sizes = shared_table(sized(documents))
    targets = source_targets(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_epochs
    )
    keyed = sizes.withColumn("key", exponential_key(F.col("draw"), F.col("quality"), seed))
    summed = shared_table(sorted_sums(keyed))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        summed.groupBy("source", "part")
        .agg(F.sum("size").alias("n"))
        .withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .select(F.col("source").alias("of"), F.col("part").alias("in"), "first", "source_size", "target")
    )
    joined = summed.join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
    epochs = F.floor(F.col("target") / F.col("source_size"))
    rest = F.col("target") - epochs * F.col("source_size")
    middle = F.col("first") + F.col("local_sum") - F.col("size") / 2
    times = F.when(F.col("size") == 0, F.lit(0)).otherwise(epochs + (middle <= rest).cast("long"))
    return joined.select(
        "doc_id",
        "source",
        "size",
        "quality",
        "draw",
        "source_size",
        "target",
        (times * F.col("size")).cast("long").alias("taken"),
    )


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_mix_rank`` among those of one ``_mix_draw``, from 0, without one task for all of them."""
    same = ["_mix_draw", "_mix_part"]
    within = Window.partitionBy(*same).orderBy("_mix_draw")
    before = Window.partitionBy("_mix_draw").orderBy("_mix_part").rowsBetween(Window.unboundedPreceding, -1)
    shares = rows.groupBy(*same).agg(F.count("*").alias("n"))
    starts = shares.select(*same, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_mix_first"))
    ranked = rows.withColumn("_mix_local", F.row_number().over(within) - 1).join(starts, same)
    return ranked.withColumn("_mix_rank", F.col("_mix_local") + F.col("_mix_first")).drop("_mix_local", "_mix_first")


def repeated(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most_epochs: float = MOST_EPOCHS,
    seed: int = 0,
) -> DataFrame:
    """Rows of ``documents``, all columns, as often as the mix takes each.

    Rows alike in id, source and text share a draw, and what is taken of them
    is dealt out evenly among them. They are ranked within the partitions that
    they are read in, and the partitions by their counts. A null or empty text has
    no size and is not taken; a null source is one of its own; an empty table gives
    no row; other columns, of any name, are kept as they are.
    """
    documents, named = shielded(documents, ("doc_id", "text", "source"))
    mixed = mix(documents, weights, most_epochs, seed).where("size > 0")
    times = mixed.groupBy(F.col("draw").alias("_mix_draw")).agg(
        F.sum(F.col("taken") / F.col("size")).cast("long").alias("_mix_times"), F.count("*").alias("_mix_count")
    )
    times = shared_table(times.where("_mix_times > 0"))
    rows = documents.withColumns({"_mix_draw": document_draw(), "_mix_part": F.spark_partition_id()})
    joined = rows.join(times, "_mix_draw")
    dealt = joined.where("_mix_count = 1").withColumn("_mix_rank", F.lit(0).cast("long"))
    if not times.where("_mix_count > 1").isEmpty():
        dealt = dealt.unionByName(_ranked(shared_table(joined.where("_mix_count > 1"))))
    each = F.floor(F.col("_mix_times") / F.col("_mix_count"))
    own = each + (F.col("_mix_rank") < F.col("_mix_times") - each * F.col("_mix_count")).cast("long")
    several = dealt.withColumn("_mix_own", own).where("_mix_own > 0")
    return named(several.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_own")))))

"""Bulk-synchronous best-fit packing of documents into sequences of a fixed length.

Lengths are whole numbers up to the capacity, so documents and gaps that are
equally long form one run each, and sorting by size leaves at most ``capacity``
runs however many documents there are. A round takes the documents of one
length, from the longest down, and sweeps the gaps upward from that length: the
run of the smallest gap that fits takes as many documents as it has gaps, by
rank, the gaps shrink, and the sweep goes on until the length is placed; only
then are new sequences opened. Rounds need the counts of the runs alone. Spark
counts them, ranks the documents within their run, and gives each document the
place that belongs to its rank.
"""

from __future__ import annotations

import zlib
from typing import Any

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.tokens import TOKENIZER, encoder, wide
from ledgerloom.llm.words import map_rows, text_bytes
from ledgerloom.session import shared_table

CAPACITY = 4096
END_ID = 1
#: Ranks within a length stay below this; lengths times it stay below 2**63.
_RANKS = 1 << 48
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int"


def token_pieces(
    documents: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    tokenizer: str = TOKENIZER,
    with_ids: bool = False,
) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of at most ``capacity``.

    Only longer documents are cut. A null or empty text is the end id alone.
    ``part`` is the Spark partition the row was made in. With ``with_ids`` the
    ids come along, as little-endian unsigned 32-bit bytes.
    """
    schema = _PIECES + ", ids binary" * with_ids
    names = [field.split()[0] for field in schema.split(", ")]
    end = np.array([end_id], "<u4")

    def rows(batch: dict[str, list]):
        encode = encoder(tokenizer).ids
        part = TaskContext.get().partitionId()
        found: list[tuple] = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            ids = np.concatenate([wide(encode(text)), end])
            for piece, start in enumerate(range(0, len(ids), capacity)):
                own = ids[start : start + capacity].tobytes()
                row: tuple[Any, ...] = (doc_id, piece, start, len(own) // 4, zlib.crc32(own), part)
                found.append((*row, own) if with_ids else row)
        yield dict(zip(names, zip(*found, strict=True), strict=True)) if found else dict.fromkeys(names, [])

    return map_rows(documents.select("doc_id", text_bytes().alias("text")), rows, schema)


def best_fit_rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Where the documents of each length go, given how many there are.

    Rows ``(length, first rank, first sequence, offset)``: documents of this
    length go, from that rank on, to successive sequences at that offset. The
    work depends on the number of different lengths, not of documents.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    open_sizes = 0  # bit g is set where there are gaps of size g
    sequences = 0
    places = []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            fitting = open_sizes >> length
            if fitting:
                gap = length + (fitting & -fitting).bit_length() - 1
                first, number = gaps[gap].pop()
                if not gaps[gap]:
                    open_sizes &= ~(1 << gap)
            else:
                gap, first = capacity, sequences
                number = -(-left // (capacity // length))
                sequences += number
            used = min(number, left)
            if used < number:
                gaps.setdefault(gap, []).append((first + used, number - used))
                open_sizes |= 1 << gap
            places.append((length, rank, first, capacity - gap))
            if gap > length:
                gaps.setdefault(gap - length, []).append((first, used))
                open_sizes |= 1 << (gap - length)
            rank += used
            left -= used
    return places


def run_ranks(pieces: DataFrame) -> DataFrame:
    """``rank`` of each piece among those equally long, from 0.

    Counts per length and partition are summed up first, so that no task holds
    all pieces of a common length.
    """
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    starts = shares.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    numbered = pieces.withColumn("local", F.row_number().over(within) - 1)
    ranked = numbered.join(starts, ["length", "part"])
    return ranked.withColumn("rank", F.col("local") + F.col("first")).drop("local", "first")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; sequences hold ``capacity`` ids at most.

    ``pieces`` must read the same each time, as ``shared_table`` gives it.
    Repeated rows are placed each on its own. No piece gives no sequence.
    """
    # At most `capacity` rows, one for each length.
    counts = pieces.groupBy("length").agg(F.count("*").alias("n")).toPandas()
    places = best_fit_rounds(dict(zip(counts["length"].tolist(), counts["n"].tolist(), strict=True)), capacity)
    table = np.array(places, np.int64).reshape(-1, 4)
    starts = table[:, 0] * _RANKS + table[:, 1]
    order = np.argsort(starts)
    shared = pieces.sparkSession.sparkContext.broadcast((starts[order], table[order]))
    kept = [f for f in pieces.schema if f.name != "part"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)

    def rows(batch: dict[str, list]):
        keys, found = shared.value
        length, rank = np.array(batch["length"], np.int64), np.array(batch["rank"], np.int64)
        at = np.searchsorted(keys, length * _RANKS + rank, side="right") - 1
        sequence = found[at, 2] + rank - found[at, 1]
        yield {f.name: batch[f.name] for f in kept} | {"sequence_id": sequence, "offset": found[at, 3]}

    return map_rows(run_ranks(pieces).drop("part"), rows, schema + ", sequence_id bigint, offset bigint")


def pack_documents(
    documents: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    tokenizer: str = TOKENIZER,
    with_ids: bool = False,
) -> DataFrame:
    """Token pieces of all ``documents`` with their place in the sequences.

    Columns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. A
    null or empty text is one end id; repeated rows and ties are placed each on
    their own, in order of id; an empty table gives no row; other columns are
    not read. A document's id may be null.
    """
    pieces = shared_table(token_pieces(documents, capacity, end_id, tokenizer, with_ids))
    return pack(pieces, capacity)

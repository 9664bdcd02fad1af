"""SimHash near-duplicates found with a table of distances to reference fingerprints.

Every distinct fingerprint is measured once against ``PIVOTS`` reference
fingerprints. The distance to a pivot changes by at most as many bits as two
fingerprints differ in, so a pair whose rows in that table differ by more than
``BITS`` in any column is no link. What the table leaves is verified bit by bit.

The table is asked only about pairs that can be links at all: fingerprints at
most two bits apart agree in two of any four parts of the bits that they are cut
into. A bucket holds those that agree in two parts of 16 bits. One that holds
more than ``LEAF`` is cut again by its other 32 bits, and then by the other 16,
after which at most 256 fingerprints share the rest. So no bucket is large, none
is left out, and no group is ever paired as a whole. A bucket answers with as
many links as connect its members, not with all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.words import arrow_schema, map_rows, mixed, ship_package, text_bytes, to_batch
from ledgerloom.session import drop_table, shared_table

#: Words of a shingle.
SIZE = 3
SEED = 42
#: Fingerprints link at this many differing bits or fewer. The buckets rely on it being at most two.
BITS = 2
#: Reference fingerprints.
PIVOTS = 32
#: Fingerprints of a bucket that are compared as they are; larger buckets are cut further.
LEAF = 2048
#: Shingles of a text that are hashed at once.
CHUNK = 1 << 15
#: Links of a task that are held before they are reduced to those that connect.
HELD_LINKS = 1 << 17
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ALL = (1 << 64) - 1


def fingerprint(text: bytes | None, size: int = SIZE) -> int:
    """SimHash of the runs of ``size`` words, each as often as it occurs; 0 for a text without words."""
    words = text.translate(_UPPER).split() if text else []
    if not words:
        return 0
    if len(words) < size:
        runs, total = iter([words]), 1
    else:
        runs, total = zip(*[islice(words, at, None) for at in range(size)], strict=False), len(words) - size + 1
    ones = np.zeros(64, np.int64)
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED))
    for begin in range(0, total, CHUNK):
        part = np.fromiter(islice(hashes, CHUNK), "<u8", min(CHUNK, total - begin))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def reference_fingerprints(count: int = PIVOTS) -> np.ndarray:
    """Pivots: well spread 64-bit numbers that follow from their place."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def distance_table(fingerprints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Differing bits of each fingerprint, by row, and each pivot, by column."""
    return np.bitwise_count(fingerprints[:, None] ^ pivots[None, :])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def finer(mask: int) -> list[int]:
    """``mask`` with two of four equal parts of the bits that it leaves out, in every way."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    parts = [sum(1 << bit for bit in free[at::4]) for at in range(4)]
    return [mask | one | other for one, other in combinations(parts, 2)]


def fingerprints_of(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (64 bits as a signed long) of every row."""

    def rows(batch: dict[str, list]):
        found = np.fromiter(map(fingerprint, batch["text"]), np.uint64, len(batch["text"]))
        yield {"doc_id": batch["doc_id"], "fingerprint": found.view(np.int64)}

    frame = documents.select("doc_id", text_bytes().alias("text"))
    return map_rows(frame, rows, "doc_id bigint, fingerprint bigint")


def with_distances(distinct: DataFrame, count: int = PIVOTS) -> DataFrame:
    """``fingerprint, distances``: its row of the distance table, one byte for each pivot."""
    pivots = reference_fingerprints(count)

    def rows(batch: dict[str, list]):
        own = np.array(batch["fingerprint"], np.int64)
        table = distance_table(own.view(np.uint64), pivots)
        yield {"fingerprint": own, "distances": [row.tobytes() for row in table]}

    return map_rows(distinct.select("fingerprint"), rows, "fingerprint bigint, distances binary")


def _buckets(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """Rows in a bucket for each finer mask of theirs, without those that are alone in it; ``n`` is its size."""
    options = F.create_map(*[
        part
        for mask, found in masks.items()
        for part in (F.lit(_signed(mask)), F.array(*[F.lit(_signed(one)) for one in found]))
    ])
    finer_mask = F.explode(F.element_at(options, F.col("mask"))).alias("mask")
    keyed = rows.select("fingerprint", "distances", finer_mask)
    keyed = keyed.withColumn("shared", F.col("fingerprint").bitwiseAND(F.col("mask")))
    # Sums are written before they are joined, so that Spark can split the rows of a large bucket.
    sizes = shared_table(keyed.groupBy("mask", "shared").agg(F.count("*").alias("n")).where("n > 1"))
    return keyed.join(sizes, ["mask", "shared"])


def forest(first: np.ndarray, second: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what these links among ``size`` places connect: each place with the least of its group."""
    label = np.arange(size)
    while True:
        least = np.minimum(label[first], label[second])
        new = label.copy()
        np.minimum.at(new, label[first], least)
        np.minimum.at(new, label[second], least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    tied = np.flatnonzero(label != np.arange(size))
    return label[tied], tied


def linked_places(bucket: np.ndarray, prints: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose links connect all fingerprints that are linked in their bucket; rows of a bucket adjoin.

    A pair is dropped as soon as its rows in the distance table differ by more
    than ``BITS`` in one column; the others are verified.
    """
    size = len(prints)
    columns = table.astype(np.int8)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    held, at, lag = 0, np.arange(size), 0
    while len(at):
        lag += 1
        at = at[at + lag < size]
        at = at[bucket[at] == bucket[at + lag]]
        apart = np.abs(columns[at] - columns[at + lag]).max(1, initial=0)
        near = at[apart <= BITS]
        near = near[np.bitwise_count(prints[near] ^ prints[near + lag]) <= BITS]
        left.append(near)
        right.append(near + lag)
        held += len(near)
        if held > HELD_LINKS:
            one, other = forest(np.concatenate(left), np.concatenate(right), size)
            left, right, held = [one], [other], 0
    return forest(np.concatenate(left), np.concatenate(right), size)


def links(buckets: DataFrame, count: int = PIVOTS) -> DataFrame:
    """Links ``a, b`` that connect what is linked, from rows ``mask, shared, fingerprint, distances``."""
    ship_package(buckets.sparkSession)
    schema = "a bigint, b bigint"
    arrow = arrow_schema(buckets.sparkSession, schema)
    key = ["mask", "shared"]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        """Whole buckets, and what is left of the last one of a batch with the next batch."""
        kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty((0, count), np.uint8))
        for batch in batches:
            own = [batch.column(name).to_numpy(zero_copy_only=False) for name in (*key, "fingerprint")]
            table = np.frombuffer(b"".join(batch.column("distances").to_pylist()), np.uint8).reshape(-1, count)
            new = (own[0], own[1], own[2].view(np.uint64), table)
            kept = tuple(np.concatenate(both) for both in zip(kept, new, strict=True))
            if len(kept[0]):
                begins = np.flatnonzero((np.diff(kept[0]) != 0) | (np.diff(kept[1]) != 0)) + 1
                cut = int(begins[-1]) if len(begins) else 0
                yield tuple(column[:cut] for column in kept)
                kept = tuple(column[cut:] for column in kept)
        yield kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for mask, shared, prints, table in parts(batches):
            changes = (np.diff(mask, prepend=mask[:1]) != 0) | (np.diff(shared, prepend=shared[:1]) != 0)
            one, other = linked_places(np.cumsum(changes), prints, table)
            ids = prints.view(np.int64)
            yield to_batch({"a": ids[one], "b": ids[other]}, arrow)

    dealt = buckets.select(*key, "fingerprint", "distances").repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(run, schema)


def near_links(distinct: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints at most ``BITS`` bits apart; each is given once."""
    rows = shared_table(with_distances(distinct)).withColumn("mask", F.lit(0).cast("long"))
    masks, found = [0], None
    while True:
        children = {mask: finer(mask) for mask in masks}
        masks = sorted({one for several in children.values() for one in several})
        buckets = shared_table(_buckets(rows, children))
        last = all(bin(_ALL ^ mask).count("1") < 16 for mask in masks)
        own = links(buckets if last else buckets.where(F.col("n") <= leaf))
        found = own if found is None else found.unionByName(own)
        if last:
            return found
        rows = buckets.where(F.col("n") > leaf).select("fingerprint", "distances", "mask")
        if rows.isEmpty():
            return found


def near_fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row for each row of ``documents``.

    ``fingerprint`` is 16 hexadecimal digits, ``component_id`` the least id that
    links reach. A null text, and one without words, has fingerprint zero, and is
    linked as any other. Repeated rows, and equal texts, have one fingerprint and
    one component; a long text is hashed in parts. A row with a null id takes part,
    and its component is that of the rows with an id, or null if no such row is
    reached. An empty table gives no row; other columns are not read.
    """
    rows = shared_table(fingerprints_of(documents))
    distinct = shared_table(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    groups = components(near_links(distinct))
    rooted = distinct.join(groups, distinct["fingerprint"] == groups["id"], "left")
    rooted = shared_table(rooted.select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("root")))
    least = shared_table(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    answers = shared_table(rooted.join(least, "root").select("fingerprint", "component_id"))
    for table in (distinct, rooted, least):
        drop_table(table)
    return rows.join(answers, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )

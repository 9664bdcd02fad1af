"""Exact centroid clustering of integer vectors with zone maps along a space-filling curve.

Vectors are put in the order of a Hilbert curve through all their dimensions and
cut into blocks of neighbours. A block holds its vectors and its zone map, the
least and the greatest value in each dimension. No vector of a block is farther
from a centroid than the farthest corner of that box, and none is nearer than
the box itself; so the block has as candidates only the centroids whose box
distance is not above the least of the farthest ones. Its vectors are compared
with the candidates exactly. The blocks are written once and read in each round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import arrow_schema, map_rows, ship_package, to_batch
from ledgerloom.session import drop_table, shared_table

WIDTH = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = 2
#: Vectors of a block, but for the last one of a partition.
BLOCK = 64
#: Bits of each dimension in the Hilbert key, and standard deviations that its cells reach on either side of the mean.
KEY_BITS = 2
REACH = 2.0
#: Components below this give distances that are exact in floating point.
_EXACT = 1 << 22
#: Components from this on are refused: differences of two would not fit into 64 bits.
_LARGEST = 2.0**62


def integer_vectors(embeddings: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """``vec_id, vector`` with components ``floor(scale * x)``, for vectors of ``width`` finite components."""
    ship_package(embeddings.sparkSession)
    schema = "vec_id bigint, vector array<bigint>"
    arrow = arrow_schema(embeddings.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            fit = pa.array(lengths == width)
            ids, column = batch.column("vec_id").filter(fit), column.filter(fit)
            found = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
            finite = np.isfinite(found).all(1)
            scaled = np.floor(scale * found[finite])
            if not (np.abs(scaled) < _LARGEST).all():
                raise ValueError("a component does not fit into 62 bits")
            values = pa.array(scaled.astype(np.int64).ravel())
            offsets = pa.array(np.arange(len(scaled) + 1, dtype=np.int32) * width)
            yield to_batch(
                {"vec_id": ids.filter(pa.array(finite)), "vector": pa.ListArray.from_arrays(offsets, values)}, arrow
            )

    plain = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return plain.mapInArrow(run, schema)


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place of each row along the Hilbert curve through cells of ``bits`` bits in each dimension.

    Axes are turned into the transposed index as Skilling describes, for all rows at once.
    """
    axes = cells.astype(np.int64).T.copy()
    if not axes.size:
        return [b""] * len(cells)
    for level in range(bits - 1, 0, -1):
        top, low = 1 << level, (1 << level) - 1
        for axis in axes:
            up = (axis & top) > 0
            swap = np.where(up, 0, (axes[0] ^ axis) & low)
            axes[0] ^= np.where(up, low, swap)
            axis ^= swap
    for place in range(1, len(axes)):
        axes[place] ^= axes[place - 1]
    turn = np.zeros(axes.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((axes[-1] >> level & 1) > 0, (1 << level) - 1, 0)
    axes ^= turn
    planes = np.stack([axes >> level & 1 for level in range(bits - 1, -1, -1)])
    spread = planes.reshape(bits * len(axes), -1).T.astype(np.uint8)
    return [row.tobytes() for row in np.packbits(spread, axis=1)]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def spreads(vectors: DataFrame, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each dimension, over all vectors; ``width`` rows reach the driver."""
    values = vectors.select(F.posexplode("vector").alias("place", "x")).withColumn("x", F.col("x").cast("double"))
    found = values.groupBy("place").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread")).collect()
    mean, spread = np.zeros(width), np.ones(width)
    for row in found:
        mean[row["place"]], spread[row["place"]] = row["mean"], row["spread"] or 1.0
    return mean, spread


def in_curve_order(vectors: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """``vec_id, vector``, parted and sorted along the Hilbert curve; equal vectors may be in several partitions."""
    mean, spread = spreads(vectors)
    cells = 1 << bits

    def rows(batch: dict[str, list]):
        own = np.array(batch["vector"], np.float64).reshape(-1, len(mean))
        place = np.floor(((own - mean) / spread / REACH + 1) * cells / 2)
        yield batch | {"key": hilbert_keys(np.clip(place, 0, cells - 1), bits)}

    keyed = map_rows(vectors, rows, "vec_id bigint, vector array<bigint>, key binary")
    # Written, so that the sample for the ranges does not compute the keys again.
    keyed = shared_table(keyed.withColumn("part", F.spark_partition_id()))
    order = ["key", F.xxhash64("vec_id"), "part"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "vector")


def blocks(vectors: DataFrame, size: int = BLOCK, width: int = WIDTH) -> DataFrame:
    """``ids, vectors, low, high``: blocks of successive rows with their zone maps; ``vectors`` is flat."""
    ordered = in_curve_order(vectors)
    ship_package(vectors.sparkSession)
    schema = "ids array<bigint>, vectors array<bigint>, low array<bigint>, high array<bigint>"
    arrow = arrow_schema(vectors.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = batch.column("vec_id").to_pylist(), _matrix(batch.column("vector"), width)
            cuts = [slice(at, at + size) for at in range(0, len(ids), size)]
            columns = {
                "ids": [ids[cut] for cut in cuts],
                "vectors": [own[cut].ravel() for cut in cuts],
                "low": [own[cut].min(0) for cut in cuts],
                "high": [own[cut].max(0) for cut in cuts],
            }
            yield to_batch(columns, arrow)

    return ordered.mapInArrow(run, schema)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids can be nearest to a vector in the box, ties included; exact in whole numbers."""
    below, above = low - centroids, centroids - high
    kind = np.int64 if max(np.abs(below).max(), np.abs(above).max()) < 1 << 28 else object
    nearest = (np.maximum(np.maximum(below, above), 0).astype(kind) ** 2).sum(1)
    farthest = (np.maximum(np.abs(below), np.abs(above)).astype(kind) ** 2).sum(1)
    return np.flatnonzero(nearest <= farthest.min())


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, by vector and centroid, exact."""
    if max(np.abs(vectors).max(), np.abs(centroids).max()) < _EXACT:
        own, other = vectors.astype(np.float64), centroids.astype(np.float64)
        found = (own * own).sum(1)[:, None] - 2 * (own @ other.T) + (other * other).sum(1)
        return found.astype(np.int64)
    apart = vectors[:, None, :] - centroids[None, :, :]
    return (apart.astype(object) ** 2).sum(2)


def assign(low: np.ndarray, high: np.ndarray, vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector of a block, its squared distance, and how many candidates there were."""
    near = candidates(low, high, centroids)
    found = distances(vectors, centroids[near])
    best = found.argmin(1)
    return near[best], found[np.arange(len(found)), best], len(near)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[Any, ...]]:
    width = centroids.shape[1]
    for batch in batches:
        lows, highs = (_matrix(batch.column(name), width) for name in ("low", "high"))
        for place in range(batch.num_rows):
            own = batch.column("vectors")[place].values.to_numpy(zero_copy_only=False).reshape(-1, width)
            ids = batch.column("ids")[place].values
            yield ids, own, *assign(lows[place], highs[place], own, centroids)


def round_sums(parts: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cluster, place, total, n`` over all vectors, and as cluster -1 the numbers of blocks and of candidates."""
    ship_package(parts.sparkSession)
    schema = "cluster int, place int, total string, n bigint"
    arrow = arrow_schema(parts.sparkSession, schema)
    count, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, sizes = np.zeros((count, width), object), np.zeros(count, np.int64)
        n_blocks = n_candidates = 0
        for _, own, cluster, _, asked in _assigned(batches, centroids):
            n_blocks, n_candidates = n_blocks + 1, n_candidates + asked
            for one in np.unique(cluster):
                mine = own[cluster == one]
                kind = np.int64 if np.abs(mine).max() < 1 << 40 else object
                totals[one] += mine.astype(kind).sum(0)
                sizes[one] += len(mine)
        used = np.flatnonzero(sizes)
        yield to_batch(
            {
                "cluster": [*np.repeat(used, width).tolist(), -1],
                "place": [*np.tile(np.arange(width), len(used)).tolist(), 0],
                "total": [*map(str, totals[used].ravel().tolist()), str(n_candidates)],
                "n": [*np.repeat(sizes[used], width).tolist(), n_blocks],
            },
            arrow,
        )

    sums = parts.mapInArrow(run, schema).groupBy("cluster", "place")
    return sums.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def moved(centroids: np.ndarray, sums: list[Any]) -> np.ndarray:
    """Each centroid at ``floor(sum / count)`` of its vectors; one without vectors stays."""
    found = centroids.copy()
    for row in sums:
        if row["cluster"] >= 0:
            found[row["cluster"], row["place"]] = int(row["total"]) // row["n"]
    return found


def first_centroids(vectors: DataFrame, count: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``; ids that repeat in order of the vector, null ids last."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select("vector", drawn.alias("draw")).orderBy(F.asc_nulls_last("draw"), "vector").limit(count).collect()
    return np.array([row["vector"] for row in rows], np.int64).reshape(len(rows), len(rows[0]["vector"]) if rows else WIDTH)


def cluster_vectors(
    embeddings: DataFrame,
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    statistics: list[tuple[int, int]] | None = None,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``, a row for each vector kept.

    Vectors that are null, of another length, or with a null or non-finite
    component are left out. Of centroids equally near the one of smaller number
    wins. Fewer vectors than ``count`` are as many centroids. Repeated rows count
    each; a null id is kept and starts a centroid only if there are too few others.
    A component of 62 bits or more, or a distance that does not fit into 64 bits, is
    an error. An empty table gives no row; other columns are not read. ``statistics``
    gets, for each round, the number of blocks and that of their candidates.
    """
    vectors = shared_table(integer_vectors(embeddings))
    centroids = first_centroids(vectors, count)
    ship_package(embeddings.sparkSession)
    schema = "vec_id bigint, cluster int, distance bigint"
    arrow = arrow_schema(embeddings.sparkSession, schema)
    parts = shared_table(blocks(vectors))
    for _ in range(rounds if len(centroids) else 0):
        sums = round_sums(parts, centroids).collect()  # a row for each centroid and dimension
        centroids = moved(centroids, sums)
        if statistics is not None:
            statistics += [(row["n"], int(row["total"])) for row in sums if row["cluster"] < 0]
    final = centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance, _ in _assigned(batches, final):
            yield to_batch({"vec_id": ids, "cluster": cluster, "distance": distance}, arrow)

    answers = shared_table(parts.mapInArrow(run, schema))
    drop_table(parts)
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    own = {row["cluster"]: int(row["total"]) for row in answers.groupBy("cluster").agg(exact.alias("total")).collect()}
    total = sum(own.values())
    named = [
        (cluster, inertia, total, hashlib.sha256(",".join(map(str, final[cluster].tolist())).encode()).hexdigest())
        for cluster, inertia in sorted(own.items())
    ]
    # One row for each centroid.
    facts = embeddings.sparkSession.createDataFrame(
        named, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return answers.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

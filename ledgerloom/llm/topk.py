"""Exact top-k by integer inner product with Fagin's threshold algorithm.

Candidates are dealt into blocks, and each block keeps, for each dimension, the
list of its vectors sorted by that component. A query walks the lists from the
end that suits the sign of its own component, all to the same depth, and scores
every vector it meets. What it has not met scores at most the sum over the
dimensions of its component times the next one in the list, so it stops as soon
as that bound is below the k-th best score.

Queries are a stated part of the rows. They too come in blocks, and a task has
one block of each, so its memory does not grow with the tables.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.words import list_array, map_rows, ship_package

SCALE = 256
TOP = 5
#: Queries are the rows whose id is divisible by this.
EVERY = 50
#: Vectors, and queries, of a block: about so many, by hash of the id.
BLOCK = 8192
QUERY_BLOCK = 2048
#: Depth to which the lists are read first; doubled until the bound holds.
FIRST_DEPTH = 8
#: Sums below this are exact in floating point.
_EXACT = float(1 << 53)


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, vector``: components ``floor(scale * x)``; vectors with a null or non-finite one are left out.

    A component that does not fit into 64 bits is an error.
    """

    def rows(batch: dict[str, list]):
        ids, vectors = [], []
        for vec_id, vector in zip(batch["vec_id"], batch["embedding"], strict=True):
            if vec_id is None or vector is None or any(x is None for x in vector):
                continue
            plain = np.array(vector, np.float64)
            if not np.isfinite(plain).all():
                continue
            with np.errstate(over="ignore"):
                scaled = np.floor(scale * plain)
            if not (np.abs(scaled) < 2.0**63).all():
                raise ValueError(f"vector {vec_id}: a component does not fit into 64 bits")
            ids.append(vec_id)
            vectors.append(scaled.astype(np.int64))
        flat = np.concatenate(vectors) if vectors else np.empty(0, np.int64)
        yield {"vec_id": ids, "vector": list_array(flat, map(len, vectors))}

    return map_rows(embeddings.select("vec_id", "embedding"), rows, "vec_id bigint, vector array<bigint>")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    rows = column.to_pylist()
    found = np.zeros((len(rows), width), np.int64)
    for place, row in enumerate(rows):
        found[place, : len(row)] = row
    return found


class SortedLists:
    """A block of vectors with a sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.lists = np.argsort(self.vectors, axis=0, kind="stable").T.astype(np.int32)
        self._largest = float(np.abs(self.vectors).max(initial=0))
        self._floats = self.vectors.astype(np.float64)

    def _scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        if self._largest * float(np.abs(query).max(initial=0)) * max(1, len(query)) < _EXACT:
            return (self._floats[rows] @ query.astype(np.float64)).astype(np.int64)
        found = (self.vectors[rows].astype(object) * query.astype(object)).sum(1)
        if any(abs(score) >> 63 for score in found):
            raise ValueError("a score does not fit into 64 bits")
        return found.astype(np.int64)

    def top(self, query: np.ndarray, own_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best vectors but those of ``own_id``, ties to the smaller id."""
        size, width = self.vectors.shape
        used = np.flatnonzero(query)
        lists = np.where(query[used, None] > 0, self.lists[used, ::-1], self.lists[used]) if len(used) else None
        met = np.zeros(size, bool)
        best_rows, best = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, read = FIRST_DEPTH, 0
        while True:
            depth = min(depth, size)
            # Once the lists to be read hold more places than there are vectors, the rest is scored as it lies.
            if lists is None or len(used) * depth >= size:
                new = np.flatnonzero(~met)
                depth = size
            else:
                seen = np.zeros(size, bool)
                seen[lists[:, read:depth].ravel()] = True
                new = np.flatnonzero(seen & ~met)
            met[new] = True
            new = new[self.ids[new] != own_id]
            rows = np.concatenate([best_rows, new])
            scores = np.concatenate([best, self._scores(new, query)])
            if len(scores) > k:
                bar = np.partition(scores, len(scores) - k)[len(scores) - k]
                likely = scores >= bar
                rows, scores = rows[likely], scores[likely]
            order = np.lexsort((self.ids[rows], -scores))[:k]
            best_rows, best = rows[order], scores[order]
            if depth == size:
                break
            if len(best) == k:
                following = self.vectors[lists[:, depth], used]
                if int((following.astype(object) * query[used].astype(object)).sum()) < best[-1]:
                    break
            read, depth = depth, 2 * depth
        return self.ids[best_rows], best


def exact_top(
    embeddings: DataFrame,
    k: int = TOP,
    every: int = EVERY,
    scale: int = SCALE,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of each query, all if there are fewer.

    Ties go to the smaller id; a vector shorter than another counts as ending in
    zeros. Vectors that are null, or hold null or non-finite components, take no
    part, as queries or as candidates; nor do rows without an id. Of a repeated
    id every row is a candidate of other queries, and each is a query with the
    same answers, given once if the vectors are equal. An empty table gives no
    row; other columns are not read. A component or a score that does not fit into
    64 bits is an error.
    """
    ship_package(embeddings.sparkSession)
    vectors = integer_vectors(embeddings, scale)
    sizes = embeddings.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("vec_id") % every == 0).alias("queries"),
        F.max(F.size("embedding")).alias("width"),
    ).first()
    blocks = max(1, math.ceil(sizes["rows"] / block))
    query_blocks = max(1, math.ceil(sizes["queries"] / query_block))
    width = max(0, sizes["width"] or 0)
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_query_block = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    # Equal ids may be many, so the vector has a part in the block too.
    candidates = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int"))
    candidates = candidates.withColumn("query_block", every_query_block)
    queries = vectors.where(F.col("vec_id") % every == 0).distinct()
    queries = queries.withColumn("query_block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(query_blocks)).cast("int"))
    queries = queries.withColumn("block", every_block)

    def search(found: pa.Table, asked: pa.Table) -> pa.Table:
        columns: dict[str, list] = {"query_id": [], "query": [], "vec_id": [], "score": []}
        if found.num_rows and asked.num_rows:
            lists = SortedLists(found.column("vec_id").to_numpy(), _matrix(found.column("vector"), width))
            ids = asked.column("vec_id").to_pylist()
            keys = asked.column("key").to_pylist()
            for query_id, key, query in zip(ids, keys, _matrix(asked.column("vector"), width), strict=True):
                near, scores = lists.top(query, query_id, k)
                columns["query_id"] += [query_id] * len(near)
                columns["query"] += [key] * len(near)
                columns["vec_id"] += near.tolist()
                columns["score"] += scores.tolist()
        return pa.table({name: pa.array(values, pa.int64()) for name, values in columns.items()})

    keyed = queries.withColumn("key", F.xxhash64("vec_id", "vector"))
    parts = (
        candidates.groupBy("block", "query_block")
        .cogroup(keyed.groupBy("block", "query_block"))
        .applyInArrow(search, "query_id bigint, query bigint, vec_id bigint, score bigint")
    )
    best = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    ranked = parts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

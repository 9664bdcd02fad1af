"""Token ids in raw binary shards, with a minimal perfect hash index over document keys.

Layout of a written folder:

- ``ids-<shard>.bin``: ids of the documents of one range of keys, in order of
  key, as unsigned 16-bit integers and nothing else;
- ``index-<bucket>.npz``: for the keys whose hash falls into the bucket, the bit
  levels of a minimal perfect hash, and for each slot a fingerprint of its key,
  the shard, where the document begins and how many ids it has;
- ``shards.parquet``: documents and ids of each shard.

A key is hashed to its bucket, the hash gives one slot, and the fingerprint
tells whether the key is there at all, so an access costs the same however many
documents are kept. Files are written under a name of their own and then
renamed, so a task that runs twice leaves the same files.
"""

from __future__ import annotations

import io
import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.tokens import TOKENIZER, encoder, wide
from ledgerloom.llm.words import arrow_schema, map_rows, mixed, text_bytes, to_batch
from ledgerloom.session import shared_dir, shared_table

END_ID = 2
#: Keys of one index file; what a reader of one bucket holds in memory.
BUCKET_KEYS = 250_000
#: Bits of a level for each key that is still without a slot.
_SPARSE = 2
_LEVELS = 64
_PLACES = "doc_id bigint, copy bigint, shard int, first bigint, n_tokens bigint"


def _hashes(keys: np.ndarray, seed: int) -> np.ndarray:
    step = np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % (1 << 64))
    return mixed(keys.astype(np.int64).view(np.uint64) + step)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys.

    On each level a key has one bit; keys alone on theirs settle there, the
    others go to the next level. The slot of a key is the number of settled
    bits before its own.
    """

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        counts = [0]
        self.ranks = []
        for bits in levels:
            running = np.cumsum(bits, dtype=np.int64)
            self.ranks.append(running + counts[-1])
            counts.append(counts[-1] + (int(running[-1]) if len(running) else 0))

    @classmethod
    def over(cls, keys: np.ndarray) -> PerfectHash:
        """Built over ``keys``, which must be distinct."""
        levels = []
        left = keys
        while len(left):
            if len(levels) == _LEVELS:
                raise ValueError("the keys are not distinct")
            size = _SPARSE * len(left) + 1
            at = (_hashes(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for some, not all, of the keys that are not in the set."""
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (_hashes(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
            here = bits[at]
            found[left[here]] = ranks[at[here]] - 1
            left = left[~here]
        return found


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_hashes(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (_hashes(keys, 1 << 21) % np.uint64(buckets)).astype(np.int32)


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _put(folder: str, name: str, data: bytes) -> None:
    """Written under another name first, so that a file of this name is always whole."""
    store, path = _open(folder)
    own = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, f"{path}/{name}")


def write_shards(
    documents: DataFrame, folder: str, end_id: int = END_ID, tokenizer: str = TOKENIZER
) -> DataFrame:
    """Ids of all ``documents`` in shards by ascending ``doc_id``; returns where each is.

    Columns ``doc_id, copy, shard, first, n_tokens``: ``first`` counts ids of
    the shard, ``copy`` numbers rows of the same id within it. Null ids come first.
    Rows of one id are in order of a hash of their text, and may be in several
    shards, so that many of them, equal or not, are several tasks.
    """
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    order = ["doc_id", "draw", "row"]
    text = text_bytes()
    ranged = (
        documents.select("doc_id", text.alias("text"), F.xxhash64(text).alias("draw"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    schema = arrow_schema(documents.sparkSession, _PLACES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        end = np.array([end_id], "<u2").tobytes()
        shard = TaskContext.get().partitionId()
        files, root = _open(folder)
        name = f"ids-{shard:06d}.bin"
        own = f"{root}/.{name}-{uuid.uuid4().hex}"
        first, copy, last = 0, 0, object()
        with files.open_output_stream(own) as out:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                copies, firsts, counts = [], [], []
                for doc_id, text in zip(ids, batch.column(1), strict=True):
                    data = encode(text.as_py()) + end
                    out.write(data)
                    copy = copy + 1 if doc_id == last else 0
                    last = doc_id
                    copies.append(copy)
                    firsts.append(first)
                    counts.append(len(data) // 2)
                    first += counts[-1]
                yield to_batch(
                    {"doc_id": ids, "copy": copies, "shard": [shard] * len(ids), "first": firsts, "n_tokens": counts},
                    schema,
                )
        files.move(own, f"{root}/{name}")

    return ranged.mapInArrow(run, _PLACES)


def marked(places: DataFrame) -> DataFrame:
    """``places`` with ``indexed``: whether the row is the first of a key that is not null.

    A key that goes on in another shard has a row of ``copy`` 0 in each. It is
    then the least key of the later shard and the greatest of one before.
    """
    bounds = places.groupBy("shard").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    before = F.max("high").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    # At most one row for each shard, of which there are as many as partitions.
    goes_on = bounds.withColumn("before", before).where("low = before").select(F.col("shard").alias("of"), "low")
    here = (F.col("shard") == F.col("of")) & (F.col("doc_id") == F.col("low"))
    indexed = F.col("doc_id").isNotNull() & (F.col("copy") == 0) & F.col("low").isNull()
    return places.join(F.broadcast(goes_on), here, "left").select(*places.columns, indexed.alias("indexed"))


def write_index(places: DataFrame, folder: str, bucket_keys: int = BUCKET_KEYS) -> int:
    """Index files over the keys of ``places`` that are ``indexed``; returns the number of buckets.

    Only the first row of a key is, and no null key.
    """
    keyed = places.where("indexed")
    buckets = max(1, math.ceil(keyed.count() / bucket_keys))

    def with_bucket(batch: dict[str, list]):
        keys = np.array(batch["doc_id"], np.int64)
        yield {name: batch[name] for name in ("doc_id", "shard", "first", "n_tokens")} | {
            "bucket": _bucket(keys, buckets)
        }

    def build(table: pa.Table) -> pa.Table:
        keys = table.column("doc_id").to_numpy()
        bucket = table.column("bucket")[0].as_py()
        found = PerfectHash.over(keys)
        order = np.empty(len(keys), np.int64)
        order[found.slots(keys)] = np.arange(len(keys))
        data = io.BytesIO()
        np.savez(
            data,
            fingerprint=_fingerprints(keys)[order],
            shard=table.column("shard").to_numpy()[order],
            first=table.column("first").to_numpy()[order],
            n_tokens=table.column("n_tokens").to_numpy()[order],
            sizes=np.array([len(bits) for bits in found.levels], np.int64),
            bits=np.packbits(np.concatenate([*found.levels, np.zeros(0, bool)])),
        )
        _put(folder, f"index-{bucket:06d}.npz", data.getvalue())
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "keys": pa.array([len(keys)], pa.int64())})

    rows = map_rows(keyed, with_bucket, "doc_id bigint, shard int, first bigint, n_tokens bigint, bucket int")
    rows.groupBy("bucket").applyInArrow(build, "bucket int, keys bigint").write.format("noop").mode(
        "overwrite"
    ).save()
    return buckets


class Index:
    """One bucket of the index, read from its file."""

    def __init__(self, folder: str, bucket: int) -> None:
        store, path = _open(folder)
        with store.open_input_file(f"{path}/index-{bucket:06d}.npz") as file:
            parts = np.load(io.BytesIO(file.read()))
        sizes = parts["sizes"]
        bits = np.unpackbits(parts["bits"], count=int(sizes.sum())).astype(bool)
        self._hash = PerfectHash(np.split(bits, np.cumsum(sizes)[:-1]) if len(sizes) else [])
        self._fingerprint = parts["fingerprint"]
        self._columns = {name: parts[name] for name in ("shard", "first", "n_tokens")}

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Which keys are there, and shard, first id and number of ids of those."""
        slots = self._hash.slots(keys)
        known = slots >= 0
        known[known] = self._fingerprint[slots[known]] == _fingerprints(keys[known])
        return known, {name: values[slots[known]] for name, values in self._columns.items()}


def locate(keys: DataFrame, folder: str, buckets: int) -> DataFrame:
    """``doc_id, shard, first, n_tokens`` of the ``doc_id`` of ``keys`` that the index has.

    An unknown key passes for a known one with a chance of 2**-32.
    """

    def with_bucket(batch: dict[str, list]):
        found = np.array(batch["doc_id"], np.int64)
        yield {"doc_id": found, "bucket": _bucket(found, buckets)}

    def find(batch: dict[str, list]):
        keys_, own = np.array(batch["doc_id"], np.int64), np.array(batch["bucket"])
        for bucket in np.unique(own):
            if held.get("bucket") != bucket:
                held.update(bucket=bucket, index=Index(folder, int(bucket)))
            asked = keys_[own == bucket]
            known, columns = held["index"].find(asked)
            yield {"doc_id": asked[known], **columns}

    held: dict = {}
    rows = map_rows(keys.where("doc_id is not null"), with_bucket, "doc_id bigint, bucket int")
    near = rows.repartition("bucket").sortWithinPartitions("bucket")
    return map_rows(near, find, "doc_id bigint, shard int, first bigint, n_tokens bigint")


def read_ids(places: DataFrame, folder: str) -> DataFrame:
    """``places`` with ``ids_crc32`` and ``ids`` (16-bit) read from the shards.

    Rows are brought together by shard and read in order, each with one seek.
    """
    return _read(places, folder, True)


def read_checks(places: DataFrame, folder: str) -> DataFrame:
    """As ``read_ids``, without the ids themselves."""
    return _read(places, folder, False)


def _read(places: DataFrame, folder: str, with_ids: bool) -> DataFrame:
    near = places.repartition("shard", F.floor(F.col("first") / (1 << 20))).sortWithinPartitions("shard", "first")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in places.schema)
    names = places.columns

    def rows(batch: dict[str, list]):
        store, path = _open(folder)
        shards = np.array(batch["shard"])
        checks, payloads = [], []
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if begin == end:
                continue
            with store.open_input_file(f"{path}/ids-{shards[begin]:06d}.bin") as file:
                for at in range(begin, end):
                    file.seek(2 * batch["first"][at])
                    ids = file.read(2 * batch["n_tokens"][at])
                    checks.append(zlib.crc32(wide(ids).tobytes()))
                    if with_ids:
                        payloads.append(ids)
        yield {name: batch[name] for name in names} | {"ids_crc32": checks} | ({"ids": payloads} if with_ids else {})

    return map_rows(near, rows, schema + ", ids_crc32 bigint" + ", ids binary" * with_ids)


def new_folder(spark: SparkSession) -> str:
    """A folder of its own under the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"


def write_and_read(
    documents: DataFrame, folder: str, end_id: int = END_ID, tokenizer: str = TOKENIZER
) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back by key.

    ``start`` counts the ids of all documents before it in order of id. A null
    or empty text is the end id alone. Of several rows with one id the index
    finds the first; the others, and rows without an id, are read by the place
    at which they were written. An empty table gives no row; other columns are
    not read.
    """
    spark = documents.sparkSession
    written = shared_table(marked(shared_table(write_shards(documents, folder, end_id, tokenizer))))
    buckets = write_index(written, folder)
    shards = written.groupBy("shard").agg(F.sum("n_tokens").alias("n_ids"), F.count("*").alias("n_documents"))
    shards.write.parquet(f"{folder}/shards.parquet")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        spark.read.schema(shards.schema)
        .parquet(f"{folder}/shards.parquet")
        .select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("shard_start"))
    )
    by_key = locate(written.where("indexed").select("doc_id"), folder, buckets)
    by_place = written.where("not indexed").select(*by_key.columns)
    read = read_checks(by_key.unionByName(by_place), folder)
    # One row for each shard, and a shard holds many documents.
    return read.join(starts, "shard").select(
        "doc_id", (F.col("shard_start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )

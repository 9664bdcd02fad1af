"""Words of whole texts and their hashes, for work on Arrow batches.

A word is a run of bytes other than space and the controls 0x09 to 0x0D, which
is what ``bytes.split`` yields. Texts travel as UTF-8 bytes, so nothing is decoded.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as a pattern for Spark and for DuckDB.
WORD = r"[^\x20\x09-\x0D]+"
#: Words whose hash a worker keeps; beyond it the store starts anew.
KEPT_WORDS = 400_000
#: Bytes of a batch of texts that are turned into Python lists at once.
BYTES_AT_ONCE = 8 << 20
#: Bytes of the batches in which Spark hands rows to Python and holds them outside its heap, where the session does not say.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Odd factor of the rolling combination of word hashes.
_FACTOR = 0x9E3779B97F4A7C15


#: The stores of this worker, by what they hold.
_STORES: dict[str, list[WordStore]] = {}


def empty_stores(kept: Sequence[str] = ()) -> None:
    """Give up what a worker holds from work of another kind, but for the stores named in ``kept``."""
    for name, stores in _STORES.items():
        if name not in kept:
            for store in stores:
                store.clear()


def give_back() -> None:
    """Leave little in a worker that has done its task: idle ones stay beside work that needs the memory.

    Hashes of words are given up, as they are soon found again; tokens are kept.
    """
    for store in _STORES.get("hashes", []):
        store.clear()
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


class WordStore(dict):
    """Value per word, computed once; emptied when ``limit`` words are held."""

    def __init__(self, value: Callable[[bytes], Any], limit: int = KEPT_WORDS, name: str = "tokens") -> None:
        super().__init__()
        self._value = value
        self._limit = limit
        _STORES.setdefault(name, []).append(self)

    def __missing__(self, word: bytes) -> Any:
        if len(self) >= self._limit:
            self.clear()
        found = self[word] = self._value(word)
        return found


#: One per Python worker, which Spark reuses from task to task.
_HASHES = WordStore(xxhash.xxh3_64_intdigest, name="hashes")


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash for each word."""
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Values spread over 64 bits, so that their order is as good as random."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` successive words; empty if there are fewer."""
    count = len(hashes) - size + 1
    if count < 1:
        return np.empty(0, np.uint64)
    total = hashes[:count].copy()
    for shift in range(1, size):
        total *= np.uint64(_FACTOR)
        total += hashes[shift : shift + count]
    return mixed(total)


def covered(starts: np.ndarray, size: int, n_words: int) -> np.ndarray:
    """Which words lie in a window of ``size`` words that begins at one of ``starts``."""
    steps = np.zeros(n_words + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + size, n_words), -1)
    return np.cumsum(steps[:n_words]) > 0


def text_bytes(name: str = "text") -> Column:
    """The text as UTF-8 bytes, which is how Spark holds it."""
    return F.col(name).cast("binary")


def shielded(documents: DataFrame, needed: Sequence[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``documents`` with all but the ``needed`` columns under names of no meaning, and what names them as before.

    So no column that work adds meets one of the caller's, whatever that is called.
    """
    names = [name if name in needed else f"_column_{place}" for place, name in enumerate(documents.columns)]
    before = list(documents.columns)

    def named(found: DataFrame) -> DataFrame:
        return found.select(*names).toDF(*before)

    return documents.toDF(*names), named


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this library to the executors, once for each application.

    The archive is a driver's local file, which Spark serves to the executors.
    Where the session has no bound on the bytes of its Arrow batches, it gets ``BATCH_BYTES``.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ledgerloom-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)


def map_rows(
    frame: DataFrame,
    rows: Callable[[dict[str, list]], Iterable[dict[str, Any]]],
    schema: str,
    at_once: int | None = None,
    stores: Sequence[str] | None = None,
) -> DataFrame:
    """``mapInArrow`` for a function from the lists of one batch to column arrays.

    ``rows`` gets a dict of Python lists and yields dicts of equally long
    columns, so a large batch may answer in several small ones. With ``at_once`` it
    gets parts of a batch of about so many bytes, one row at least. ``stores`` names
    the word stores that the work uses; the worker empties the others first.
    """
    ship_package(frame.sparkSession)
    arrow = arrow_schema(frame.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if stores is not None:
            empty_stores(stores)
        try:
            for batch in batches:
                for part in parted(batch, at_once) if at_once else [batch]:
                    for found in rows(part.to_pydict()):
                        yield to_batch(found, arrow)
        finally:
            give_back()

    return frame.mapInArrow(run, schema)


def parted(batch: pa.RecordBatch, at_once: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``at_once`` bytes, or of one row."""
    if batch.num_rows < 2 or batch.nbytes <= at_once:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from parted(batch.slice(0, half), at_once)
        yield from parted(batch.slice(half), at_once)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    """Arrow form of a schema given as text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def to_batch(columns: dict[str, Any], schema: pa.Schema) -> pa.RecordBatch:
    """Columns, as lists or arrays, in the order and types of ``schema``."""
    return pa.RecordBatch.from_arrays(
        [
            columns[field.name].cast(field.type)
            if isinstance(columns[field.name], pa.Array)
            else pa.array(columns[field.name], field.type)
            for field in schema
        ],
        schema=schema,
    )


def list_array(values: np.ndarray, lengths: Iterable[int]) -> pa.Array:
    """List column of 64-bit integers from flat values and the length of each row."""
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(lengths, np.int64))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))

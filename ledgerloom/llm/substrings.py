"""Removal of repeated word spans by compaction of a De Bruijn graph of token k-mers.

Edges of the graph are the windows of ``WINDOW`` successive words, and a window
is repeated if its edge occurs more than once. All edges of a corpus are too
many to shuffle, so each document first compacts its own path: successive
windows that have the same least k-mer, the anchor, are one run, about a twelfth
as many rows. Only runs whose anchor occurs again can hold a repeated window.

Joins on anchors then compact further. Where all runs of an anchor are equal,
the path does not branch there, and each run is repeated as a whole; so is a run
that occurs more than once beside others. Only runs that occur once and whose
anchor has other runs, which is where paths branch, are spelled out window by
window from the text at their source coordinates, together with one run of each
of the others.

Windows are compared by anchor and window hash, 128 bits together.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import (
    list_array,
    map_rows,
    mixed,
    shielded,
    text_bytes,
    window_hashes,
    word_hashes,
)
from ledgerloom.session import drop_table, shared_table

WINDOW = 35
#: Words of an anchor.
ANCHOR = 11
#: A run has at most ``WINDOW - ANCHOR + 1`` windows, a bit for each.
MASK_BITS = WINDOW - ANCHOR + 1
#: Marks a span that is a whole stretch of starts.
WHOLE = 1 << 62
#: Source coordinates that may be broadcast to the texts.
BROADCAST_ROWS = 1_000_000
_ROW = ("doc_id", "row_key")


def row_key() -> Column:
    """Tells texts of one id apart; equal rows share it and have the same spans."""
    return F.xxhash64("doc_id", "text")


def anchor_runs(hashes: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Runs of successive windows with one anchor: anchor hash, hash of the run, start, windows, times.

    Equal runs that follow each other, as in a text that repeats a phrase, are
    one row with the number of times.
    """
    windows = window_hashes(hashes, window)
    if not len(windows):
        return (windows, windows, windows, windows, windows)
    kmers = window_hashes(hashes, anchor)
    width = window - anchor + 1
    at = np.lib.stride_tricks.sliding_window_view(kmers, width).argmin(1) + np.arange(len(windows))
    starts = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    counts = np.diff(np.concatenate([starts, [len(windows)]]))
    # The first and the last window of a run overlap, so together they are all of its words.
    runs = mixed(windows[starts] * np.uint64(3) + windows[starts + counts - 1]) + counts.astype(np.uint64)
    anchors = kmers[at[starts]]
    new = np.concatenate([[True], (np.diff(runs) != 0) | (np.diff(anchors) != 0)])
    times = np.diff(np.concatenate([np.flatnonzero(new), [len(new)]]))
    return anchors[new], runs[new], starts[new].astype(np.uint64), counts[new].astype(np.uint64), times.astype(np.uint64)


def document_runs(documents: DataFrame) -> DataFrame:
    """``doc_id, row_key`` and the runs of each document, as arrays ``anchor, run, start, windows, times``."""
    names = ("anchor", "run", "start", "windows", "times")

    def rows(batch: dict[str, list]):
        found = [anchor_runs(word_hashes(text.split())) for text in batch["text"]]
        lengths = [len(own[0]) for own in found]
        columns = {
            name: list_array(np.concatenate([own[place] for own in found] or [np.empty(0, np.uint64)]), lengths)
            for place, name in enumerate(names)
        }
        yield {name: batch[name] for name in _ROW} | columns

    frame = documents.select("doc_id", row_key().alias("row_key"), text_bytes().alias("text"))
    arrays = ", ".join(f"{name} array<bigint>" for name in names)
    return map_rows(frame.where("text is not null"), rows, f"doc_id bigint, row_key bigint, {arrays}")


def spelled_windows(places: DataFrame, documents: DataFrame) -> DataFrame:
    """``anchor, run, n, offset, window``: each window of the runs at ``places``, from the texts there."""
    run = F.struct("anchor", "run", "n", "start", "windows")
    by_row = places.groupBy(*_ROW).agg(F.collect_list(run).alias("runs"))
    by_row = by_row.select(F.col("doc_id").alias("at_id"), F.col("row_key").alias("at_key"), "runs")
    if places.count() <= BROADCAST_ROWS:
        by_row = F.broadcast(by_row)
    texts = documents.select("doc_id", row_key().alias("row_key"), text_bytes().alias("text"))
    here = F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("row_key") == F.col("at_key"))

    def rows(batch: dict[str, list]):
        for text, runs in zip(batch["text"], batch["runs"], strict=True):
            windows = window_hashes(word_hashes(text.split()), WINDOW)
            columns = [np.array([run[name] for run in runs], np.int64) for name in ("anchor", "run", "n", "start", "windows")]
            anchor, run, n, start, count = columns
            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            yield {
                "anchor": np.repeat(anchor, count),
                "run": np.repeat(run, count),
                "n": np.repeat(n, count),
                "offset": offset,
                "window": windows[np.repeat(start, count) + offset].view(np.int64),
            }

    joined = texts.join(by_row, here).select("text", "runs")
    return map_rows(joined, rows, "anchor bigint, run bigint, n bigint, offset int, window bigint")


def repeated_spans(documents: DataFrame) -> DataFrame:
    """``doc_id, row_key, spans``: where repeated windows start, for the rows that have any.

    A span is a whole stretch of starts, ``WHOLE | start << 31 | number``, or
    part of a run, ``start << MASK_BITS | mask``, where bit ``i`` of the mask
    says that a repeated window starts at word ``start + i``.
    """
    by_row = shared_table(document_runs(documents))
    runs = by_row.select(*_ROW, F.inline(F.arrays_zip("anchor", "run", "start", "windows", "times")))
    # Written first, so that Spark can split the rows of a frequent anchor when they are joined.
    again = shared_table(runs.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor"))
    found = shared_table(runs.join(again, "anchor"))
    drop_table(by_row)
    at = F.min(F.struct(*_ROW, "start", "windows")).alias("at")
    counted = found.groupBy("anchor", "run").agg(F.sum("times").alias("n"), at)
    kinds = shared_table(counted.select("anchor", "run", "n", "at.*"))
    branching = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    branching = shared_table(branching.where("kinds > 1 and least = 1").select("anchor"))
    places = shared_table(kinds.join(branching, "anchor"))
    spelled = shared_table(spelled_windows(places, documents))
    twice = spelled.groupBy("anchor", "window").agg(F.sum("n").alias("total")).where("total > 1")
    bits = F.bit_or(F.expr("shiftleft(1L, offset)")).alias("mask")
    masks = spelled.where("n = 1").join(twice, ["anchor", "window"]).groupBy("anchor", "run").agg(bits)
    in_part = places.where("n = 1").join(masks, ["anchor", "run"])
    mask = F.shiftleft("start", MASK_BITS).bitwiseOR(F.col("mask"))
    whole = found.join(kinds.where("n > 1").select("anchor", "run"), ["anchor", "run"])
    stretch = F.lit(WHOLE).bitwiseOR(F.shiftleft("start", 31)).bitwiseOR(F.col("windows") * F.col("times"))
    spans = whole.select(*_ROW, stretch.alias("span")).unionByName(in_part.select(*_ROW, mask.alias("span")))
    # Rows alike in id and text have the same spans; each task passes them on once.
    return spans.groupBy(*_ROW).agg(F.collect_set("span").alias("spans"))


def repeated_words(spans: list[int] | None, n_words: int) -> np.ndarray:
    """Which words of a text are covered by its repeated windows."""
    entries = np.array(spans or [], np.int64)
    whole = entries & WHOLE != 0
    stretches, parts = entries[whole] & ~WHOLE, entries[~whole]
    starts = [(parts >> MASK_BITS)[(parts >> bit) & 1 == 1] + bit for bit in range(MASK_BITS)]
    alone = np.concatenate(starts)
    begin = np.concatenate([stretches >> 31, alone])
    number = np.concatenate([stretches & ((1 << 31) - 1), np.ones(len(alone), np.int64)])
    steps = np.zeros(n_words + 1, np.int32)
    np.add.at(steps, begin, 1)
    np.add.at(steps, begin + number + WINDOW - 1, -1)
    return np.cumsum(steps[:n_words]) > 0


def removed(documents: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every row, with counts of words and removed words, and the words left, joined by one space."""
    spans = repeated_spans(documents).select(
        F.col("doc_id").alias("_substrings_id"), F.col("row_key").alias("_substrings_key"), F.col("spans").alias("_substrings_spans")
    )
    here = F.col("doc_id").eqNullSafe(F.col("_substrings_id")) & (row_key() == F.col("_substrings_key"))
    joined = documents.join(spans, here, "left").select(*keep, text_bytes().alias("_substrings_text"), "_substrings_spans")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema)

    def rows(batch: dict[str, list]):
        sizes, gone, left = [], [], []
        for text, spans in zip(batch["_substrings_text"], batch["_substrings_spans"], strict=True):
            words = (text or b"").split()
            repeated = repeated_words(spans, len(words))
            sizes.append(len(words))
            gone.append(int(repeated.sum()))
            left.append(b" ".join([word for word, drop in zip(words, repeated.tolist(), strict=True) if not drop]))
        yield {name: batch[name] for name in keep} | {"_substrings_words": sizes, "_substrings_removed": gone, "_substrings_kept": left}

    return map_rows(joined, rows, f"{kept}, _substrings_words bigint, _substrings_removed bigint, _substrings_kept binary")


def dedup_substrings(documents: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, text`` of every document; ``text`` is its kept words, joined by one space.

    A word is removed if a window of ``WINDOW`` words that covers it also starts
    somewhere else, in the same document or another one. All places are judged
    on the input. A null text has no words; a text shorter than a window keeps
    all; repeated rows, and copies, lose every word that is in a window; an empty
    table gives no row; ids may be null or repeated; other columns are not read.
    """
    found = removed(documents, ["doc_id"])
    return found.select(
        "doc_id",
        F.col("_substrings_words").alias("n_words"),
        F.col("_substrings_removed").alias("n_removed"),
        F.col("_substrings_kept").cast("string").alias("text"),
    )


def without_repeats(documents: DataFrame) -> DataFrame:
    """``documents``, all rows and columns, with the kept words as ``text`` where any are removed.

    ``n_chars``, if there is such a column, is the length of the new text. A null or
    empty text stays as it is; repeated rows lose the same words; an empty table
    gives no row; other columns, of any name, are kept as they are.
    """
    documents, named = shielded(documents, ("doc_id", "text", "n_chars"))
    found = removed(documents, documents.columns)
    text = F.when(F.col("_substrings_removed") > 0, F.col("_substrings_kept").cast("string")).otherwise(F.col("text"))
    result = found.withColumn("text", text)
    if "n_chars" in documents.columns:
        length = F.when(F.col("_substrings_removed") > 0, F.length("text").cast(documents.schema["n_chars"].dataType))
        result = result.withColumn("n_chars", F.coalesce(length, "n_chars"))
    return named(result)

"""N-gram Jaccard join with adaptive multi-match prefixes, and the groups it links.

A document is the set of its shingles, sorted by one global order in which
frequent shingles come last. Two documents with a Jaccard similarity of at least
``t`` share at least ``k`` shingles among the first ``n - ceil(t * n) + k`` of
each, for every ``k``. So a document whose short prefix would meet many others
takes a longer one and asks for more matches; a pair is verified if it shares as
many as the less demanding of the two asks for. The place of a match bounds the
overlap that is still possible, which leaves out most pairs that cannot reach
the threshold.

Documents with the same set are one class. Classes are joined in two steps that
find every link between groups and do not list all pairs within one. First each
class is verified against one class near the middle of its neighbourhood. Then
pairs of classes that are not yet in one group are verified, all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.words import (
    BYTES_AT_ONCE,
    arrow_schema,
    empty_stores,
    give_back,
    list_array,
    map_rows,
    parted,
    shielded,
    ship_package,
    text_bytes,
    to_batch,
    window_hashes,
    word_hashes,
)
from ledgerloom.session import drop_table, shared_table

SIZE = 5
#: The threshold as a fraction, so that it is compared in whole numbers.
NUMERATOR, DENOMINATOR = 75, 100
#: Matches that the longest prefixes ask for.
MOST_MATCHES = 4
#: Slots of the table of shingle counts, which bounds what the driver gathers.
SLOTS = 1 << 20
#: A task reports a slot that holds this many times its mean, and this many more.
STANDS_OUT = 4
#: Meetings expected of a prefix for which it is lengthened by one; doubled for each further one.
COSTLY = 64
#: Early matches asked of a pair: so many, and one more for each ``EARLY_SHARE`` shingles, or all that are sure if fewer.
EARLY_MATCHES = 4
EARLY_SHARE = 20
#: Allowed for the rounding of distances.
ROUNDING = 1e-9
#: Documents of a cluster that are verified together, about, with as many others.
BLOCK = 256
#: Classes of either side that meet in one cell, about.
COUNT_BLOCK = 128
#: Meetings that a task holds at once.
HELD_MEETINGS = 400_000
#: Rows of four numbers that may be broadcast to the texts.
BROADCAST_ROWS = 500_000
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


#: What a row of a cell lists of its class.
_LISTED = ("shingle", "place")
#: What work here keeps of the words a worker has met.
_KEPT = ("hashes",)


def repeated_shingles(text: bytes | None, size: int = SIZE) -> np.ndarray:
    """Hashes of the runs of ``size`` words in lower case (A-Z only), in their order, each as often as it occurs.

    A text with fewer words has its whole sequence as one; one without words, none.
    """
    if not text:
        return np.empty(0, np.uint64)
    hashes = word_hashes(text.translate(_UPPER).split())
    if not len(hashes):
        return np.empty(0, np.uint64)
    short = len(hashes) < size
    # The length is mixed in, so that a short text is no shingle of a longer one.
    return window_hashes(hashes, len(hashes)) + np.uint64(len(hashes)) if short else window_hashes(hashes, size)


def shingles(text: bytes | None, size: int = SIZE) -> np.ndarray:
    """The distinct ``repeated_shingles``, sorted."""
    return np.unique(repeated_shingles(text, size))


def shingle_counts(documents: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """Estimated occurrences of the shingles of each slot, 0 where they are not above the usual.

    Over all documents. Tasks report the slots that stand out in their part; only
    frequent shingles make a slot stand out, and at most ``slots`` sums reach the
    driver. The order built from it is the same for all documents, which is what
    results depend on; how well it is estimated decides on the cost alone.
    """
    schema = "slot int, n bigint"
    ship_package(documents.sparkSession)
    arrow = arrow_schema(documents.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty_stores(_KEPT)
        counts = np.zeros(slots, np.int64)
        for batch in batches:
            for part in parted(batch, BYTES_AT_ONCE):
                found = np.concatenate([*map(repeated_shingles, part.column("text").to_pylist()), np.empty(0, np.uint64)])
                counts += np.bincount((found % np.uint64(slots)).astype(np.int64), minlength=slots)
        slot = np.flatnonzero(counts > STANDS_OUT * counts.mean() + STANDS_OUT)
        yield to_batch({"slot": slot, "n": counts[slot]}, arrow)
        del counts
        give_back()

    parts = documents.select(text_bytes().alias("text")).mapInArrow(run, schema)
    sums = parts.groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    found = np.zeros(slots, np.int32)
    found[sums["slot"].to_numpy(np.int64)] = np.minimum(sums["n"].to_numpy(np.int64), np.iinfo(np.int32).max)
    return found


def least_overlap(n: int) -> int:
    """Shingles that a set of ``n`` shares at least with any set it is linked to."""
    return -(-NUMERATOR * n // DENOMINATOR)


def prefix(sorted_set: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The prefix of a set in the global order, and how many matches it asks for."""
    n = len(sorted_set)
    frequency = counts[(sorted_set % np.uint64(len(counts))).astype(np.int64)]
    ordered = np.argsort(frequency, kind="stable")  # by hash where equally frequent
    short = n - least_overlap(n) + 1
    met = int(frequency[ordered[:short]].sum())
    matches = 1 + (int(math.log2(met / COSTLY)) + 1 if met >= COSTLY else 0)
    matches = min(matches, MOST_MATCHES, n - short + 1)
    return sorted_set[ordered[: short + matches - 1]], matches


def signatures(documents: DataFrame, counts: np.ndarray, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``keep`` and ``n, set_id, matches, prefix`` of every document; ``set_id`` is 128 bits of the whole set."""
    shared = documents.sparkSession.sparkContext.broadcast(counts)

    def rows(batch: dict[str, list]):
        sets = [shingles(text) for text in batch["text"]]
        prefixes = [prefix(own, shared.value) if len(own) else (own, 0) for own in sets]
        lengths = [len(own) for own, _ in prefixes]
        flat = np.concatenate([own for own, _ in prefixes]) if prefixes else np.empty(0, np.uint64)
        yield {name: batch[name] for name in ("doc_id", *keep)} | {
            "n": [len(own) for own in sets],
            "set_id": [xxhash.xxh3_128_digest(own.tobytes()) for own in sets],
            "matches": [matches for _, matches in prefixes],
            "prefix": list_array(flat, lengths),
        }

    frame = documents.select("doc_id", *keep, text_bytes().alias("text"))
    kept = "".join(f", {f.name} {f.dataType.simpleString()}" for f in documents.select(*keep).schema)
    schema = f"doc_id bigint{kept}, n bigint, set_id binary, matches int, prefix array<bigint>"
    return map_rows(frame, rows, schema, BYTES_AT_ONCE, _KEPT)


def linkable(a: str, b: str) -> str:
    """SQL condition on sizes: sets of these sizes can reach the threshold."""
    small, large = f"least({a}, {b})", f"greatest({a}, {b})"
    return f"{DENOMINATOR} * {small} >= {NUMERATOR} * {large}"


def postings(classes: DataFrame) -> DataFrame:
    """``shingle, id, n, matches, place`` for the prefix of each class, where the shingle is in several.

    Counts are summed before they are shuffled, and rows of a frequent shingle
    are joined to one row of it, so no task must take all of them. As everywhere
    here, sums are written before they are joined, so that Spark can split the
    rows of a frequent key.
    """
    exploded = classes.select("id", "n", "matches", F.posexplode("prefix").alias("place", "shingle"))
    several = exploded.groupBy("shingle").agg(F.count("*").alias("met")).where("met > 1")
    return exploded.join(shared_table(several.select("shingle")), "shingle")


def hub_pairs(found: DataFrame) -> DataFrame:
    """For each class the hub that most of its prefix agrees on, as ``cluster, a, b``.

    The hub of a shingle is the class in which it comes first, which is one with
    few shingles of its own.
    """
    first = found.groupBy("shingle").agg(F.min(F.struct("place", "id", "n")).alias("first"))
    hubs = first.select("shingle", F.col("first.id").alias("hub"), F.col("first.n").alias("hub_n"))
    met = found.join(shared_table(hubs), "shingle").where("id <> hub and " + linkable("n", "hub_n"))
    votes = met.groupBy("id", "hub").agg(F.count("*").alias("votes"))
    best = votes.groupBy("id").agg(F.max_by("hub", F.struct("votes", -F.col("hub"))).alias("hub"))
    return best.select(F.col("hub").alias("cluster"), F.col("hub").alias("a"), F.col("id").alias("b"))


def _in_groups(found: DataFrame, groups: DataFrame) -> DataFrame:
    labels = groups.select("id", F.col("component").alias("group_id"))
    return found.join(labels, "id", "left").withColumn("group_id", F.coalesce("group_id", "id"))


def _main_groups(labelled: DataFrame) -> DataFrame:
    """``shingle, main``: the group that most classes of a shingle are in, where they are in several."""
    sums = labelled.groupBy("shingle", "group_id").agg(F.count("*").alias("n_own"))
    several = sums.groupBy("shingle").agg(
        F.count("*").alias("n_groups"), F.max_by("group_id", F.struct("n_own", "group_id")).alias("main")
    )
    return several.where("n_groups > 1").select("shingle", "main")


def open_pairs(found: DataFrame, groups: DataFrame, hubs: DataFrame) -> DataFrame:
    """Pairs ``cluster, a, b`` of classes in different groups that pass all filters.

    For each shingle, classes outside the group that most of its classes are in
    meet all classes of other groups; classes within a group never meet. The
    cluster of a pair is a group in its neighbourhood, most often the same for
    all that resemble it. ``hubs`` is what ``verified`` found for each class and its
    hub: two classes whose distances from the same hub differ by more than a link
    allows are not linked, as the Jaccard distance obeys the triangle inequality.

    Classes meet in cells: those outside the main group and those of its shingles
    are dealt into blocks, and a cell has one block of each with their shingles.
    A task counts the matches of its cells, so that a pair is passed on once, with
    a sum, and not once for each shingle; and only if the sum, and what the two may
    share in other cells, is as much as is asked for.
    """
    known = hubs.select(F.col("b").alias("id"), F.col("a").alias("hub"), "far")
    labelled = _in_groups(found, groups).join(known, "id", "left")
    main = shared_table(_main_groups(labelled))
    open_ = labelled.join(main, "shingle").select(
        "main", "shingle", "id", "n", "matches", "place", "group_id",
        F.coalesce("hub", "id").alias("hub"), F.coalesce("far", F.lit(float("nan"))).alias("far"),
    )
    # What is said of a class is shuffled once for each cell, and not for each shingle in it.
    listed = open_.groupBy("main", "id", "n", "matches", "group_id", "hub", "far").agg(
        F.collect_list(F.struct("shingle", "place")).alias("met")
    )
    listed = shared_table(listed)
    drop_table(main)
    own = listed.groupBy("main", "id").agg(
        F.sum(F.size("met")).alias("here"), F.max(F.col("group_id") != F.col("main")).alias("outside")
    )
    own = shared_table(own)
    whole = shared_table(own.groupBy("id").agg(F.sum("here").alias("all")))
    sizes = own.groupBy("main").agg(F.count_if("outside").alias("x"), F.count("*").alias("y"))
    blocks = [F.ceil(F.col(side) / COUNT_BLOCK).cast("int").alias(f"{side}_blocks") for side in "xy"]
    sizes = shared_table(sizes.select("main", *blocks))
    placed = own.join(sizes, "main").join(whole, "id")
    own_block = [F.pmod(F.xxhash64("id"), f"{side}_blocks").cast("int").alias(f"{side}_own") for side in "xy"]
    placed = shared_table(
        placed.select("main", "id", "outside", (F.col("all") - F.col("here")).alias("others"), "x_blocks", "y_blocks", *own_block)
    )
    rows = listed.join(placed, ["main", "id"])

    def every(side: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(f"{side}_blocks") - 1))

    kept = ["main", "id", "n", "matches", "group_id", "hub", "far", "others", *[F.col(f"met.{name}") for name in _LISTED]]
    x = rows.where("outside").select(*kept, F.lit(True).alias("first"), F.col("x_own").alias("low"), every("y").alias("high"))
    y = rows.select(*kept, F.lit(False).alias("first"), F.col("y_own").alias("high"), every("x").alias("low"))
    cell = ["main", "low", "high"]
    dealt = x.unionByName(y).repartition(*cell).sortWithinPartitions(*cell)
    counts = _counted(dealt).groupBy("a", "b").agg(
        F.sum("shared").alias("shared"), F.min("asked").alias("asked"), F.min("main").alias("cluster")
    )
    return counts.where("shared >= asked").select("cluster", "a", "b")


def _counted(cells: DataFrame) -> DataFrame:
    """``main, a, b, shared, asked``: matches of the pairs of each cell, whose rows adjoin and list ``shingle`` and ``place``."""
    schema = "main bigint, a bigint, b bigint, shared bigint, asked bigint"
    ship_package(cells.sparkSession)
    arrow = arrow_schema(cells.sparkSession, schema)
    names = cells.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty_stores()
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column("shingle").value_lengths().to_numpy(zero_copy_only=False)
            new = {name: batch.column(name) for name in names}
            new = {
                name: (column.flatten() if name in _LISTED else column).to_numpy(zero_copy_only=False)
                for name, column in new.items()
            }
            new = {name: column if name in _LISTED else np.repeat(column, sizes) for name, column in new.items()}
            held = {name: np.concatenate([held[name], new[name]]) if held else new[name] for name in names}
            changes = np.any([np.diff(held[name]) != 0 for name in ("main", "low", "high")], axis=0)
            if changes.any():
                cut = int(np.flatnonzero(changes)[-1]) + 1
                yield to_batch(count_matches({name: column[:cut] for name, column in held.items()}), arrow)
                held = {name: column[cut:] for name, column in held.items()}
        if held:
            yield to_batch(count_matches(held), arrow)
        held = {}
        give_back()

    return cells.mapInArrow(run, schema)


def count_matches(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Matches that count of each pair of whole cells; of pairs that cannot reach what is asked of them, none."""
    changes = np.any([np.diff(rows[name], prepend=rows[name][:1]) != 0 for name in ("main", "low", "high")], axis=0)
    cell = np.cumsum(changes)
    ids, number = np.unique(rows["id"], return_inverse=True)
    # Rows of one shingle of one cell have one number.
    order = np.lexsort([rows["shingle"], cell])
    steps = (np.diff(rows["shingle"][order]) != 0) | (np.diff(cell[order]) != 0)
    met = np.empty(len(order), np.int64)
    met[order] = np.concatenate([[0], np.cumsum(steps)]) if len(order) else []
    left, right = np.flatnonzero(rows["first"]), np.flatnonzero(~rows["first"])
    right = right[np.argsort(met[right], kind="stable")]
    begin, end = (np.searchsorted(met[right], met[left], side) for side in ("left", "right"))
    sizes = end - begin
    keys, sums, asks = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    upto = np.cumsum(sizes)
    at = 0
    while at < len(left):
        # So many rows that they meet about ``HELD_MEETINGS`` others, one at least.
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + HELD_MEETINGS)))
        x = np.repeat(left[at:stop], sizes[at:stop])
        offset = np.arange(len(x)) - np.repeat(np.cumsum(sizes[at:stop]) - sizes[at:stop], sizes[at:stop])
        y = right[np.repeat(begin[at:stop], sizes[at:stop]) + offset]
        x, y, asked = _counting(rows, x, y)
        found, place, n = np.unique((cell[x] * len(ids) + number[x]) * len(ids) + number[y], return_index=True, return_counts=True)
        keys.append(found)
        sums.append(n)
        asks.append(asked[place])
        at = stop
    key, place, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    shared = np.bincount(which, np.concatenate(sums), len(key)).astype(np.int64)
    asked = np.concatenate(asks)[place]
    both, other = np.divmod(key, max(len(ids), 1))
    where, one = np.divmod(both, max(len(ids), 1))
    # What else a class has in other cells is the same in all rows of it in a cell.
    classes, row = np.unique(cell * len(ids) + number, return_index=True)
    rest = [rows["others"][row[np.searchsorted(classes, where * len(ids) + end)]] for end in (one, other)]
    enough = shared + np.minimum(*rest) >= asked
    a, b = ids[one[enough]], ids[other[enough]]
    main = rows["main"][np.searchsorted(cell, where[enough])]
    return {"main": main, "a": np.minimum(a, b), "b": np.maximum(a, b), "shared": shared[enough], "asked": asked[enough]}


def _counting(rows: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The meetings of rows ``x`` and ``y`` that count as matches, and how many are asked of their pair."""
    once = rows["group_id"][x] != rows["group_id"][y]
    once &= (rows["group_id"][y] == rows["main"][y]) | (rows["id"][x] < rows["id"][y])
    x, y = x[once], y[once]
    x_n, y_n = rows["n"][x], rows["n"][y]
    least = np.minimum(x_n, y_n)
    # Linked sets share so many; what a prefix leaves out of its set is the most that they share beyond it.
    overlap = -(-NUMERATOR * (x_n + y_n) // (NUMERATOR + DENOMINATOR))
    beyond = np.maximum(*[-(-NUMERATOR * n // DENOMINATOR) - rows["matches"][z] for n, z in ((x_n, x), (y_n, y))])
    asked = np.maximum(np.minimum(rows["matches"][x], rows["matches"][y]), overlap - beyond)
    # Fewer are asked for where many would let late matches count, which large groups have many of.
    asked = np.minimum(asked, EARLY_MATCHES + least // EARLY_SHARE)
    # The k-th match leaves at most this many shingles and the k - 1 before it.
    still = np.minimum(x_n - rows["place"][x], y_n - rows["place"][y]) + asked - 1
    counts = (still >= overlap) & (DENOMINATOR * least >= NUMERATOR * np.maximum(x_n, y_n))
    # Comparisons with a distance that is not known are false.
    far = np.abs(rows["far"][x] - rows["far"][y]) > 1 - NUMERATOR / DENOMINATOR + ROUNDING
    counts &= ~(far & (rows["hub"][x] == rows["hub"][y]))
    counts &= (rows["hub"][x] != rows["id"][y]) & (rows["hub"][y] != rows["id"][x])
    return x[counts], y[counts], asked[counts]


def verified(pairs: DataFrame, texts: DataFrame, repeated: bool = False) -> DataFrame:
    """``a, b, linked, far`` of each pair, from whole texts (``id``, ``text``).

    ``linked`` says that the sets reach the threshold, and ``far`` is their Jaccard
    distance, NULL where an id has several texts.

    ``pairs`` has ``cluster, a, b``. A cluster is dealt into blocks of about
    ``BLOCK`` documents, and the pairs of two blocks are verified together, so a
    text is shuffled once for each block it meets and not for each pair. With
    ``repeated``, rows alike in id and text are shuffled once for each task.
    """
    ends = F.explode(F.array("a", "b")).alias("id")
    # Read twice, and finding pairs is the larger part of the work.
    pairs = shared_table(pairs)
    sizes = shared_table(pairs.select("cluster", ends).distinct().groupBy("cluster").agg(F.count("*").alias("n")))

    def block(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.ceil(F.col("n") / BLOCK)).cast("int")

    cell = ["cluster", "low", "high"]
    low, high = F.least(block("a"), block("b")), F.greatest(block("a"), block("b"))
    dealt = shared_table(
        pairs.join(sizes, "cluster").select("cluster", low.alias("low"), high.alias("high"), "a", "b")
    )
    for table in (pairs, sizes):
        drop_table(table)
    members = dealt.select(*cell, ends).distinct()
    if dealt.count() <= BROADCAST_ROWS:
        members = F.broadcast(members)
    whole = texts.join(members, "id").select(*cell, "id", F.lit(None).cast("long").alias("other"), text_bytes().alias("text"))
    if repeated:
        whole = once_a_task(whole)
    asked = dealt.select(*cell, F.col("a").alias("id"), F.col("b").alias("other"), F.lit(None).cast("binary").alias("text"))
    # Texts have no other document, and so come before the pairs of their cell.
    near = whole.unionByName(asked).repartition(*cell).sortWithinPartitions(*cell, F.col("other").asc_nulls_first())
    held: dict = {}

    def rows(batch: dict[str, list]):
        found = []
        for cluster, low, high, doc, other, text in zip(*batch.values(), strict=True):
            if held.get("cell") != (cluster, low, high):
                held.update(cell=(cluster, low, high), sets={})
            sets = held["sets"]
            if other is None:
                own, known = shingles(text), sets.setdefault(doc, [])
                if not any(np.array_equal(own, other) for other in known):
                    known.append(own)
            else:
                met = [overlap(x, y) for x in sets[doc] for y in sets[other]]
                linked = any(DENOMINATOR * both >= NUMERATOR * either for both, either in met)
                found.append((doc, other, linked, 1 - met[0][0] / met[0][1] if len(met) == 1 else None))
        names = ("a", "b", "linked", "far")
        yield {name: [row[place] for row in found] for place, name in enumerate(names)}

    return map_rows(near, rows, "a bigint, b bigint, linked boolean, far double", BYTES_AT_ONCE, _KEPT)


def once_a_task(rows_: DataFrame) -> DataFrame:
    """``rows_`` without those that are equal to an earlier one of the same task."""
    seen: set = set()

    def rows(batch: dict[str, list]):
        new = []
        for place, row in enumerate(zip(*batch.values(), strict=True)):
            key = tuple(xxhash.xxh3_128_digest(own) if isinstance(own, bytes) else own for own in row)
            if key not in seen:
                seen.add(key)
                new.append(place)
        yield {name: [column[place] for place in new] for name, column in batch.items()}

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows_.schema)
    return map_rows(rows_, rows, schema, BYTES_AT_ONCE, _KEPT)


def overlap(first: np.ndarray, second: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and of the union of two sorted sets."""
    both = len(np.intersect1d(first, second, assume_unique=True))
    return both, len(first) + len(second) - both


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row for each row of ``documents``.

    ``component_id`` is the least id that can be reached by links, its own
    included. A null or empty text, and one of white space, has no shingles and
    no link. Rows with the same set are one class, copies among them. Rows of one
    id are linked each by its own text, and may so link what is linked to either.
    A row with a null id has the component of its class, if rows with an id have
    the same set, and else none. An empty table gives no row; other columns are
    not read.
    """
    return labelled(documents)


def labelled(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """What ``near_duplicates`` gives, with the columns ``keep``."""
    counts = shingle_counts(documents)
    full = shared_table(signatures(documents, counts, keep))
    signed = shared_table(full.select("doc_id", *keep, "n", "set_id"))
    # Copies meet as one sum per task; the row of the least id stands for its class.
    least = signed.where("n > 0 and doc_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("id"))
    classes_of = shared_table(least)
    own = (F.col("doc_id") == F.col("id")) & (F.col("set_id") == F.col("class_set"))
    classes = shared_table(
        full.join(classes_of.withColumnRenamed("set_id", "class_set"), own)
        .groupBy("id", "set_id")
        .agg(*[F.first(name).alias(name) for name in ("n", "matches", "prefix")], F.count("*").alias("copies"))
        .select("id", "n", "matches", "prefix", "copies")
    )
    repeated = not classes.where("copies > 1").isEmpty()
    drop_table(full)
    texts = documents.select(F.col("doc_id").alias("id"), "text")
    found = shared_table(postings(classes))
    drop_table(classes)
    hubs = shared_table(verified(hub_pairs(found), texts, repeated))
    linked = hubs.where("linked").select("a", "b")
    groups = components(linked)
    more = verified(open_pairs(found, groups, hubs), texts, repeated).where("linked").select("a", "b")
    final = components(linked.unionByName(more))
    for table in (found, hubs):
        drop_table(table)
    component = F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("doc_id"))
    return (
        signed.join(classes_of, "set_id", "left")
        .join(final, "id", "left")
        .select("doc_id", *keep, F.col("n").alias("n_shingles"), component.alias("component_id"))
    )


def row_key() -> Column:
    """Tells rows apart by id and text, in 64 bits."""
    return F.xxhash64("doc_id", "text")


def one_of_each(documents: DataFrame) -> DataFrame:
    """Rows of ``documents``, all columns, of which each group of near duplicates keeps the one of least id.

    Rows are linked each by its own text, whatever its id. Of a group the row with the
    least id stays, null last, of one id that with the least hash of the
    text, and of rows alike in id and text one. Rows without words stay. An empty
    table gives no row; other columns, of any name, are kept as they are.
    """
    documents, renamed = shielded(documents, ("doc_id", "text"))
    named = documents.select(row_key().alias("doc_id"), F.col("doc_id").alias("origin"), "text")
    found = labelled(named, ["origin"]).where("n_shingles > 0")
    keys = found.groupBy("component_id", "origin", F.col("doc_id").alias("key")).agg(F.count("*").alias("n"))
    keys = shared_table(keys)
    order = F.struct(F.col("origin").isNull().alias("none"), "origin", "key")
    least = keys.groupBy("component_id").agg(F.min(order).alias("least"))
    least = shared_table(least.select("component_id", F.col("least.origin").alias("stays"), F.col("least.key").alias("as")))
    stays = F.col("origin").eqNullSafe(F.col("stays")) & (F.col("key") == F.col("as"))
    # Keys whose rows do not all stay; of those that stay once, and of no others, ``once`` is true.
    changed = keys.join(least, "component_id").where(~stays | (F.col("n") > 1))
    changed = shared_table(changed.select(F.col("origin").alias("_copy_id"), F.col("key").alias("_copy_key"), stays.alias("_once")))
    here = F.col("doc_id").eqNullSafe(F.col("_copy_id")) & (row_key() == F.col("_copy_key"))
    result = documents.join(changed, here, "left_anti")
    repeated = changed.where("_once")
    if repeated.isEmpty():
        return renamed(result)
    # Equal rows meet as one row for each task.
    columns = [F.col(f"`{name}`") for name in documents.columns]
    rows = documents.join(repeated, here).groupBy("_copy_id", "_copy_key")
    first = rows.agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("_row")).select("_row.*")
    return renamed(result.unionByName(first))

"""How far the sources of a language diverge in their words, priced from joint tables of count levels.

A group is a (language, source), and its level for a term is how often the term
occurs there. What a pair of groups costs depends on nothing but the two levels
of each term, so all that has to be known of them is their joint table: for each
two levels, how many terms have the one here and the other there. Terms are the
rows of a matrix with an indicator column for each (group, level), level 0
included; that matrix transposed times itself holds the joint tables of all
pairs. It is multiplied in blocks: a cell has a part of the terms and two parts of
the groups, and takes its terms in strips. The entries are counts of at most the
terms of a strip, which single precision holds exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.words import (
    BYTES_AT_ONCE,
    arrow_schema,
    empty_stores,
    give_back,
    parted,
    ship_package,
    text_bytes,
    to_batch,
)
from ledgerloom.session import drop_table, shared_table

#: Documents of a language in which a term must be.
LEAST_DOCUMENTS = 30
#: Added to every count.
SMOOTHING = 5
#: What the probability 1 is written as.
UNIT = 1_000_000_000
#: Ranks of terms that are listed.
TOP_TERMS = 50
#: About so many terms, and groups of either side, of a cell of the product.
CELL_TERMS = 1024
CELL_GROUPS = 16
#: Terms of a strip.
STRIP = 32
#: Terms of groups whose counts a task holds before it hands them on.
HELD_TERMS = 400_000
#: What no term has.
GROUP_MARK = " "
#: A-Z to lower case; what is no letter and no byte of a character beyond ASCII becomes a space.
_TERMS = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if 97 <= byte <= 122 or byte >= 128 else 32 for byte in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, in lower case, and characters beyond ASCII."""
    return text.translate(_TERMS).split()


def term_parts(documents: DataFrame) -> DataFrame:
    """``lang, term, sources, n, docs``: for each term that a task has counted, lists by source; ``term_counts`` sums them up.

    A task counts on from batch to batch until it holds ``HELD_TERMS`` terms of its groups. A term leaves it once for
    all sources, so a row of it is keyed, copied and shuffled once and not for each of them. Each group has a row of
    its own besides, of a term that is no term: ``GROUP_MARK`` and the source.
    """
    plain = [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source")]
    frame = documents.select(*plain, F.coalesce(text_bytes(), F.lit(b"")).alias("text"))
    schema = "lang string, term string, sources array<string>, n array<bigint>, docs array<bigint>"
    ship_package(frame.sparkSession)
    arrow = arrow_schema(frame.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty_stores()
        found: dict[str, dict[str, tuple[Counter, Counter]]] = {}
        held = 0
        for batch in batches:
            for part in parted(batch, BYTES_AT_ONCE):
                for lang, source, text in zip(*(part.column(name).to_pylist() for name in ("lang", "source", "text")), strict=True):
                    n, docs = found.setdefault(lang, {}).setdefault(source, (Counter(), Counter()))
                    held -= len(n)
                    own = terms(text)
                    n.update(own)
                    docs.update(set(own))
                    held += len(n)
                    if held > HELD_TERMS:
                        yield from map(listed, found.items())
                        found, held = {}, 0
        yield from map(listed, found.items())
        found = {}
        give_back()

    def listed(found: tuple[str, dict[str, tuple[Counter, Counter]]]) -> pa.RecordBatch:
        lang, groups = found
        counts = [n for n, _ in groups.values()]
        sizes, at_end = [len(n) for n in counts], np.arange(len(groups))
        place = dict.fromkeys(chain.from_iterable(counts))
        place = dict(zip(place, range(len(place)), strict=True))
        at = np.fromiter(map(place.__getitem__, chain.from_iterable(counts)), np.int64, sum(sizes))
        n = np.fromiter(chain.from_iterable(n.values() for n in counts), np.int64, sum(sizes))
        docs = np.fromiter(chain.from_iterable(map(docs.__getitem__, n) for n, docs in groups.values()), np.int64, sum(sizes))
        # The rows of the groups come last.
        at, source = np.append(at, len(place) + at_end), np.append(np.repeat(at_end, sizes), at_end)
        order = np.argsort(at, kind="stable")
        offsets = pa.array(np.append(0, np.cumsum(np.bincount(at))).astype(np.int32))
        names = [*place, *((GROUP_MARK + source).encode() for source in groups)]
        lists = [np.append(values, np.zeros(len(groups), np.int64))[order] for values in (n, docs)]
        columns = {
            "lang": [lang] * len(names),
            "term": pa.array(names, pa.binary()),
            "sources": pa.ListArray.from_arrays(offsets, pa.array(list(groups), pa.string()).take(pa.array(source[order]))),
        }
        columns |= {name: pa.ListArray.from_arrays(offsets, values) for name, values in zip(("n", "docs"), lists, strict=True)}
        return to_batch(columns, arrow)

    return frame.mapInArrow(run, schema)


def term_counts(documents: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents that have the term; nulls are empty.

    Each group has a row with a null term besides, so that none is lost.
    """
    # Tasks give few rows of one term, so one task can take them all.
    parts = term_parts(documents).repartition("lang", "term").select("*", F.posexplode("n").alias("at", "n_own"))
    flat = parts.select("lang", F.col("sources")[F.col("at")].alias("source"), "term", "n_own", F.col("docs")[F.col("at")].alias("docs"))
    sums = flat.groupBy("lang", "source", "term").agg(F.sum("n_own").alias("n"), F.sum("docs").alias("docs"))
    return sums.withColumn("term", F.when(~F.col("term").startswith(GROUP_MARK), F.col("term")))


def probability(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(UNIT * (count + SMOOTHING) / (total + SMOOTHING * kept))`` in whole numbers."""
    wide = [name.cast("decimal(20,0)") for name in (count, total, kept)]
    scaled = (wide[0] + SMOOTHING).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = (wide[1] + wide[2] * SMOOTHING).cast("decimal(20,0)")
    # Remainders of decimals are exact, quotients are rounded.
    return (1 + ((scaled - scaled % below) / below).cast("decimal(20,0)")).cast("long")


class Counts:
    """Written tables of one audit: ``langs``, ``groups`` and ``entries``.

    ``langs`` has ``lang, kept, lang_total`` (kept terms and their occurrences), ``groups`` a row for each (lang,
    source) with ``total``, ``none`` (the price of level 0) and those of its language, ``entries`` one for each kept
    term of a group with ``n``, its price ``p`` and that in the language, ``q``.
    """

    def __init__(self, documents: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> None:
        counts = shared_table(term_counts(documents))
        sums = counts.where("term is not null").groupBy("lang", "term")
        kept = sums.agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_documents)
        kept = shared_table(kept.drop("docs"))
        # Of a term at most one row a source; the sums are written, so Spark can split a frequent one.
        entries = shared_table(counts.where("term is not null").drop("docs").join(kept, ["lang", "term"]))
        langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
        totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left")
        groups = groups.join(langs, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
        none = F.when(F.col("kept") > 0, probability(F.lit(0), F.col("total"), F.col("kept"))).otherwise(F.lit(0))
        self.groups = shared_table(groups.withColumn("none", none))
        priced = entries.join(self.groups.drop("none"), ["lang", "source"])
        self.entries = shared_table(
            priced.select(
                "lang",
                "source",
                "term",
                "n",
                probability(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
                probability(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
            )
        )
        for table in (counts, kept, entries):
            drop_table(table)


def joint_counts(levels: np.ndarray, group: np.ndarray, strip: int = STRIP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joint table of the columns of a one-hot matrix, given as the column that each (term, group) has.

    ``group`` is the group of each column. Returns the two columns, of a lower and a
    higher group, and the number of terms that have both, where there are any.
    """
    size = len(group)
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    # Terms that occur about as often come in one strip, which so has few columns.
    levels = levels[np.lexsort(levels.T)]
    found, numbers = [], []
    for begin in range(0, len(levels), strip):
        part = levels[begin : begin + strip]
        columns, place = np.unique(part, return_inverse=True)
        one_hot = np.zeros((len(part), len(columns)), np.float32)
        one_hot[np.arange(len(part))[:, None], place.reshape(part.shape)] = 1
        product = one_hot.T @ one_hot
        first, second = np.nonzero(product)
        ordered = group[columns[first]] < group[columns[second]]
        first, second = first[ordered], second[ordered]
        found.append(columns[first] * size + columns[second])
        numbers.append(product[first, second].astype(np.int64))
        if len(found) == 64 or begin + strip >= len(levels):
            keys, place = np.unique(np.concatenate([keys, *found]), return_inverse=True)
            # Whole numbers below 2**53, so sums in floating point are exact.
            counts = np.bincount(place, np.concatenate([counts, *numbers]), len(keys)).astype(np.int64)
            found, numbers = [], []
    return keys // max(size, 1), keys % max(size, 1), counts


def _cells(counts: Counts, cell_terms: int, cell_groups: int) -> DataFrame:
    """Rows of the cells ``lang, strip, low, high``: each group with a null term, and its entries."""
    sizes = counts.groups.groupBy("lang").agg(F.count("*").alias("sources"), F.first("kept").alias("kept"))
    sizes = sizes.select(
        "lang",
        F.ceil(F.col("sources") / cell_groups).alias("sides"),
        F.ceil(F.col("kept") / cell_terms).alias("strips"),
    ).where("strips > 0")
    groups = counts.groups.join(sizes, "lang").select(
        "lang",
        "source",
        F.lit(None).cast("string").alias("term"),
        F.lit(0).cast("long").alias("n"),
        F.col("none").alias("p"),
        "sides",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("strips") - 1)).alias("strip"),
    )
    entries = counts.entries.join(sizes, "lang").select(
        "lang", "source", "term", "n", "p", "sides", F.pmod(F.xxhash64("term"), "strips").alias("strip")
    )
    side = F.pmod(F.xxhash64("source"), "sides")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)).alias("other")
    both = groups.unionByName(entries).withColumn("side", side).select("*", other)
    return both.select(
        "lang", "strip", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"),
        "side", "source", "term", "n", "p",
    )


_JOINT = "lang string, a string, b string, n_a bigint, n_b bigint, p_a bigint, p_b bigint, terms bigint"


def joint_parts(counts: Counts, cell_terms: int = CELL_TERMS, cell_groups: int = CELL_GROUPS) -> DataFrame:
    """``lang, a, b, n_a, n_b, p_a, p_b, terms``: joint tables of all pairs of sources, part by part.

    ``terms`` kept terms, of those of the part, occur ``n_a`` times in ``a`` and
    ``n_b`` times in ``b``, at the prices ``p_a`` and ``p_b``; ``a`` is below ``b``.
    """

    def multiply(cell: pa.Table) -> pa.Table:
        lang, low, high = (cell.column(name)[0].as_py() for name in ("lang", "low", "high"))
        own = cell.select(["side", "source", "term", "n", "p"]).to_pandas()
        heads = own[own["term"].isna()].sort_values("source", key=lambda names: names.map(str.encode))
        sources, sides = heads["source"].tolist(), heads["side"].to_numpy()
        place = {source: at for at, source in enumerate(sources)}
        rest = own[own["term"].notna()]
        row, names = rest["term"].factorize()
        group, n = rest["source"].map(place).to_numpy(np.int64), rest["n"].to_numpy(np.int64)
        # Columns: level 0 of each group, then its other levels.
        pairs = np.stack([group, n], 1)
        columns, at = np.unique(pairs, axis=0, return_inverse=True) if len(pairs) else (pairs, np.empty(0, np.int64))
        at = at.reshape(-1)
        of_group = np.concatenate([np.arange(len(sources)), columns[:, 0]])
        level = np.concatenate([np.zeros(len(sources), np.int64), columns[:, 1]])
        price = np.zeros(len(level), np.int64)
        price[: len(sources)] = heads["p"].to_numpy(np.int64)
        price[len(sources) + at] = rest["p"].to_numpy(np.int64)
        levels = np.tile(np.arange(len(sources)), (len(names), 1))
        levels[row, group] = len(sources) + at
        first, second, terms_ = joint_counts(levels, of_group)
        # A cell of two sides answers for pairs across them; those of one side are in its own cell.
        mine = (sides[of_group[first]] != sides[of_group[second]]) | (low == high)
        first, second, terms_ = first[mine], second[mine], terms_[mine]
        names_ = np.array(sources, object)
        return pa.table(
            {
                "lang": [lang] * len(first),
                "a": pa.array(names_[of_group[first]], pa.string()),
                "b": pa.array(names_[of_group[second]], pa.string()),
                "n_a": level[first],
                "n_b": level[second],
                "p_a": price[first],
                "p_b": price[second],
                "terms": terms_,
            },
            pa.schema([(name, pa.string() if name in ("lang", "a", "b") else pa.int64()) for name in _NAMES]),
        )

    ship_package(counts.groups.sparkSession)
    cells = _cells(counts, cell_terms, cell_groups)
    return cells.groupBy("lang", "strip", "low", "high").applyInArrow(multiply, _JOINT)


_NAMES = [field.split()[0] for field in _JOINT.split(", ")]


def joint_tables(documents: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, a, b, n_a, n_b, terms``: the joint table of every pair of sources that have kept terms between them.

    ``a`` is below ``b``; terms that occur in neither are left out, as no cell knows of them.
    """
    parts = joint_parts(Counts(documents, least_documents)).where("n_a + n_b > 0")
    return parts.groupBy("lang", "a", "b", "n_a", "n_b").agg(F.sum("terms").alias("terms"))


def _pairs(counts: Counts) -> DataFrame:
    """``lang, source, item, value`` for each ordered pair of sources of a language."""
    # Prices are summed in the tasks that made the tables; a term that no source of a cell has costs what level 0 does.
    cost = F.abs(F.col("p_a") - F.col("p_b")).cast("decimal(38,0)") * F.col("terms")
    sums = joint_parts(counts).groupBy("lang", "a", "b").agg(F.sum(cost).alias("cost"), F.sum("terms").alias("met"))
    ends = F.array(*[F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in ("ab", "ba")])
    both = shared_table(sums.select("lang", "cost", "met", F.explode(ends).alias("end")).select("lang", "end.*", "cost", "met"))
    own = counts.groups.select("lang", "source", "kept", "none")
    others = counts.groups.select("lang", F.col("source").alias("item"), F.col("none").alias("item_none"))
    every = own.join(others, "lang").where("source <> item")
    rest = (F.col("kept") - F.coalesce("met", F.lit(0))) * F.abs(F.col("none") - F.col("item_none"))
    value = (F.coalesce("cost", F.lit(0)) + rest.cast("decimal(38,0)")).cast("long")
    return every.join(both, ["lang", "source", "item"], "left").select("lang", "source", "item", value.alias("value"))


def audit(documents: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every source within its language.

    Part ``pair`` has each other source and the summed difference of the
    probabilities of all kept terms, part ``term`` the ``top_terms`` terms by which the
    source exceeds its language most. Ranks go by value, ties by item in order of its
    UTF-8 bytes. Null text, language and source are empty ones, and a group; a
    language without kept terms has pairs of value 0 and no terms. Repeated rows count
    each. A long text is split as a whole. An empty table gives no row; other
    columns are not read. A value that does not fit into 64 bits is an error.
    """
    counts = Counts(documents, least_documents)
    above = counts.entries.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order).alias("rank")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank)

    found = ranked(_pairs(counts), "pair")
    return found.unionByName(ranked(above, "term").where(F.col("rank") <= top_terms))

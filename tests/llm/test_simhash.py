"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, fingerprint string, least int, mask int"
LONG = " ".join(f"Word{n % 613}" for n in range(100_000))


def slow_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    runs = [" ".join(words[at : at + 3]) for at in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """Least id that each (id, fingerprint) reaches."""
    prints = sorted({own for _, own in rows})
    group = {own: own for own in prints}

    def root(own):
        while group[own] != own:
            own = group[own]
        return own

    for place, one in enumerate(prints):
        for other in prints[place + 1 :]:
            if bin(one ^ other).count("1") <= 2:
                group[root(one)] = root(other)
    least = {}
    for doc, own in rows:
        if doc is not None:
            least[root(own)] = min(least.get(root(own), doc), doc)
    return {own: least.get(root(own)) for own in prints}


def checked(spark, texts):
    """Rows of the operator for (id, text), after a comparison with brute force."""
    rows = [(doc, text, "clash", 1, 2) for doc, text in texts]
    found = simhash.near_fingerprints(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert found.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    prints = [(doc, slow_fingerprint(text)) for doc, text in texts]
    component = slow_components(prints)
    expected = [(doc, f"{own:016x}", component[own]) for doc, own in prints]
    got = [tuple(row) for row in found.collect()]
    order = lambda row: tuple((value is None, value) for value in row)
    assert sorted(got, key=order) == sorted(expected, key=order)
    return got


def test_fingerprints_and_components(spark):
    draw = random.Random(1)
    base = [f"w{draw.randrange(300)}" for _ in range(400)]
    near = [" ".join([*base[:at], "changed", *base[at + 1 :]]) for at in range(0, 400, 9)]
    texts = [None, "", " \t\n ", "one", "One", "one two", "ONE two\tthree", "×÷ naïve “quoted” 東京 tower\x00end nbsp", LONG]
    texts += [" ".join(base), "  ".join(base).upper(), *near, *near[:3]]
    texts += [" ".join(f"x{draw.randrange(50)}" for _ in range(draw.randrange(2, 40))) for _ in range(100)]
    found = checked(spark, list(enumerate(texts)))
    assert len({row[2] for row in found}) < len({row[1] for row in found})


def test_repeated_rows_and_null_ids(spark):
    texts = [(5, "a b c d"), (5, "a b c d"), (5, "other words here"), (None, "a b c d"), (None, "alone it is"), (7, None), (3, " ")]
    found = checked(spark, texts)
    assert (None, f"{slow_fingerprint('a b c d'):016x}", 5) in found
    assert (None, f"{slow_fingerprint('alone it is'):016x}", None) in found
    assert (7, "0" * 16, 3) in found


def test_empty_table(spark):
    assert simhash.near_fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []


def linked_groups(spark, prints, leaf):
    """Groups that the found links make of some fingerprints."""
    distinct = spark.createDataFrame([(int(own),) for own in prints.view(np.int64)], "fingerprint bigint")
    group = {int(own): int(own) for own in prints.view(np.int64)}

    def root(own):
        while group[own] != own:
            own = group[own]
        return own

    rows = simhash.near_links(distinct, leaf).collect()
    for one, other in rows:
        assert bin((one ^ other) & (1 << 64) - 1).count("1") <= 2 or root(one) == root(other) or leaf
        group[root(one)] = root(other)
    return {own: root(own) for own in group}


@pytest.mark.parametrize("leaf", [4, 2048])
def test_large_buckets_are_cut_and_lose_no_link(spark, leaf):
    """Fingerprints around one, so that nearly all share their buckets, at every level of cutting."""
    draw = np.random.default_rng(2)
    center = draw.integers(0, 1 << 64, dtype=np.uint64)
    flips = [center]
    for _ in range(300):
        bits = draw.choice(64, draw.integers(1, 6), replace=False)
        flips.append(center ^ np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64)))
    prints = np.unique(np.concatenate([np.array(flips, np.uint64), draw.integers(0, 1 << 64, 200, dtype=np.uint64)]))
    found = linked_groups(spark, prints, leaf)
    slow = slow_components([(int(own), int(own)) for own in prints])
    one = sorted(sorted(int(np.uint64(x & (1 << 64) - 1)) for x in found if found[x] == at) for at in set(found.values()))
    other = sorted(sorted(x for x in slow if slow[x] == at) for at in set(slow.values()))
    assert one == other


def test_the_table_discards_pairs(spark):
    prints = np.random.default_rng(3).integers(0, 1 << 64, 500, dtype=np.uint64)
    table = simhash.distance_table(prints, simhash.reference_fingerprints()).astype(int)
    apart = np.abs(table[:, None] - table[None]).max(2)
    bits = np.bitwise_count(prints[:, None] ^ prints[None])
    assert (apart <= bits).all()
    assert (apart[~np.eye(500, dtype=bool)] > simhash.BITS).all()


def test_few_links_connect_a_bucket():
    prints = np.array([1 << bit for bit in range(60)], np.uint64)
    table = simhash.distance_table(prints, simhash.reference_fingerprints())
    one, other = simhash.linked_places(np.zeros(60, np.int64), prints, table)
    assert len(one) == 59
    assert set(one.tolist()) == {0}


def test_finer_masks_add_two_parts():
    masks = simhash.finer(0)
    assert len(set(masks)) == 6
    assert {bin(mask).count("1") for mask in masks} == {32}
    assert {bin(mask).count("1") for mask in simhash.finer(masks[0])} == {48}


def test_links_need_no_python_rows_of_other_columns(spark):
    rows = spark.createDataFrame([(1, "a b c", "x", 1, 1)], SCHEMA)
    plan = simhash.fingerprints_of(rows.withColumn("extra", F.lit("y")))
    assert plan.columns == ["doc_id", "fingerprint"]

"""Divergence audit against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "text string, lang string, source string, doc_id bigint, term string, n int, strip int, p int"
LONG = " ".join(f"term{chr(97 + n % 26)}" for n in range(200_000))


def slow(rows, least, top):
    """The same audit with Python numbers."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups[lang].add(source)
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    result = []
    for lang, sources in groups.items():
        kept = [term for term, n in docs[lang].items() if n >= least]

        def prices(count, kept=kept):
            total = sum(count[term] for term in kept)
            return {term: 1 + 1_000_000_000 * (count[term] + 5) // (total + 5 * len(kept)) for term in kept}

        own = {source: prices(counts[lang, source]) for source in sources}
        whole = prices(sum((counts[lang, source] for source in sources), Counter()))
        for source, p in own.items():
            pairs = [(-sum(abs(p[t] - q[t]) for t in kept), other) for other, q in own.items() if other != source]
            above = [(whole[t] - p[t], t) for t in kept if counts[lang, source][t] and p[t] > whole[t]]
            for part, found in (("pair", pairs), ("term", above)):
                found.sort(key=lambda row: (row[0], row[1].encode()))
                result += [
                    (lang, source, part, item, -value, rank)
                    for rank, (value, item) in enumerate(found, 1)
                    if part == "pair" or rank <= top
                ]
    return sorted(result)


def frame(spark, rows):
    return spark.createDataFrame([(*row, n, "clash", 1, 2, 3) for n, row in enumerate(rows)], SCHEMA).repartition(3)


def checked(spark, rows, least=3, top=50):
    found = sorted(tuple(row) for row in divergence.audit(frame(spark, rows), least, top).collect())
    assert found == slow(rows, least, top)
    return found


def corpus(seed, size, sources, words=200):
    draw = random.Random(seed)
    found = []
    for _ in range(size):
        source = draw.randrange(sources)
        text = " ".join(f"{chr(97 + int(draw.random() ** 2 * 26))}{chr(97 + draw.randrange(words) % 26)}" for _ in range(30))
        found.append((text, draw.choice(["en", "de"]), f"s{source}"))
    return found


def test_audit(spark):
    rows = corpus(1, 300, 6)
    # A third of the rows are of one source; nulls are groups of their own.
    rows += [(text, "en", "s0") for text, _, _ in corpus(2, 150, 1)]
    rows += [("naïve Straße ÄÖ 東京 x1y2_z", "en", None)] * 4 + [(None, None, "s1"), ("", "fr", "lonely"), (LONG, "de", "s1")]
    checked(spark, rows)


def test_more_sources_than_a_side_and_more_terms_than_a_cell(spark, monkeypatch):
    monkeypatch.setattr(divergence.joint_parts, "__defaults__", (40, 4))
    checked(spark, corpus(3, 400, 23), 2, 7)


def test_ties_repeated_rows_and_nothing_kept(spark):
    rows = [("same words here", "en", source) for source in ("b", "a", "Z", "é", "~") for _ in range(3)]
    found = checked(spark, rows)
    assert [row[3] for row in found if row[:3] == ("en", "b", "pair")] == ["Z", "a", "~", "é"]
    assert {row[4] for row in checked(spark, rows, 100)} == {0}
    checked(spark, [("solo", "en", "only")] * 4)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_counts_are_handed_on_before_they_are_many(spark, monkeypatch):
    rows = corpus(4, 50, 2)
    whole = {tuple(row) for row in divergence.term_counts(frame(spark, rows)).collect()}
    monkeypatch.setattr(divergence, "HELD_TERMS", 5)
    assert {tuple(row) for row in divergence.term_counts(frame(spark, rows)).collect()} == whole


def test_a_term_leaves_a_task_once_whatever_the_batches_and_sources(spark):
    rows = corpus(6, 200, 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        parts = divergence.term_parts(frame(spark, rows).coalesce(1)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = [(row["lang"], row["term"]) for row in parts]
    assert len(found) == len(set(found))
    groups = {(lang, divergence.GROUP_MARK + source) for _, lang, source in rows}
    assert set(found) == {(lang, term) for text, lang, _ in rows for term in text.split()} | groups


def test_sources_of_any_name_are_groups_of_their_own(spark):
    """Among them names with a space before, and such as are terms."""
    rows = [("some words", lang, source) for lang in (None, "de") for source in (" s", "s", "", " ", None, "some", "é\n")]
    found = divergence.term_counts(frame(spark, [*rows, (None, "fr", " s")])).collect()
    groups = [tuple(row[:2]) for row in found if row["term"] is None]
    assert sorted(groups) == sorted({(lang or "", source or "") for _, lang, source in rows} | {("fr", " s")})
    assert {(row["n"], row["docs"]) for row in found if row["term"] is None} == {(0, 0)}
    assert sum(row["n"] for row in found) == 2 * len(rows)
    checked(spark, rows)


def test_joint_tables(spark):
    rows = corpus(5, 120, 4)
    found = {tuple(row[:5]): row[5] for row in divergence.joint_tables(frame(spark, rows), 2).collect()}
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        counts[lang, source].update(text.split())
        docs[lang].update(set(text.split()))
    expected = Counter()
    for lang, own in docs.items():
        sources = sorted(source for one, source in counts if one == lang)
        for term in (term for term, n in own.items() if n >= 2):
            for place, a in enumerate(sources):
                for b in sources[place + 1 :]:
                    levels = counts[lang, a][term], counts[lang, b][term]
                    if sum(levels):
                        expected[lang, a, b, *levels] += 1
    assert found == expected


def test_joint_counts_of_a_one_hot_product():
    draw = np.random.default_rng(1)
    group = np.repeat(np.arange(5), 4)
    levels = np.arange(5) * 4 + draw.integers(0, 4, (333, 5))
    first, second, terms = divergence.joint_counts(levels, group, 10)
    one_hot = np.zeros((333, 20), np.int64)
    one_hot[np.arange(333)[:, None], levels] = 1
    whole = one_hot.T @ one_hot
    assert (group[first] < group[second]).all()
    assert terms.sum() == 333 * 10
    assert (whole[first, second] == terms).all()


@pytest.mark.parametrize(("count", "total", "kept"), [(0, 0, 1), (3, 7, 2), (9 * 10**14, 10**15, 10**7), (10**15, 10**15, 1)])
def test_probabilities_are_whole_numbers(spark, count, total, kept):
    columns = [F.lit(value).cast("long") for value in (count, total, kept)]
    found = spark.range(1).select(divergence.probability(*columns)).first()[0]
    assert found == 1 + 1_000_000_000 * (count + 5) // (total + 5 * kept)

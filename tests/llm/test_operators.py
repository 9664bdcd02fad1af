"""Operators for training data on small tables, against brute force where there is one."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import (
    components,
    counting,
    jaccard,
    language,
    mixing,
    packing,
    pages,
    quality,
    shards,
    substrings,
    tokens,
    topk,
    words,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _text string, size int"
LONG = " ".join(f"w{n % 997}" for n in range(30_000))


def passage(seed, size, vocabulary=400):
    draw = random.Random(seed)
    return [f"{draw.choice('abcdefgh')}{draw.randrange(vocabulary)}" for _ in range(size)]


def texts():
    """Copies, near copies, shared passages, short, empty and null texts."""
    base = passage(1, 120)
    near = [*base[:50], "changed", *base[51:]]
    far = [word if place % 4 else f"x{place}" for place, word in enumerate(base)]
    shared = passage(2, 60)
    return [
        None,
        "",
        " \t\n ",
        "one two",
        "One Two",
        "one two three four five",
        " ".join(base),
        " ".join(base),
        "  ".join(base).upper(),
        " ".join(near),
        " ".join(far),
        " ".join(passage(3, 80) + shared + passage(4, 80)),
        "\n".join(passage(5, 40) + shared),
        " ".join(shared[:40] + passage(6, 5) + shared[20:]),
        " ".join(["again"] * 90),
        "×÷ naïve “quoted” 東京 tower\x00end  nbsp",
        LONG,
    ]


@pytest.fixture(scope="module")
def rows():
    found = [
        (place, text, "en" if place % 3 else None, f"s{place % 4}" if place % 5 else None, 0, "clash", 1)
        for place, text in enumerate(texts())
    ]
    return found


@pytest.fixture(scope="module")
def documents(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="module")
def repeated(spark, rows):
    """Rows twice, an id with two texts, and a null id."""
    more = [(6, "another text of the same id", "en", "s1", 0, "", 1), (None, " ".join(passage(1, 120)), "en", "s1", 0, "", 1)]
    return spark.createDataFrame([*rows, *rows[5:9], *more], DOCUMENTS)


def by_id(frame):
    return {row["doc_id"]: row for row in frame.collect()}


# --- quality rules -----------------------------------------------------------


def test_quality_counts_are_those_of_the_definition(documents, rows):
    labels = documents.sparkSession.createDataFrame([(n, n % 2) for n in range(17)], "doc_id bigint, quality int")
    found = by_id(quality.quality_rules(documents, labels))
    for doc_id, text, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        count = Counter(windows)
        twice = {i + k for i, window in enumerate(windows) if count[window] > 1 for k in range(8)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        row = found[doc_id]
        assert row["n_words"] == len(words)
        assert row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == len(twice)
        assert row["base_failed"] == (len(words) < 20 or 100 * len(twice) > 30 * len(words))
        assert not (row["base_failed"] and row["kept"])


def test_quality_without_labels_or_rows(documents, empty):
    labels = documents.sparkSession.createDataFrame([], "doc_id bigint, quality int")
    found = quality.quality_rules(documents, labels).collect()
    assert len(found) == 17 and all(row["kept"] != row["base_failed"] for row in found)
    assert quality.quality_rules(empty, labels).count() == 0


def test_trees_keep_their_constraints_and_learn():
    draw = np.random.default_rng(0)
    rows = draw.random((2000, len(quality.FEATURES)))
    labels = ((rows[:, 0] < 0.3) | (rows[:, 6] > 0.9)).astype(float)
    trees = quality.grow(rows, labels, list(quality.FEATURES.values()))
    assert ((trees.score(rows) > 0.5) == labels).mean() > 0.95
    for place, sign in enumerate(quality.FEATURES.values()):
        if sign:
            line = np.repeat(rows[:40, None], 30, 1)
            line[:, :, place] = np.linspace(0, 1, 30)
            score = trees.score(line.reshape(-1, rows.shape[1])).reshape(40, 30)
            assert (np.diff(score, axis=1) * sign >= -1e-12).all()


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    seen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    judged = quality.judge(documents, quality.fit(documents, labels.where(seen)))
    right = judged.where("not base_failed").join(labels.where(~seen), "doc_id").agg(
        F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))
    )
    assert right.first()[0] > 0.97


@pytest.fixture
def uncoalesced(spark):
    """Small partitions stay apart, as large ones do."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


# --- language ----------------------------------------------------------------


def naive_phrases(text, known):
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in known:
            size += 1
        if text[at] not in known:
            size = 1
        at += size
        count += 1
    return count


def test_phrases_are_longest_matches():
    samples = {"a": " the cat sat on the mat ", "b": " le chat est sur le tapis "}
    model = language.Model(samples)
    asked = [" the chat ", " xyz ", " sat on le tapis the mat ", "q"]
    found = model.phrases([model.codes(text) for text in asked])
    for text, row in zip(asked, found, strict=True):
        assert row.tolist() == [naive_phrases(text, samples[name]) for name in ("a", "b")]


@pytest.mark.parametrize("segment", [1, 2, 7, 50, language.SEGMENT])
def test_segments_change_no_count(monkeypatch, segment):
    monkeypatch.setattr(language, "SEGMENT", segment)
    draw = random.Random(segment)
    for _ in range(20):
        samples = {name: "".join(draw.choices("abcd", k=draw.randrange(1, 200))) for name in "xyz"}
        model = language.Model(samples)
        asked = ["".join(draw.choices("abcdq", k=draw.randrange(1, 300))) for _ in range(6)]
        found = model.phrases([model.codes(text) for text in asked])
        assert found.tolist() == [[naive_phrases(text, samples[name]) for name in "xyz"] for text in asked]


def test_long_texts_are_parsed_whole():
    sample = " the cat sat on the mat and ate the rat "
    draw = random.Random(0)
    model = language.Model({"a": sample, "b": " abcab "})
    periodic = "ab" * 10_000  # phrases never meet those of a segment parsed from its start
    mixed = "".join(draw.choice(["the cat ", "on the ", "q", "mat and a", "rat "]) for _ in range(4000))
    for text in (periodic, mixed):
        assert len(text) >= 20_000 - 2000
        found = model.phrases([model.codes(text)])[0].tolist()
        assert found == [naive_phrases(text, sample), naive_phrases(text, " abcab ")]


def test_models_of_large_alphabets_are_small():
    draw = random.Random(3)
    chars = [chr(0x4E00 + place) for place in range(3000)]
    weights = [1 / (place + 1) for place in range(3000)]
    samples = {f"l{n:02d}": "".join(draw.choices(chars, weights, k=10_000)) for n in range(12)}
    model = language.Model(samples)
    assert model.nbytes < 40 << 20
    text = samples["l03"][500:520] + "x" + samples["l07"][:30]
    found = model.phrases([model.codes(text)])[0].tolist()
    assert found == [naive_phrases(text, samples[name]) for name in model.languages]


def test_prediction_and_score_match_brute_force(spark):
    rows = [
        (n, text, lang)
        for n, (text, lang) in enumerate(
            [("the cat sat on the mat", "en"), ("le chat est sur le tapis", "fr"), ("die katze auf der matte", "de")] * 4
            + [("the chat", None), ("Der TAPIS, der 12!", "fr"), ("12 --", "en"), (None, "de"), ("zzz qqq", None)]
        )
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    samples: dict[str, str] = {}
    labelled = frame.where("text is not null and lang is not null").where(language.fold(F.col("doc_id")) != 0)
    order = labelled.withColumn("draw", F.xxhash64("doc_id")).orderBy("draw", "doc_id")
    for row in order.collect():
        samples[row["lang"]] = samples.get(row["lang"], "") + language.letters_only(row["text"])
    found = by_id(language.identify_languages(frame))
    for doc_id, text, _ in rows:
        letters = language.letters_only(text or "")
        if not letters:
            assert (found[doc_id]["lang_pred"], found[doc_id]["score"]) == ("und", 0)
            continue
        entropy = sorted(
            (naive_phrases(letters, known) * math.log2(len(known)) / len(letters), name) for name, known in samples.items()
        )
        assert found[doc_id]["lang_pred"] == entropy[0][1]
        assert found[doc_id]["score"] == pytest.approx(1 - entropy[0][0] / entropy[1][0])


def test_language_of_held_out_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify_languages(documents)
    joined = found.where("held_out").join(documents.select("doc_id", "lang"), "doc_id")
    right, least, most = joined.agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")
    ).first()
    assert right > 0.98 and least >= 0 and most <= 1


def test_language_of_odd_rows(documents, empty, repeated):
    found = by_id(language.identify_languages(documents))
    assert len(found) == 17
    assert [found[n]["lang_pred"] for n in (0, 1, 2)] == ["und"] * 3
    assert all(found[n]["score"] == 0 for n in (0, 1, 2))
    assert found[6]["lang_pred"] == "en"
    assert found[0]["held_out"] == (zlib.crc32(b"0") % 5 == 0)
    assert language.identify_languages(empty).count() == 0
    assert language.identify_languages(repeated).count() == 23
    kept = language.in_known_language(documents)
    assert kept.columns == documents.columns
    assert {row["doc_id"] for row in kept.collect()} >= set(range(3, 14))


def test_nothing_learned_is_undetermined(documents):
    found = language.identify_languages(documents.withColumn("lang", F.lit(None).cast("string")))
    assert {row["lang_pred"] for row in found.collect()} == {"und"}


# --- tokens, shards, packing -------------------------------------------------


def whole_ids(text):
    tokenizer = tokens.encoder()._tokenizer
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    [
        "it's a 'test' I'LL we've 'S don't'll'd 5'M'",
        "<|endoftext|>hi <|startoftext|> <|other|>",
        "ÀÖØöø ĀſıĲ ŉ ×÷ É'S é'll ß µ ª º ¼ Ǆ İSTANBUL ΣΑΣ",
        "a\x00b \x1cq é ́x \x7f x\x85y 日本語 😀😀 it’s",
    ],
)
def test_word_by_word_ids_are_those_of_the_whole_text(text):
    assert tokens.wide(tokens.encoder().ids(text.encode())).tolist() == whole_ids(text)


def test_word_by_word_ids_of_the_documents(spark):
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert tokens.wide(tokens.encoder().ids(row["text"].encode())).tolist() == whole_ids(row["text"])


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_shards_round_trip(spark, documents, rows):
    folder = shards.new_folder(spark)
    found = by_id(shards.write_and_read(documents, folder))
    start = 0
    for doc_id, text, *_ in rows:
        ids = [*whole_ids(text), shards.END_ID]
        row = found[doc_id]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    asked = spark.createDataFrame([(6,), (999,), (None,)], "doc_id bigint")
    (row,) = shards.read_ids(shards.locate(asked, folder, 1), folder).collect()
    assert row["doc_id"] == 6
    assert tokens.wide(row["ids"]).tolist() == [*whole_ids(rows[6][1]), shards.END_ID]


def test_shards_of_repeated_and_no_rows(spark, repeated, empty):
    found = shards.write_and_read(repeated, shards.new_folder(spark)).collect()
    assert len(found) == 23
    starts = sorted((row["start"], row["n_tokens"]) for row in found)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    assert shards.write_and_read(empty, shards.new_folder(spark)).count() == 0


def test_many_rows_of_one_id_are_many_shards(spark, uncoalesced):
    rows = [(None, "none")] * 4000 + [(5, "same words")] * 4000 + [(n, f"text {n}") for n in range(20)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    folder = shards.new_folder(spark)
    written = shards.shared_table(shards.write_shards(frame, folder))
    assert written.groupBy("shard").count().agg(F.max("count")).first()[0] < 3000
    assert written.where("doc_id = 5 and copy = 0").count() > 1
    keyed = shards.marked(written).where("indexed")
    assert sorted(row["doc_id"] for row in keyed.collect()) == list(range(20))
    found = shards.write_and_read(frame, shards.new_folder(spark)).orderBy("start").collect()
    start, ids = 0, []
    for row in found:
        text = {None: "none", 5: None}.get(row["doc_id"], f"text {row['doc_id']}")
        expected = {crc([*whole_ids(t), shards.END_ID]) for t in ([text] if text else ["same words", "text 5"])}
        assert row["start"] == start and row["ids_crc32"] in expected
        start += row["n_tokens"]
        ids.append(-1 if row["doc_id"] is None else row["doc_id"])
    assert len(ids) == len(rows) and ids == sorted(ids)


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(0).choice(1 << 40, 5000, replace=False)
    found = shards.PerfectHash.over(keys)
    assert sorted(found.slots(keys).tolist()) == list(range(5000))
    with pytest.raises(ValueError, match="not distinct"):
        shards.PerfectHash.over(np.array([7, 7]))


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [gap for gap in gaps if gap >= length]
        gap = min(fitting) if fitting else capacity
        if fitting:
            gaps.remove(gap)
        gaps.append(gap - length)
    return len(gaps)


def test_rounds_use_as_many_sequences_as_best_fit_decreasing():
    draw = random.Random(0)
    for _ in range(200):
        lengths = [draw.randrange(1, 41) for _ in range(draw.randrange(1, 120))]
        places = packing.best_fit_rounds(Counter(lengths), 40)
        used = Counter()
        for length, count in sorted(Counter(lengths).items(), reverse=True):
            own = sorted(place for place in places if place[0] == length)
            for (_, rank, first, offset), stop in zip(own, [p[1] for p in own[1:]] + [count], strict=True):
                for sequence in range(first, first + stop - rank):
                    assert used[sequence] == offset
                    used[sequence] += length
        assert max(used.values()) <= 40 and sum(used.values()) == sum(lengths)
        assert len(used) == best_fit_decreasing(lengths, 40)


def test_packing(documents, rows, repeated, empty):
    found = packing.pack_documents(documents, capacity=64).collect()
    by_sequence = {}
    for row in found:
        by_sequence.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    for doc_id, text, *_ in rows:
        ids = [*whole_ids(text), packing.END_ID]
        own = sorted((row for row in found if row["doc_id"] == doc_id), key=lambda row: row["piece"])
        assert [row["start"] for row in own] == list(range(0, len(ids), 64))
        assert [row["ids_crc32"] for row in own] == [crc(ids[at : at + 64]) for at in range(0, len(ids), 64)]
    assert packing.pack_documents(repeated).select("sequence_id", "offset").distinct().count() == len(
        packing.pack_documents(repeated).collect()
    )
    assert packing.pack_documents(empty).count() == 0


# --- substring dedup ---------------------------------------------------------


def brute_kept(texts_):
    words = [WORD.findall(text or "") for text in texts_]
    count = Counter(tuple(own[i : i + 35]) for own in words for i in range(len(own) - 34))
    kept = []
    for own in words:
        gone = {i + k for i in range(len(own) - 34) if count[tuple(own[i : i + 35])] > 1 for k in range(35)}
        kept.append(" ".join(word for place, word in enumerate(own) if place not in gone))
    return kept


def test_substring_dedup_matches_brute_force(documents, rows):
    found = by_id(substrings.dedup_substrings(documents))
    for (doc_id, text, *_), kept in zip(rows, brute_kept(texts()), strict=True):
        assert found[doc_id]["text"] == kept
        assert found[doc_id]["n_words"] == len(WORD.findall(text or ""))
        assert found[doc_id]["n_words"] - found[doc_id]["n_removed"] == len(kept.split())


def test_substring_dedup_of_spliced_passages(spark):
    draw = random.Random(4)
    passages = [passage(n, 70, 50) for n in range(6)]
    made = []
    for _ in range(60):
        words = []
        for _ in range(draw.randrange(1, 5)):
            own = draw.choice(passages)
            begin = draw.randrange(40)
            words += own[begin : begin + draw.randrange(10, 70)] + passage(draw.random(), draw.randrange(4))
        made.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string")
    found = by_id(substrings.dedup_substrings(frame))
    assert [found[n]["text"] for n in range(60)] == brute_kept(made)


def test_substring_dedup_of_repeated_and_no_rows(repeated, empty):
    pairs = [(row["doc_id"], row["text"]) for row in repeated.select("doc_id", "text").collect()]
    wanted = sorted((str(doc_id), kept) for (doc_id, _), kept in zip(pairs, brute_kept([t for _, t in pairs]), strict=True))
    found = sorted((str(row["doc_id"]), row["text"]) for row in substrings.dedup_substrings(repeated).collect())
    assert found == wanted
    assert substrings.dedup_substrings(empty).count() == 0
    result = substrings.without_repeats(repeated)
    assert result.columns == repeated.columns and result.count() == 23


# --- mixing ------------------------------------------------------------------


def water_fill(sizes, weights, most):
    left, open_ = sum(sizes), set(range(len(sizes)))
    target = [0.0] * len(sizes)
    while open_:
        rate = left / sum(weights[n] for n in open_)
        full = {n for n in open_ if rate * weights[n] > most * sizes[n]}
        if not full:
            for n in open_:
                target[n] = rate * weights[n]
            break
        for n in full:
            target[n] = most * sizes[n]
            left -= target[n]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [[10, 20, 30, 40], [1, 1000, 5, 5, 700, 2], [0, 10, 0], [0, 0], [100], [3, 3, 3, 900]])
def test_targets_fill_up(spark, sizes):
    names = [f"s{n}" for n in range(len(sizes) - 1)] + [None]
    frame = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size bigint")
    found = {row["source"]: row["target"] for row in mixing.source_targets(frame).collect()}
    weights = [mixing.WEIGHTS[n % 3] for n in range(len(sizes))]
    assert [found[name] for name in names] == pytest.approx(water_fill(sizes, weights, 3.0))


def test_mix_meets_its_targets(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = mixing.mix(documents).cache()
    sums = found.groupBy("source", "source_size", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("most"))
    for row in sums.collect():
        assert abs(row["taken"] - row["target"]) <= row["most"] / 2 + 1e-6
    epochs = F.floor(F.col("target") / F.col("source_size")) * F.col("size")
    assert found.where((F.col("taken") < epochs) | (F.col("taken") > 3 * F.col("size"))).count() == 0
    again = mixing.mix(documents.repartition(5))
    assert found.select("doc_id", "taken").exceptAll(again.select("doc_id", "taken")).count() == 0


def test_better_documents_are_taken_more_often(spark):
    rows = [(n, ("word " if n % 2 else "#1#! ") * 10, "s0") for n in range(4000)]
    rows += [(n, "big " * 10, "s1") for n in range(4000, 4400)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = mixing.mix(documents, weights=(1.0, 9.0)).where("source = 's0'")
    good, bad = (found.where(f"doc_id % 2 = {odd}").agg(F.sum("taken")).first()[0] for odd in (1, 0))
    assert good > 1.1 * bad


def test_many_equal_rows_of_the_mix_are_many_ranges(spark, uncoalesced):
    frame = spark.createDataFrame([(1, "a b c", "s")] * 4000, "doc_id bigint, text string, source string")
    keyed = mixing.sized(frame.repartition(8)).withColumn("key", F.lit(0.5))
    summed = mixing.sorted_sums(keyed)
    assert summed.groupBy("part").count().agg(F.max("count")).first()[0] < 2000
    found = mixing.mix(frame.repartition(8)).collect()
    assert len(found) == 4000 and sum(row["taken"] for row in found) == 12_000


def test_mix_of_odd_rows(documents, repeated, empty):
    found = by_id(mixing.mix(documents))
    assert len(found) == 17
    assert all(found[n]["taken"] == 0 for n in (0, 1, 2))
    assert mixing.mix(empty).count() == 0
    taken = {}
    for row in mixing.mix(repeated).collect():
        taken[row["draw"]] = taken.get(row["draw"], 0) + (row["taken"] // row["size"] if row["size"] else 0)
    result = mixing.repeated(repeated)
    assert result.columns == repeated.columns
    got = result.groupBy(mixing.document_draw().alias("draw")).count().collect()
    assert {row["draw"]: row["count"] for row in got} == {draw: n for draw, n in taken.items() if n}


# --- n-gram Jaccard join -----------------------------------------------------


def brute_components(texts_):
    upper = {n: n + 32 for n in range(65, 91)}
    sets = []
    for text in texts_:
        words = WORD.findall((text or "").translate(upper))
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if own == high else own for own in root]
    return [(len(own), root[n]) for n, own in enumerate(sets)]


def test_near_duplicates_match_brute_force(documents):
    found = by_id(jaccard.near_duplicates(documents))
    assert [(found[n]["n_shingles"], found[n]["component_id"]) for n in range(17)] == brute_components(texts())


def test_near_duplicates_in_a_large_group(spark):
    draw = random.Random(7)
    base = passage(9, 90)
    made = []
    for _ in range(250):
        own = list(base)
        for _ in range(draw.choice([0, 1, 2, 3, 4, 6, 9])):
            own[draw.randrange(len(own))] = f"y{draw.randrange(99)}"
        made.append(" ".join(own[draw.randrange(4) :]))
    frame = spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string")
    found = by_id(jaccard.near_duplicates(frame))
    assert [(found[n]["n_shingles"], found[n]["component_id"]) for n in range(250)] == brute_components(made)


def test_costly_prefixes_are_longer_and_find_the_same(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard, "COSTLY", 1)
    monkeypatch.setattr(jaccard, "STANDS_OUT", 0)
    found = by_id(jaccard.near_duplicates(documents))
    assert [found[n]["component_id"] for n in range(17)] == [root for _, root in brute_components(texts())]
    own = jaccard.shingles(" ".join(passage(1, 120)).encode())
    counts = np.full(8, 100, np.int32)
    longer, matches = jaccard.prefix(own, counts)
    assert matches == jaccard.MOST_MATCHES and len(longer) == len(own) - jaccard.least_overlap(len(own)) + matches


def test_near_duplicates_of_repeated_and_no_rows(repeated, empty):
    assert jaccard.near_duplicates(repeated).count() == 23
    assert jaccard.near_duplicates(empty).count() == 0
    kept = jaccard.one_of_each(repeated)
    assert kept.columns == repeated.columns


def test_one_of_each_decides_by_row(spark):
    a, b, c, d = (" ".join(passage(seed, 60)) for seed in (31, 32, 33, 34))
    near = " ".join([*passage(31, 60)[:-1], "end"])
    rows = [(1, a, 0)] * 3 + [(None, a, 1)] * 2 + [(None, near, 2), (5, a, 3)]  # of all these, one row of 1
    rows += [(7, near, 4), (7, b, 5), (7, b, 6), (7, c, 7)]  # of one id, a copy and two of their own
    rows += [(None, d, 8)] * 3 + [(None, " ".join([*passage(34, 60)[:-1], "end"]), 9)]  # one of them
    rows += [(None, None, 10), (None, None, 10), (3, "", 11), (3, "", 11)]  # without words: all
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n int").repartition(5)
    kept = sorted(map(tuple, jaccard.one_of_each(frame).collect()), key=str)
    assert len(kept) == 8
    assert (1, a, 0) in kept and (7, c, 7) in kept
    assert [row[:2] for row in kept].count((7, b)) == 1
    assert sum(row[2] in (8, 9) for row in kept) == 1
    assert sum(row[2] in (10, 11) for row in kept) == 4


def test_few_and_short_labelled_documents_reject_no_clean_text(spark):
    labelled = [(2, "the old man went to the sea", "en"), (3, "der alte Mann ging an das Meer", "de")]
    clean = [(20, "a long night in town", None), (21, "ein Haus an dem Bach", None)]
    frame = spark.createDataFrame([*labelled, *clean, (22, "Привет мир", None)], "doc_id bigint, text string, lang string")
    model = language.learn(frame.dropna())
    phrases = by_id(language.judged(frame, model, ["doc_id"]))
    assert min(phrases[n]["_language_phrase"] for n in (20, 21)) < language.LEAST_PHRASE
    found = language.in_known_language(frame, folds=1 << 30)
    assert {row["doc_id"] for row in found.collect()} == {2, 3, 20, 21}


def test_spans_of_equal_rows_are_listed_once(spark):
    text = " ".join(passage(71, 80))
    frame = spark.createDataFrame([(None, text)] * 30, "doc_id bigint, text string").repartition(4)
    (row,) = substrings.repeated_spans(frame).collect()
    assert len(row["spans"]) == len(set(row["spans"])) > 0
    assert all(row["n_removed"] == 80 for row in substrings.dedup_substrings(frame).collect())


def test_equal_rows_of_the_mix_are_ranked_by_partition(spark):
    rows = [(None, "one and the same", "s0")] * 40 + [(n, f"text number {n}", "s1") for n in range(9)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6)
    result = mixing.repeated(frame)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert all("_mix_part" in line for line in plan.splitlines() if "Window" in line)
    taken = mixing.mix(frame).groupBy("doc_id").agg(F.sum(F.col("taken") / F.col("size")).alias("n")).where("n > 0")
    wanted = {row["doc_id"]: int(row["n"]) for row in taken.collect()}
    assert {row["doc_id"]: row["count"] for row in result.groupBy("doc_id").count().collect()} == wanted


def test_components_of_paths_and_stars(spark):
    draw = random.Random(3)
    edges = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 160)] + [(7, 7), (None, 3), (205, 200)]
    draw.shuffle(edges)
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {row["id"]: row["component"] for row in components.components(frame).collect()}
    wanted = dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 160), 100) | {200: 200, 205: 200}
    assert found == wanted


# --- pages -------------------------------------------------------------------


PAGE = """<!DOCTYPE html><body class="has-sidebar"><header><p>Site</p></header><div id="cookieNotice">We use</div>
<nav>m<ul><li>x</li></ul></nav><main><article class="post"><header><h1>T &amp; x</h1></header><p class="ad">buy
<p>One<br>two <i>th</i>ree</p><aside>side</aside><form><input><p>mail</p></form><ul><li>a<li>b</ul>
<table><tr><td>1<td>2</table><section class="comments"><article class="comment"><p>hi</p></article></section>
<p>End&nbsp;ok &#233;&unknown;</article><p>rel</main><footer>f</footer><script>if(a<b){"</article>"}</script>"""


def test_marks_decide_what_the_article_is():
    assert pages.main_text(pages.page_lines(PAGE), []) == "T & x\nOne two three\na\nb\n1 2\nEnd ok é&unknown;"


@pytest.mark.parametrize(
    "html",
    [
        '<div class="has-sidebar"><article><p>Text</article></div>',
        '<div id="page" class="layout-sidebar"><main><p>Text</main></div>',
        '<div class="hidden-xs content"><article><p>Text</article></div>',
        '<div class="search"><div class="widget"><div class="ad">buy</div><article><p>Text</article></div></div>',
        '<form id="aspnetForm"><main><p>Text</main></form>',
        '<aside><article>teaser</aside><article><p>Text</article>',
        '<div><span class="ad">buy</div><article><p>Text</article>',
        '<article><div class="overflow-hidden hidden-print"><p>Text</div></article>',
        '<article><p>Text</article><div class="related"><article>other</article></div>',
        '<article><p>Text</p><div><div class="comments"><article>so</article></div></div></article>',
        '<article><p>Text</p><ul><li class="ad"><p>buy</p><p>now</p></ul></article>',
    ],
)
def test_what_holds_the_article_is_not_left_out(html):
    assert pages.main_text(pages.page_lines(html), []) == "Text"


def test_ids_that_links_lead_to_are_no_marks():
    html = """<article id="how-to-search"><section id="discussion"><h2 id="related-work">a</h2><h2 id="how-to-search">b</h2>
<p id="follow-up">c</p><h3><span id="Comments">d</span></h3></section><div class="section" id="notices">e</div>
<section class="comments">f</section><div id="comments">g</div><div class="ad"><p>h<section id="menu">i</section></div>j</article>"""
    assert pages.main_text(pages.page_lines(html), []) == "a\nb\nc\nd\ne\nj"
    assert pages.main_text(pages.page_lines('<h1 id="search">a</h1><div id="search">b</div>c'), []) == "a\nc"


def test_left_out_elements_end_with_their_parent():
    html = """<article><div><span class="share">x</div><p>a</p><section><div class="ad">y</section><p>b</p>
<table><tr><td class="ad">z<td>1<td>2<tr><td>3</div>4</table><section><article class="comment">q</section>c</article>"""
    assert pages.main_text(pages.page_lines(html), []) == "a\nb\n1 2\n3\n4\nc"


def test_main_around_an_article_is_kept():
    def text(page, shared=(), compared=False):
        return pages.main_text(pages.page_lines(page), list(shared), compared)

    page = "<p>Site<main><h1>Title</h1><p>lead</p><article><p>long text</p></article><p>tail</p></main><p>foot"
    assert text(page) == "Title\nlead\nlong text"
    assert text(page, [0, 5], True) == "Title\nlead\nlong text\ntail"
    assert text(page, [0, 2, 4, 5], True) == "Title\nlong text"
    assert text(page, range(6), True) == "Title\nlead\nlong text"  # a mirror
    cards = "<main><article>card a</article><p>The first part of it</p><article>card b</article><p>The second part</main>"
    assert text(cards, [0, 2], True) == "The first part of it\nThe second part"
    assert text(cards) == text(cards, range(4), True) == "card a\nThe first part of it\ncard b\nThe second part"
    assert text("<main><p>Text</main><article>card</article>") == "Text\ncard"


def test_difference_tells_main_and_teasers_apart(spark):
    def page(n):
        cards = "<article><p>Card one</article><article><p>Card two</article>"
        return f"<main><p>Newest</p><h1>Title {n}</h1><p>The story {n} is long enough</p>{cards}</main>"

    rows = [(n, f"http://a.example/{n}", page(n)) for n in range(3)] + [(9, "http://b.example/", page(9))]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {row["page_id"]: row for row in pages.extract(frame).collect()}
    assert [found[n]["text"] for n in range(3)] == [f"Title {n}\nThe story {n} is long enough" for n in range(3)]
    assert found[9]["text"] == "Newest\nTitle 9\nThe story 9 is long enough\nCard one\nCard two"


def test_common_lines_are_a_longest_common_subsequence():
    draw = random.Random(0)
    for _ in range(500):
        a, b = ([draw.randrange(4) for _ in range(draw.randrange(9))] for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = pages.common_lines(a, b)
        rest = iter(b)
        assert len(found) == table[-1][-1] and all(a[at] in rest for at in found)


def test_long_pages_are_compared_in_little_memory():
    lines = list(range(20_000))
    tracemalloc.start()
    assert pages.common_lines(lines, lines) == lines
    assert len(pages.common_lines([7] * 3000, [7] * 2000)) == 2000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20


def test_many_equal_pages_are_many_ranges(spark, uncoalesced):
    row = (None, "http://a.example/x", "<p>one</p><p>two</p>")
    frame = spark.createDataFrame([row] * 2000, "page_id bigint, url string, html string").repartition(8)
    placed = pages.with_neighbours(pages.line_hashes(frame))
    assert placed.count() == 2000
    assert placed.where("before is null").count() == placed.where("after is null").count() == 1
    ranged = placed.withColumn("part", F.spark_partition_id()).groupBy("part").count().agg(F.max("count")).first()[0]
    assert ranged < 1000
    assert pages.extract(frame).groupBy("text").count().collect()[0]["count"] == 2000


def test_lines_that_neighbours_share_are_deleted(spark):
    def page(text):
        return f"<div>Daily News</div><div>Home</div><p>{text}</p><div>Imprint</div>"

    rows = [
        (1, "http://a.example/x/1", page("First story"), "clash"),
        (2, "http://A.example/x/2?q=1", page("Second story"), "clash"),
        (3, "http://b.example/only", page("Alone"), "clash"),
        (4, None, "", "clash"),
        (5, "odd", None, "clash"),
        (6, "http://a.example/x/3", page("First story"), "clash"),
        (None, "http://c.example/", PAGE, "clash"),
        (None, "http://c.example/", PAGE, "clash"),
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string").repartition(4)
    found = pages.extract(frame).collect()
    assert len(found) == 8
    texts_ = {row["page_id"]: row["text"] for row in found}
    assert texts_[1] == "First story" and texts_[2] == "Second story" and texts_[6] == "First story"
    assert texts_[3] == "Daily News\nHome\nAlone\nImprint"
    assert texts_[4] == texts_[5] == ""
    assert texts_[None].startswith("T & x")
    assert all(row["n_chars"] == len(row["text"]) for row in found)
    assert pages.extract(frame.limit(0)).count() == 0


# --- top-k -------------------------------------------------------------------


def brute_top(vectors, k, every):
    found = set()
    for query, q in vectors:
        if query is None or query % every:
            continue
        others = []
        for vec_id, v in vectors:
            if vec_id is not None and vec_id != query:
                others.append((-sum(a * b for a, b in zip(q, v, strict=False)), vec_id))
        found |= {(query, rank, vec_id, -score) for rank, (score, vec_id) in enumerate(sorted(others)[:k], 1)}
    return found


def test_top_matches_brute_force(spark):
    draw = random.Random(2)
    rows = [(n, [draw.randrange(-8, 8) / 16 for _ in range(6)]) for n in range(300)]
    rows += [(300, None), (301, [None] * 6), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, []), (305, [0.5])]
    rows += [(None, [0.25] * 6), (7, [0.25] * 6), (320, rows[0][1]), (320, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    whole = [(n, [int(np.floor(256 * x)) for x in v]) for n, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    found = topk.exact_top(frame, every=10, block=64, query_block=16).collect()
    assert {tuple(row) for row in found} == brute_top(whole, 5, 10)
    assert len(found) == len(set(map(tuple, found)))
    assert topk.exact_top(frame.limit(0)).count() == 0


def test_lists_stop_early_with_the_right_answer():
    draw = np.random.default_rng(1)
    vectors = draw.integers(-3, 3, (4000, 4))
    vectors[:6] = 200
    lists = topk.SortedLists(np.arange(4000), vectors)
    ids, scores = lists.top(np.array([2, 1, 1, 3]), 3, 5)
    assert ids.tolist() == [0, 1, 2, 4, 5] and set(scores.tolist()) == {1400}


# --- edit-aware counts -------------------------------------------------------


def test_tree_follows_edits(monkeypatch):
    monkeypatch.setattr(counting, "LEAF_CHARS", 12)
    draw = random.Random(1)
    letters = "abc  \n'éx"
    encode = tokens.encoder()
    for _ in range(150):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(120)))
        tree = counting.CountTree(text, encode)
        for _ in range(20):
            insert = "".join(draw.choice(letters) for _ in range(draw.choice([0, 1, 3, 60])))
            edit = counting.Edit(draw.randrange(-3, len(text) + 4), draw.randrange(30), insert)
            at = min(max(0, edit.at), len(text))
            text = text[:at] + insert + text[at + edit.length :]
            tree.apply(edit)
            assert tree.text() == text and tree.n_chars == len(text)
            assert tree.n_tokens == len(encode.ids(text.encode())) // 2


def test_long_leaves_are_split_alone(monkeypatch):
    encode = tokens.encoder()
    tree = counting.CountTree("a word " * 3000, encode)
    held = {id(leaf) for leaf in tree.leaves()}
    inserted = "new words " * 1000
    tree.apply(counting.Edit(9000, 0, inserted))
    assert len(held - {id(leaf) for leaf in tree.leaves()}) == 1
    assert tree.reencoded < 2 * 2000 + 2 * counting.SPLIT * counting.LEAF_CHARS
    text = ("a word " * 3000)[:9000] + inserted + ("a word " * 3000)[9000:]
    assert tree.text() == text and tree.n_tokens == len(encode.ids(text.encode())) // 2
    monkeypatch.setattr(counting, "LEAF_CHARS", 4)
    deep = counting.CountTree("", encode)
    for _ in range(400):
        deep.apply(counting.Edit(0, 0, "ab cd " * 8))
    assert deep.text() == "ab cd " * 3200 and deep.n_tokens == len(encode.ids(deep.text().encode())) // 2
    leaves = list(deep.leaves())
    levels = []
    for leaf in leaves:
        levels.append(0)
        while leaf.above:
            leaf, levels[-1] = leaf.above, levels[-1] + 1
    assert max(levels) <= 2 * len(leaves).bit_length() + counting.MORE_LEVELS


def test_long_words_are_encoded_where_they_are_edited():
    encode = tokens.encoder()
    text = " ".join(["x" * 5000] * 40)
    tree = counting.CountTree(text, encode)
    for n in range(30):
        tree.apply(counting.Edit(5001 * n + 2, 1, "y"))
        at = 5001 * n + 2
        text = text[:at] + "y" + text[at + 1 :]
    assert tree.text() == text and tree.reencoded == 2 * 30
    assert tree.n_tokens == len(encode.ids(text.encode())) // 2


def test_edited_counts(documents, empty):
    edits = documents.sparkSession.createDataFrame(
        [(3, 2, 0, 3, "ten"), (3, 1, 0, 0, "twenty"), (0, 1, 5, 5, "new text"), (6, 1, None, None, None)],
        "doc_id bigint, seq int, at int, length int, insert string",
    )
    found = by_id(counting.edited_counts(counting.with_edits(documents, edits)))
    assert len(found) == 17
    assert found[3]["n_tokens"] == len(whole_ids("tenntyone two")) and found[3]["n_edits"] == 2
    assert found[0]["n_tokens"] == len(whole_ids("new text")) and found[0]["n_tokens_before"] == 0
    assert found[6]["n_tokens"] == found[6]["n_tokens_before"] == len(whole_ids(texts()[6]))
    derived = documents.select(
        "doc_id", "text", counting.derived_edits(F.col("doc_id"), F.col("text")).alias("edits")
    )
    counted = by_id(counting.edited_counts(derived))
    for row in derived.collect():
        text = row["text"] or ""
        for edit in row["edits"]:
            at = min(edit["at"], len(text))
            text = text[:at] + edit["insert"] + text[at + edit["length"] :]
        assert counted[row["doc_id"]]["n_tokens"] == len(whole_ids(text))
        assert counted[row["doc_id"]]["n_chars"] == len(text)
        assert counted[row["doc_id"]]["n_reencoded"] <= 30 * len(row["edits"])
    no_edits = empty.withColumn("edits", F.array().cast("array<struct<at:int,length:int,insert:string>>"))
    assert counting.edited_counts(no_edits).count() == 0


def test_sha_of_the_query_is_that_of_the_kept_words(spark):
    from ledgerloom.llm.queries import op4_substring_dedup

    rows = op4_substring_dedup(spark, "/root/testdata/sf0.001").collect()
    texts_ = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    kept = dict(zip([row["doc_id"] for row in texts_], brute_kept([row["text"] for row in texts_]), strict=True))
    for row in rows:
        assert row["kept_sha256"] == hashlib.sha256(kept[row["doc_id"]].encode()).hexdigest()


def test_matches_of_cells_are_those_counted_one_by_one():
    """Also where few meetings are held at once, and where a pair has matches in several cells."""
    draw = np.random.default_rng(7)
    size, classes = 4000, 60
    n = draw.integers(20, 60, classes)
    matches, group = draw.integers(1, 5, classes), draw.integers(0, 40, classes)
    hub, far = draw.integers(0, 5, classes), draw.random(classes)
    far[draw.random(classes) < 0.3] = np.nan
    postings = {(int(main), int(shingle), int(own)) for main, shingle, own in draw.integers(0, [3, 12, classes], (size, 3))}
    place = {row: int(draw.integers(0, 8)) for row in postings}
    all_of = Counter(own for _, _, own in postings)
    here = Counter((main, own) for main, _, own in postings)
    rows = []
    for main, shingle, own in postings:
        fixed = (shingle, own, n[own], matches[own], place[main, shingle, own], group[own], hub[own], far[own], all_of[own] - here[main, own])
        for first in {group[own] != main, False}:
            rows.append((main, 0, 0, bool(first), *fixed))
    rows.sort(key=lambda row: row[0])
    names = ["main", "low", "high", "first", "shingle", "id", "n", "matches", "place", "group_id", "hub", "far", "others"]
    columns = {name: np.array([row[at] for row in rows]) for at, name in enumerate(names)}
    slow, asks, limits = Counter(), {}, {}
    for main, shingle, x in postings:
        for other_main, other_shingle, y in postings:
            if (main, shingle) != (other_main, other_shingle) or group[x] == main or group[x] == group[y]:
                continue
            both, least = n[x] + n[y], min(n[x], n[y])
            overlap = -(-75 * both // 175)
            beyond = max(-(-75 * n[z] // 100) - matches[z] for z in (x, y))
            asked = min(max(min(matches[x], matches[y]), overlap - beyond), 4 + least // 20)
            still = min(n[z] - place[main, shingle, z] for z in (x, y)) + asked - 1
            apart = hub[x] == hub[y] and abs(far[x] - far[y]) > 0.25 + 1e-9
            if (group[y] == main or x < y) and still >= overlap and 100 * least >= 75 * max(n[x], n[y]) and not apart and hub[x] != y and hub[y] != x:
                key = (main, min(x, y), max(x, y))
                slow[key] += 1
                asks[key] = asked
                limits[key] = min(all_of[z] - here[main, z] for z in (x, y))
    expected = {(*key, count, asks[key]) for key, count in slow.items() if count + limits[key] >= asks[key]}
    assert len(expected) > 20
    for held in (1, 50, 400_000):
        jaccard.HELD_MEETINGS, kept = held, jaccard.HELD_MEETINGS
        try:
            found = jaccard.count_matches(columns)
        finally:
            jaccard.HELD_MEETINGS = kept
        assert set(zip(*(found[name].tolist() for name in ("main", "a", "b", "shared", "asked")), strict=True)) == expected


def test_near_duplicates_in_a_group_of_many_blocks(spark, monkeypatch):
    """Copies of one text with so many changes that most are not linked to the middle one."""
    monkeypatch.setattr(jaccard, "COUNT_BLOCK", 16)
    draw = random.Random(9)
    base = passage(20, 150)
    rows = []
    for doc in range(260):
        own = list(base)
        for _ in range(draw.randrange(1, 11)):
            own[draw.randrange(150)] = f"n{draw.randrange(10**6)}"
        rows.append((doc, " ".join(own)))
    sets = [{tuple(text.split()[at : at + 5]) for at in range(146)} for _, text in rows]
    least = list(range(260))
    for a in range(260):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((least[a], least[b]))
                least = [low if own == high else own for own in least]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    found = {row["doc_id"]: row["component_id"] for row in jaccard.near_duplicates(frame).collect()}
    assert found == dict(enumerate(least))
    assert len(set(least)) > 5


def test_numbers_that_are_no_letters_are_undetermined(spark):
    assert language.letters_only("½ ² ³ Ⅷ ① 12 _") == ""
    assert language.letters_only("a²b Ünï 東京 x_y 3z") == " a b ünï 東京 x y z "
    rows = [(n, "plain words of one tongue", "en") for n in range(1, 20)] + [(50, "½ ² ³ Ⅷ ①", None), (51, "٣ ٤ ५", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = {row["doc_id"]: (row["lang_pred"], row["score"]) for row in language.identify_languages(frame).collect()}
    assert found[50] == found[51] == ("und", 0.0)


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    from ledgerloom.llm import words

    batch = pa.RecordBatch.from_pydict({"text": [b"x" * n for n in (10, 5000, 3, 0, 200_000, 7, 7)]})
    parts = list(words.parted(batch, 1000))
    assert sum((part.column("text").to_pylist() for part in parts), []) == batch.column("text").to_pylist()
    assert all(part.num_rows == 1 or part.nbytes <= 1000 for part in parts)
    assert list(words.parted(batch, 10**6)) == [batch]


def test_stores_of_other_work_are_emptied():
    from ledgerloom.llm import words

    words.word_hashes([b"one", b"two"])
    words.empty_stores(("hashes",))
    assert len(words._HASHES) >= 2
    words.empty_stores()
    assert len(words._HASHES) == 0


def test_repeated_ids_do_not_enlarge_the_samples(spark, monkeypatch):
    """What reaches the driver stays within the stated rows, and reruns agree."""
    from pyspark.sql.classic.dataframe import DataFrame

    sizes, real = [], DataFrame.toPandas

    def counted(frame):
        found = real(frame)
        sizes.append(len(found))
        return found

    monkeypatch.setattr(DataFrame, "toPandas", counted)
    rows = [(7, f"the text of number {n % 50} and some words", "de" if n % 2 else "en") for n in range(3000)]
    rows += [(n + 100, f"other words {n} of a tongue", "en") for n in range(30)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.learn(frame, 5000, 10)
    again = language.learn(frame.repartition(5), 5000, 10)
    assert max(sizes) <= 20
    assert model.rates.tolist() == again.rates.tolist()
    labels = spark.createDataFrame([(7, 1), (7, 0), (100, 1), (101, 0)], "doc_id bigint, quality int")
    sizes.clear()
    trees = [quality.fit(own, labels, 10) for own in (frame, frame.repartition(3))]
    assert max(sizes) <= 10
    draw = np.random.default_rng(1).random((5, len(quality.FEATURES)))
    assert trees[0].score(draw).tolist() == trees[1].score(draw).tolist()


def test_vectors_and_scores_beyond_64_bits_are_errors(spark):
    def top(*vectors):
        frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>")
        return [tuple(row) for row in topk.exact_top(frame, every=1).orderBy("query_id", "rank").collect()]

    exact = top([2.0**32 + 1 / 256, 1.0], [2.0**10 + 1 / 256, 1.0])
    assert exact[0] == (0, 1, 1, (2**40 + 1) * (2**18 + 1) + 65536)
    with pytest.raises(Exception, match="component does not fit"):
        top([1e30], [1.0])
    with pytest.raises(Exception, match="score does not fit"):
        top([2.0**40], [2.0**40])


def test_batches_are_bounded_by_bytes(spark):
    frame = spark.range(0, 8000, 1, 1).select(F.expr("cast(repeat('x', 2000) as binary)").alias("text"))
    sizes = words.map_rows(frame, lambda batch: [{"n": [len(batch["text"])]}], "n bigint").collect()
    assert sum(row.n for row in sizes) == 8000
    assert max(row.n for row in sizes) * 2000 <= 1.1 * words.BATCH_BYTES


def test_a_bound_of_the_session_stays(spark):
    before = spark.conf.get(words._BATCH_SETTING, None)
    try:
        spark.conf.set(words._BATCH_SETTING, 1 << 20)
        words.ship_package(spark)
        assert spark.conf.get(words._BATCH_SETTING) == str(1 << 20)
    finally:
        spark.conf.set(words._BATCH_SETTING, before) if before else spark.conf.unset(words._BATCH_SETTING)


def test_a_worker_keeps_no_hashes_from_task_to_task(spark):
    """Workers that are idle hold memory beside what Spark itself works with."""

    def rows(batch):
        held = len(words._HASHES)
        words.word_hashes([b"a", b"b"])
        yield {"held": [held], "n": [len(batch["id"])]}

    # More tasks than workers.
    found = words.map_rows(spark.range(0, 64, 1, 64).select("id"), rows, "held bigint, n bigint").collect()
    assert {row.held for row in found} == {0} and sum(row.n for row in found) == 64


def test_pairs_are_found_once_before_they_are_verified(spark):
    """Finding them takes more than a join; they are read for the sizes of clusters and for the pairs."""
    met = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    texts = spark.createDataFrame([(n, " ".join(passage(n % 3, 20))) for n in range(9)], "id bigint, text string")
    pairs = spark.createDataFrame([(0, 0, n) for n in range(1, 9)], "cluster bigint, a bigint, b bigint")
    found = jaccard.verified(pairs.mapInArrow(count, "cluster bigint, a bigint, b bigint"), texts).collect()
    assert met.value == 8
    assert {row["b"]: row["linked"] for row in found} == {n: n % 3 == 0 for n in range(1, 9)}


def test_a_class_is_one_row_of_a_cell(spark, monkeypatch):
    cells = []
    counted = jaccard._counted
    monkeypatch.setattr(jaccard, "_counted", lambda rows: cells.append(rows) or counted(rows))
    # Texts of one group, and others that share its shingles and are in none.
    classes = spark.createDataFrame(
        [(n, 40, 4, place, 100 + place) for n in range(6) for place in range(8)],
        "id bigint, n bigint, matches int, place int, shingle bigint",
    )
    groups = spark.createDataFrame([(n, 0) for n in range(4)], "id bigint, component bigint")
    hubs = spark.createDataFrame([], "a bigint, b bigint, linked boolean, far double")
    found = jaccard.open_pairs(classes, groups, hubs).collect()
    rows = cells[0].collect()
    assert len(rows) == len({(row["main"], row["low"], row["high"], row["id"], row["first"]) for row in rows}) == 8
    pairs = {(row["a"], row["b"]) for row in found}
    assert pairs == {(a, b) for a in range(6) for b in (4, 5) if a < b}

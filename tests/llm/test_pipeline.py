"""The pipeline, stage by stage, on a small corpus with planted cases."""

import random

import pytest

import corpus_pipeline
from ledgerloom.llm import jaccard, mixing, packing, substrings

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed, size):
    draw = random.Random(seed)
    return [draw.choice(["stone", "river", "over", "under", "house", "light"]) + str(draw.randrange(500)) for _ in range(size)]


@pytest.fixture(scope="module")
def corpus():
    rows = [(n, " ".join(words(n, 90)), "en", f"s{n % 3}") for n in range(40)]
    shared = words("shared", 60)
    near = words(3, 90)
    near[45] = "changed"
    rows += [
        (100, " ".join(words(1, 90)), "en", "s0"),  # an exact copy of 1
        (101, " ".join(near), "en", "s1"),  # a near copy of 3
        (102, " ".join(words("a", 70) + shared), "en", "s2"),  # with 103, a shared passage
        (103, " ".join(shared + words("b", 70)), "en", "s0"),
        (104, None, "en", "s0"),
        (105, "12345 67890 !!!", "en", "s0"),
        (106, "Привет мир это текст на другом языке", None, None),
    ]
    return [(*row[:2], row[2], row[3], len(row[1] or "")) for row in rows]


@pytest.fixture(scope="module")
def stages(spark, corpus, tmp_path_factory):
    """What each stage returns, written and read again."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.createDataFrame(corpus, SCHEMA)
    found = [docs]
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, found[-1], str(folder)).write.parquet(str(folder / str(place)))
        found.append(spark.read.parquet(str(folder / str(place))))
    return found


def ids(frame):
    return sorted(row["doc_id"] for row in frame.select("doc_id").collect())


def test_all_but_the_last_stage_return_documents(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for frame in stages[1:-1]:
        assert frame.columns == [field.split()[0] for field in SCHEMA.split(", ")]


def test_texts_in_no_known_language_go(stages):
    assert set(ids(stages[0])) - set(ids(stages[1])) == {104, 105, 106}


def test_one_of_each_group_stays(stages):
    assert set(ids(stages[1])) - set(ids(stages[2])) == {100, 101}


def test_repeated_passages_are_cut_and_no_document_is(stages):
    assert ids(stages[2]) == ids(stages[3])
    texts = {row["doc_id"]: row for row in stages[3].collect()}
    assert texts[102]["text"] == " ".join(words("a", 70))
    assert texts[103]["text"] == " ".join(words("b", 70))
    assert texts[5]["text"] == " ".join(words(5, 90))
    assert all(row["n_chars"] == len(row["text"]) for row in texts.values())


def test_sources_near_their_targets(stages):
    mixed = mixing.mix(stages[3]).groupBy("source").sum("taken").collect()
    rows = stages[4].collect()
    for source, taken in mixed:
        assert sum(len(row["text"].split()) for row in rows if row["source"] == source) == taken


def test_everything_is_packed(stages):
    packed = stages[5].collect()
    assert sorted(row["doc_id"] for row in packed if row["piece"] == 0) == ids(stages[4])
    used = {}
    for row in packed:
        used.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_run_is_all_stages(spark, corpus, stages, tmp_path):
    spark.createDataFrame(corpus, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, result.drop("sequence_id", "offset").collect())) == sorted(
        map(tuple, stages[5].drop("sequence_id", "offset").collect())
    )
    assert corpus_pipeline.ORACLE_SQL is None


def test_an_empty_corpus_passes_through(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, "")
        assert found.count() == 0
    assert jaccard.one_of_each(docs).count() == substrings.without_repeats(docs).count() == 0


RESERVED = [
    "_language_text", "_language_pred", "_language_score", "_language_phrase", "_language_letters", "_substrings_text",
    "_substrings_id", "_substrings_key", "_substrings_spans", "_substrings_kept", "_copy_id", "_copy_key", "_once", "_row",
    "_mix_draw", "_mix_part", "_mix_rank", "_mix_own", "_mix_copy", "_mix_times", "_mix_count", "_column_0", "origin", "a.b`c",
]


@pytest.mark.parametrize("place", range(4))
def test_columns_of_any_name_are_kept_by_every_stage(spark, corpus, tmp_path, place):
    """Null and repeated ids and rows among them, and an empty table."""
    rows = [*corpus, corpus[3], corpus[3], (None, corpus[5][1], "en", "s1", 1), (None, None, None, None, None)]
    wide = [(*row, *[f"{n}-{at}" for at in range(len(RESERVED))]) for n, row in enumerate(rows)]
    extra = ", ".join(f"`{name.replace('`', '``')}` string" for name in RESERVED)
    docs = spark.createDataFrame(wide, f"{SCHEMA}, {extra}")
    stage = corpus_pipeline.STAGES[place][1]
    found = stage(spark, docs, str(tmp_path))
    assert found.columns == docs.columns
    got = found.collect()
    assert got
    names = {row[len(SCHEMA.split(", "))].split("-")[0] for row in wide}
    for row in got:
        own = row[5].split("-")[0]
        assert own in names
        assert list(row[5:]) == [f"{own}-{at}" for at in range(len(RESERVED))]
    assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []

import json

import pytest

from ledgerloom.sources.dictionary import (
    check_schema,
    dictionary_frame,
    features_of,
    keys_of,
    load_fields,
    read_dictionary,
    target_of,
    with_roles,
)

# Sample dictionary (name, dataType, valueType, usageType) and expected roles.
SAMPLE = [
    ("id_transaction", "integer", "continious", "keyField", "SKIP"),
    ("trans_amount", "double", "continious", "feature", "DOUBLE"),
    ("trans_date", "date-time", "continious", "feature", "DATE"),
    ("trans_cur", "string", "nominal", "feature", "NOMINAL"),
    ("debt_account", "string", "nominal", "skip", "SKIP"),
    ("cred_account", "string", "nominal", "skip", "SKIP"),
    ("cred_bal", "double", "continious", "feature", "DOUBLE"),
    ("debt_bal", "double", "continious", "feature", "DOUBLE"),
    ("payer_fio", "string", "text", "feature", "TEXT"),
    ("reciver_fio", "string", "text", "feature", "TEXT"),
    ("is_fraud", "boolean", "flag", "targetField", "TARGET"),
]
MEMBERS = ("name", "dataType", "valueType", "usageType")
TARGET = {"name": "y", "dataType": "integer", "valueType": "flag", "usageType": "targetField"}


def _attrs(rows=SAMPLE):
    return [dict(zip(MEMBERS, row)) for row in rows]


def _feature(name, data, value):
    return {"name": name, "dataType": data, "valueType": value, "usageType": "feature"}


def test_file_is_read_in_order_and_unread_members_do_no_harm(spark, tmp_path):
    attrs = _attrs()
    attrs[4]["explicitTransform"] = ["anything"]
    path = tmp_path / "dictionary.json"
    path.write_text(json.dumps({"name": "transaction_event", "attrs": attrs}, indent=2))
    frame = read_dictionary(spark, str(path))
    assert frame.columns == ["pos", *MEMBERS]
    assert sorted(map(tuple, frame.collect())) == [(i, *row[:4]) for i, row in enumerate(SAMPLE)]
    assert load_fields(frame) == load_fields(dictionary_frame(spark, attrs))


def test_sample_roles_in_declared_order(spark):
    fields = load_fields(dictionary_frame(spark, _attrs()))
    assert [(f.pos, f.name, f.role) for f in fields] == [(i, r[0], r[4]) for i, r in enumerate(SAMPLE)]
    assert target_of(fields) == "is_fraud"
    assert keys_of(fields) == ["id_transaction"]
    assert features_of(fields, "DOUBLE", "DATE") == ["trans_amount", "trans_date", "cred_bal", "debt_bal"]


@pytest.mark.parametrize("value", ["continious", "nominal", "flag", "text"])
def test_value_type_does_not_matter_for_numbers_and_dates(spark, value):
    frame = dictionary_frame(spark, [_feature("a", "double", value), _feature("b", "date-time", value)])
    assert [row.role for row in with_roles(frame).orderBy("pos").collect()] == ["DOUBLE", "DATE"]


@pytest.mark.parametrize(
    ("data", "value"),
    [
        ("integer", "continious"),
        ("boolean", "flag"),
        ("currency", "continious"),
        ("string", "flag"),
        ("string", "continious"),
    ],
)
def test_features_of_other_types_are_refused(spark, data, value):
    with pytest.raises(ValueError, match=f"bad: no feature can be built from {data} / {value}"):
        load_fields(dictionary_frame(spark, [_feature("bad", data, value), TARGET]))


@pytest.mark.parametrize("usage", ["keyField", "skip"])
@pytest.mark.parametrize("data", ["integer", "boolean", "currency"])
def test_the_same_types_are_fine_when_no_feature(spark, usage, data):
    attr = {"name": "a", "dataType": data, "valueType": "flag", "usageType": usage}
    assert load_fields(dictionary_frame(spark, [attr, TARGET]))[0].role == "SKIP"


@pytest.mark.parametrize("member", ["dataType", "valueType", "usageType"])
@pytest.mark.parametrize("word", ["nonsense", "Feature", "DOUBLE", ""])
def test_unknown_words_are_named(spark, member, word):
    attr = {**_feature("a", "double", "continious"), member: word}
    with pytest.raises(ValueError, match=f"a: unknown {member} {word}"):
        load_fields(dictionary_frame(spark, [attr, TARGET]))


@pytest.mark.parametrize("member", MEMBERS)
def test_every_member_is_needed(spark, member):
    attr = _feature("a", "double", "continious")
    del attr[member]
    with pytest.raises(ValueError, match=f"{member} is missing"):
        load_fields(dictionary_frame(spark, [attr, TARGET]))


def test_all_bad_rows_are_listed(spark):
    attrs = [_feature("a", "integer", "flag"), _feature("b", "double", "odd"), TARGET, TARGET]
    with pytest.raises(ValueError) as error:
        load_fields(dictionary_frame(spark, attrs))
    for text in ("a: no feature", "b: unknown valueType odd", "y: declared twice", "found 2"):
        assert text in str(error.value)


def test_a_target_is_needed(spark):
    with pytest.raises(ValueError, match="exactly one targetField is needed, found 0"):
        load_fields(dictionary_frame(spark, [_feature("a", "double", "continious")]))


def test_table_must_hold_what_the_dictionary_uses(spark):
    fields = load_fields(dictionary_frame(spark, _attrs()))
    good = (
        "id_transaction int, trans_amount double, trans_date timestamp, trans_cur string, "
        "cred_bal double, debt_bal double, is_fraud boolean, not_declared binary"
    )
    check_schema(fields, spark.createDataFrame([], good).schema)
    bad = "id_transaction int, trans_amount string, trans_date int, trans_cur int, cred_bal double, is_fraud string"
    with pytest.raises(ValueError) as error:
        check_schema(fields, spark.createDataFrame([], bad).schema)
    for text in (
        "trans_amount: string cannot serve as DOUBLE",
        "trans_date: int cannot serve as DATE",
        "trans_cur: int cannot serve as NOMINAL",
        "debt_bal: not in the table",
        "is_fraud: string cannot serve as TARGET",
    ):
        assert text in str(error.value)
    assert "payer_fio" not in str(error.value)

import random

import pytest

from ledgerloom.operators.confusion import classification_metrics, confusion_counts, prediction_target


def _frame(spark, rows, target="int"):
    return spark.createDataFrame(rows, f"prediction double, t {target}, extra string")


def test_counts_and_metrics_against_brute_force(spark):
    draw = random.Random(5)
    rows = [(float(draw.random() < 0.4), int(draw.random() < 0.3), "x") for _ in range(3000)]
    df = _frame(spark, rows)
    pairs = [(p, t) for p, t, _ in rows]
    tp, fp, tn, fn = (pairs.count(cell) for cell in ((1.0, 1), (1.0, 0), (0.0, 0), (0.0, 1)))
    assert tuple(confusion_counts(df, "prediction", "t").first()) == (tp, fp, tn, fn, 3000)
    precision, recall = tp / (tp + fp), tp / (tp + fn)
    assert classification_metrics(df, "prediction", "t").first().asDict() == {
        "precision": precision,
        "recall": recall,
        "f1Score": 2.0 * precision * recall / (precision + recall),
        "accuracy": (tp + tn) / 3000,
    }


def test_other_labels_are_in_no_cell_but_count_as_rows(spark):
    df = _frame(spark, [(1.0, 1, ""), (1.0, 2, ""), (0.5, 0, ""), (None, 1, ""), (0.0, None, "")])
    assert tuple(confusion_counts(df, "prediction", "t").first()) == (1, 0, 0, 0, 5)
    assert classification_metrics(df, "prediction", "t").first()["accuracy"] == 0.2


@pytest.mark.parametrize(
    ("rows", "metrics"),
    [
        ([(0.0, 1, "")], (None, 0.0, None, 0.0)),
        ([(1.0, 0, "")], (0.0, None, None, 0.0)),
        ([(1.0, 0, ""), (0.0, 1, "")], (0.0, 0.0, None, 0.0)),
        ([(0.0, 0, "")], (None, None, None, 1.0)),
        ([(1.0, 1, "")], (1.0, 1.0, 1.0, 1.0)),
        ([], (None, None, None, None)),
    ],
)
def test_nothing_to_divide_by_is_null(spark, rows, metrics):
    assert tuple(classification_metrics(_frame(spark, rows), "prediction", "t").first()) == metrics


def test_boolean_target_counts_as_zero_and_one(spark):
    df = _frame(spark, [(1.0, True, ""), (0.0, False, "")], "boolean")
    assert tuple(confusion_counts(df, "prediction", "t").first()) == (1, 0, 1, 0, 2)


def test_metrics_read_two_columns(spark):
    df = _frame(spark, [(1.0, 1, "x")])
    assert prediction_target(df, "prediction", "t").columns == ["prediction", "t"]

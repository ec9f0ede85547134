"""Class metrics against hand-computed values."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import classes as cl


@pytest.fixture()
def long(spark):
    rows = [("s", 1, "a", "a"), ("s", 2, "a", "b"), ("s", 3, "b", "b"), ("s", 4, "c", "a")]
    return spark.createDataFrame(rows, "system string, example_id int, y_true string, y_pred string")


def test_accuracy_and_macro_f1(long):
    assert long.transform(cl.accuracy).first().accuracy == pytest.approx(0.5)
    # per label: a p=1/2 r=1/2 f=.5; b p=1/2 r=1 f=2/3; c p=0 r=0 f=0
    assert cl.macro_f1(long).first().macro_f1 == pytest.approx((0.5 + 2 / 3 + 0) / 3)
    # listed labels: d is absent everywhere and scores 0
    assert cl.macro_f1(long, ["a", "b", "d"]).first().macro_f1 == pytest.approx((0.5 + 2 / 3) / 3)


def test_micro_equals_accuracy_single_label(long):
    rep = {r.row: r for r in cl.class_report(long).collect()}
    assert rep["accuracy"].f1 == pytest.approx(0.5)
    assert rep["weighted avg"].support == 4


def test_align_missing_and_duplicates(spark):
    gold = spark.createDataFrame([(1, "a"), (2, "b")], "example_id int, y_true string")
    preds = spark.createDataFrame([("x", 1, "a"), ("x", 1, "z"), ("y", 2, "b")],
                                  "system string, example_id int, y_pred string")
    al = cl.align(gold, preds, ["x", "y"])
    assert al.count() == 4  # no fan-out from the duplicate, missing kept
    acc = {r.system: r.accuracy for r in cl.accuracy(al).collect()}
    assert acc == {"x": 0.0, "y": 0.5}  # two answers to one example are none
    n = {(r.system, r.example_id): (r.y_pred, r.n_predictions) for r in al.collect()}
    assert n == {("x", 1): (None, 2), ("x", 2): (None, 0), ("y", 1): (None, 0), ("y", 2): ("b", 1)}


def test_listed_labels_that_never_occur_score_zero(spark):
    df = spark.createDataFrame([("a", "x", "x"), ("b", "x", "y")], "system string, y_true string, y_pred string")
    assert {r.system: r.macro_f1 for r in cl.macro_f1(df, labels=["u", "v"]).collect()} == {"a": 0.0, "b": 0.0}


def test_hamming_and_recall(spark):
    df = spark.createDataFrame([(["a", "b"], ["a"]), ([], [])], "g array<string>, p array<string>")
    assert cl.hamming_loss(df, "g", "p", 2).first().hamming_loss == pytest.approx(0.25)

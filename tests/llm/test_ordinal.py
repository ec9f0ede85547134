import random

import numpy as np
import pytest
from llm_fixtures import AWKWARD, make_docs
from pyspark.sql import functions as F

from tessera.llm.ordinal import GRADES, features, fit, good_documents, rate_documents

LABELS = "doc_id long, quality int, toxic int"


def graded(n, seed):
    rnd = random.Random(seed)
    words = [f"word{i}"[:4] + "abcdefghij"[i % 10] * 3 for i in range(10)] + "the a of and to in is".split()
    rows = []
    for i in range(n):
        g = rnd.choice([0, 1, 2, 2, 2])
        w = [rnd.choice(words) for _ in range(rnd.randint(20, 60))]
        if g == 1:
            w[3] = rnd.choice(["nasty", "vile", "awful"])
        if g == 0:
            w = [x + "###" for x in w]
        rows.append((i, " ".join(w), g))
    return rows


def test_fit_orders_thresholds_and_grades():
    rows = graded(800, 1)
    model = fit([features(t) for _, t, _ in rows], np.array([g for *_, g in rows]))
    assert np.all(np.diff(model.thresholds) > 0)
    test = graded(400, 2)
    tails = model.tails(model.score([t for _, t, _ in test]))
    assert np.all(np.diff(tails, axis=1) <= 0)
    got = (tails >= 0.5).sum(axis=1)
    assert np.mean(got == np.array([g for *_, g in test])) > 0.95


def test_features_are_whole_text_and_distinct():
    a = features("x " * 50000 + "last")
    assert len(a) == len(set(a.tolist())) and set(features("last")) - set(a.tolist()) != set(features("last"))
    assert len(features("")) == 5


@pytest.mark.parametrize("grades", [[], [2, 2, 2]])
def test_fit_without_contrast_keeps_all(grades):
    model = fit([features("a b")] * len(grades), np.array(grades, dtype=np.int64))
    assert (model.tails(model.score(["anything", ""]))[:, GRADES - 2] > 0.99).all()


def test_documents_held_out(spark):
    """Accuracy on rated documents that the fit does not see."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    seen = labels.where("pmod(doc_id, 2) = 0")
    got = rate_documents(docs, seen).join(labels.where("pmod(doc_id, 2) = 1"), "doc_id")
    kept = {(r.quality, r.toxic): r.kept for r in got.groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[1, 0] > 0.96 and kept[0, 0] < 0.05 and kept[1, 1] < 0.25


def test_awkward_and_empty(spark):
    base = make_docs(spark, AWKWARD).withColumn("grade", F.lit("clash")).withColumn("weights", F.lit(1))
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 1), (4, 0, 0), (None, 1, 1), (7, None, 1)], LABELS)
    got = rate_documents(base, labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in got)
    assert good_documents(base, labels).columns == base.columns
    none = spark.createDataFrame([], LABELS)
    assert all(r.kept for r in rate_documents(base, none).collect())
    assert good_documents(base, none).count() == len(AWKWARD)
    assert rate_documents(make_docs(spark, []), labels).count() == 0


def test_sample_is_bounded(spark):
    rows = graded(60, 3)
    docs = make_docs(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, int(g > 0), int(g == 1)) for i, _, g in rows], LABELS)
    from tessera.llm.ordinal import rated_sample
    assert rated_sample(docs, labels, 25).count() == 25

"""Segmentation metrics: perfect prediction scores perfectly."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tessera.operators import segments as sg
from tessera.sources import fixtures as fx


def test_perfect_prediction(spark):
    b = fx.boundaries(spark, SF001).withColumn("pred_b", F.col("gold_b"))
    n = sg.number_events(b)
    for k in (None, 3):
        w, p = sg.window_diff(n, k=k).first(), sg.pk_metric(n, k=k).first()
        assert w.window_diff == 0.0 and p.pk == 0.0 and w.n_windows == p.n_windows > 0
    assert sg.panoptic_quality(n).first().pq == pytest.approx(1.0)
    assert sg.boundary_prf(b).first().f1 == pytest.approx(1.0)


def test_segments_give_their_labels_back(spark):
    n = sg.number_events(fx.boundaries(spark, SF001))
    labels = sg.segments_to_labels(sg.boundaries_to_segments(n))
    joined = n.join(labels, ["stream", "pos"])
    assert joined.count() == n.count()
    assert joined.where("pos > 0 and (label = 'B-DOC') <> (gold_b = 1)").count() == 0


def test_segments_cover_stream(spark):
    b = fx.boundaries(spark, SF001)
    segs = sg.boundaries_to_segments(sg.number_events(b))
    assert segs.agg(F.sum("n")).first()[0] == b.count()

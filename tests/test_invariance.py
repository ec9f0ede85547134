"""Partition-count invariance: same answers with 1 and 64 shuffle partitions."""

import pytest

import __spark_entry__ as entry
from conftest import SF0001

QUERIES = ["m5_bleu", "m17_span_f1", "a5_class_report", "m29_window_diff", "k8_pack", "m31_panoptic_quality"]


@pytest.mark.parametrize("name", QUERIES)
def test_same_result_any_partitioning(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = entry.queries()[name](spark, SF0001)
            results.append(sorted(tuple(r) for r in df.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]

import zlib

import pytest
from pyspark.sql import functions as F

from llm_fixtures import AWKWARD, make_docs
from tessera.llm.sharding import permuted, shard_rows


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 1000, 4099])
def test_permutation_is_a_bijection(spark, n):
    got = [r[0] for r in spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), 5)).collect()]
    assert sorted(got) == list(range(n))
    assert n < 100 or got != list(range(n))


def test_shards_gapless_and_even(spark):
    rows = [(i, f"text {i}") for i in range(203)]
    got = shard_rows(make_docs(spark, rows).repartition(7), 8).collect()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        raw = f"text {r.doc_id}".encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        assert r.grown_shard is None and r.law == "rows"
    assert sorted(by) == list(range(8))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    again = shard_rows(make_docs(spark, rows).repartition(3), 8).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_awkward_rows(spark):
    got = shard_rows(make_docs(spark, AWKWARD).withColumn("slot", F.lit("clash")).withColumn("_at", F.lit(1)), 8).collect()
    assert len(got) == len(AWKWARD)
    want = sorted((r[0] is None, r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in AWKWARD)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == want


def test_empty_table(spark):
    assert shard_rows(make_docs(spark, []), 8).count() == 0

"""Distributed numbering equals window numbering, whatever the partitioning."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from conftest import SF001
from tessera.operators.sequence import number_within


def _events(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    # a third of all rows in one stream
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    return ev.select("user_id", "ts", "event_id", (F.col("event_type") == "signup").cast("int").alias("b"))


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_positions_and_running_sums(spark, parts):
    ev = _events(spark)
    got = number_within(ev, ["ts", "event_id"], ["user_id"], ["b"], partitions=parts) \
        .select("user_id", "event_id", "pos", "cum_b")
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    exp = ev.select("user_id", "event_id", (F.row_number().over(w) - 1).alias("pos"),
                    F.sum("b").over(w).alias("cum_b"))
    # a union in the same stage must not shift the partition tags
    u = exp.withColumn("v", F.lit(1)).unionByName(got.withColumn("v", F.lit(-1)))
    bad = u.groupBy("user_id", "event_id", "pos", "cum_b").agg(F.sum("v").alias("s")).where("s != 0")
    assert bad.count() == 0
    assert got.count() == ev.count()


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_rows_before_and_exact_integers(spark, parts):
    """Nulls beside integers over 2^53, one stream over many partitions."""
    big = 2**53 + 1
    rows = [(1 if i % 3 else None, i, None if i % 5 == 0 else big + i) for i in range(400)] + [(2, i, i) for i in range(5)]
    df = spark.createDataFrame(rows, "s int, i long, v long")
    got = {(r.s, r.i): r for r in number_within(df, ["i"], ["s"], ["v"], partitions=parts, lags=["v", "i"]).collect()}
    for s in (None, 1, 2):
        own, total = sorted((i, v) for a, i, v in rows if a == s), 0
        for n, (i, v) in enumerate(own):
            r, total = got[s, i], total + (v or 0)
            before = own[n - 1] if n else (None, None)
            assert (r.pos, r.v, r.cum_v, r.prev_i, r.prev_v) == (n, v, total, *before)


def test_global_numbering(spark):
    ev = _events(spark)
    got = number_within(ev.select("event_id", "b"), ["event_id"], sums=["b"], partitions=7, lags=["event_id"])
    assert got.agg(F.min("pos"), F.max("pos")).first() == (0, ev.count() - 1)
    assert got.where("prev_event_id is null").count() == 1
    assert got.where("prev_event_id >= event_id").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert number_within(ev.limit(0), ["event_id"], ["user_id"], ["b"]).count() == 0

"""Streaming preparation gives the same rows as the batch operator."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF0001
from tessera.operators.prepare import prepare_task
from tessera.sources.fixtures import with_split
from tessera.streaming.prepare_stream import prepare_stream, read_stream, write_prepared_stream


def test_stream_matches_batch(spark):
    src = f"{SF0001}/documents.parquet"
    schema = spark.read.parquet(src).schema
    out = tempfile.mkdtemp(prefix="tessera-stream-")
    stream = read_stream(spark, src, schema).select(F.col("doc_id").alias("id"), "text",
                                                     F.col("source").alias("intent"), F.col("text").alias("utt"))
    q = write_prepared_stream(prepare_stream(stream, "02"), os.path.join(out, "sink"), os.path.join(out, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(out, "sink")).select("id", "split", "text")
    batch = spark.read.parquet(src).select(F.col("doc_id").alias("id"), F.col("source").alias("intent"),
                                           F.col("text").alias("utt"))
    exp = prepare_task(with_split(batch, "id"), "02")
    assert got.count() == exp.count()
    assert got.exceptAll(exp.select("id", "split", "text")).count() == 0

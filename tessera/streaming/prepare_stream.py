"""Structured Streaming entry for task preparation.

Prompt rendering, label decoding, stripping and the other P-operators are
stateless column expressions, so the same ``prepare_task`` runs unchanged on
a streaming DataFrame: new source files are picked up incrementally and the
rendered rows are appended to a Parquet sink partitioned by split. The
reference has no stateful stream operator, so none is built here (no
watermark, no state store).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.prepare import prepare_task
from ..sources.fixtures import split_of


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file source stream (schema given up front, as streaming requires).
    A single file is read as its folder filtered to that file name."""
    import os

    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if os.path.isfile(path):
        r = r.option("pathGlobFilter", os.path.basename(path))
        path = os.path.dirname(path)
    return r.load(path)


def prepare_stream(stream: DataFrame, task_id: str, id_col: str = "id") -> DataFrame:
    """Streaming task preparation: split by id, then the task's prompt."""
    with_split = stream.withColumn("split", split_of(F.col(id_col)))
    if id_col != "id":
        with_split = with_split.withColumnRenamed(id_col, "id")
    return prepare_task(with_split, task_id, keep=("id", "split"))


def write_prepared_stream(prepared: DataFrame, sink: str, checkpoint: str,
                          available_now: bool = True) -> StreamingQuery:
    """Append to Parquet partitioned by split; the checkpoint location makes
    the file sink exactly-once across restarts."""
    w = (prepared.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).partitionBy("split").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()

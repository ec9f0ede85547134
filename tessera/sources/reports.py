"""Run reports and run logs as JSON sinks/sources.

Reports and logs are derived from the ``events`` table here (one run per
user, one log per user and day), written as JSON under the shared checkpoint
folder and read back, so the JSON read path is exercised at data scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sequence import number_within

REPORT_SCHEMA = T.StructType([
    T.StructField("task_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("steps", T.LongType()),
    T.StructField("elapsed_sec", T.DoubleType()),
    T.StructField("output_dir", T.StringType()),
    T.StructField("saved_files", T.ArrayType(T.StringType())),
    T.StructField("note", T.StringType()),
])

LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("global_step", T.LongType()),
    T.StructField("log_history", T.ArrayType(T.StructType([
        T.StructField("step", T.LongType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("num_tokens", T.DoubleType()),
    ]))),
])


#: Lines of a run log in one JSON object.
LOG_PART = 1000


def reports_from_events(events: DataFrame) -> DataFrame:
    """One dry-run-shaped report per run (user): FAILED when the run logged an
    error, steps = events, elapsed = Σ value / 1000."""
    return events.groupBy("user_id").agg(
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("task_id"),
        F.when(F.max((F.col("event_type") == "error").cast("int")) == 1, "FAILED").otherwise("PASSED").alias("status"),
        F.count(F.lit(1)).alias("steps"),
        (F.sum("value") / 1000.0).alias("elapsed_sec"),
        F.concat(F.lit("checkpoints/run_"), F.col("user_id").cast("string")).alias("output_dir"),
        F.array_sort(F.collect_set("event_type")).alias("saved_files"),
        F.lit("derived from events").alias("note")).drop("user_id")


def write_reports(df: DataFrame, path: str) -> None:
    """S6 sink: JSON, one object per line."""
    df.write.mode("overwrite").json(path)


def report_rollup(spark: SparkSession, path: str) -> DataFrame:
    """S6 roll-up: runs per status, total and slowest elapsed time."""
    r = spark.read.schema(REPORT_SCHEMA).json(path)
    return r.groupBy("status").agg(F.count(F.lit(1)).alias("n_runs"),
                                   F.round(F.sum("elapsed_sec"), 6).alias("total_elapsed"),
                                   F.round(F.max("elapsed_sec"), 6).alias("max_elapsed"),
                                   F.max_by("task_id", F.struct("elapsed_sec", "task_id")).alias("slowest"))


def logs_from_events(events: DataFrame) -> DataFrame:
    """Trainer-state-shaped logs per (user, day): steps in (ts, event_id)
    order, loss = value / 100, num_tokens = running Σ (k + 1). A log of more
    than ``LOG_PART`` lines goes on in further parts, each an object of its own
    with the last step it holds, so that no run is gathered whole."""
    run = F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMdd"))
    e = events.select(run.alias("run_id"), "ts", "event_id", (F.col("value") / 100.0).alias("loss"),
                      (F.get_json_object("props", "$.k").try_cast("long") + 1).alias("k"))
    # steps and running token counts per run without a per-run window task
    e = number_within(e, ["ts", "event_id"], ["run_id"], sums=["k"], pos_col="_pos")
    e = e.withColumn("step", (F.col("_pos") + 1).cast("long")).withColumn("num_tokens", F.col("cum_k").cast("double"))
    return e.groupBy("run_id", F.floor(F.col("_pos") / LOG_PART).alias("_part")).agg(
        F.max("step").alias("global_step"),
        F.array_sort(F.collect_list(F.struct("step", "loss", "num_tokens"))).alias("log_history")).drop("_part")


def explode_run_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per logged step with tokens in the interval since the
    previous log line and perplexity exp(loss).

    Lines are paired with the line before by a numbering, not inside a run's
    row: steps need not be contiguous, a run may lie in any number of objects,
    and its length is not bounded. A first line counts from 0; a log without
    lines gives no row."""
    logs = spark.read.schema(LOG_SCHEMA).json(path)
    lines = (logs.select("run_id", F.explode_outer("log_history").alias("h")).where(F.col("h").isNotNull())
             .select("run_id", "h.*"))
    prev = number_within(lines, ["step"], ["run_id"], lags=["num_tokens"])
    return prev.select("run_id", "step", "loss", "num_tokens",
                       (F.col("num_tokens") - F.coalesce(F.col("prev_num_tokens"), F.lit(0.0))).alias("interval_tokens"),
                       F.exp("loss").alias("perplexity"))


def write_logs(df: DataFrame, path: str) -> None:
    """S7 sink: JSON, one object per line."""
    df.write.mode("overwrite").json(path)

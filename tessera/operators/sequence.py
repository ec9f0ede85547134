"""Ordered numbering and running sums without single-task windows.

A window ``partitionBy(stream).orderBy(ts)`` puts a whole stream in one task;
one hot stream holding a third of the rows then holds a third of the work of
one executor. ``number_within`` range-partitions the rows on (stream, order)
instead, so a hot stream is split over many tasks. The sorted rows are written
once; windows then run inside (range partition, stream), and what a stream has
in earlier range partitions is added from a summary with one row per range
partition, the only broadcast. DataFrame functions only, so integers stay
exact whatever nulls stand beside them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def number_within(df: DataFrame, order: Sequence[str], by: Sequence[str] = (),
                  sums: Sequence[str] = (), partitions: int | None = None,
                  pos_col: str = "pos", lags: Sequence[str] = ()) -> DataFrame:
    """Add ``pos`` (0-based position inside each ``by`` group in ``order``),
    ``cum_<c>`` (inclusive running sum of integer column c inside the group,
    nulls as 0) and ``prev_<c>`` (c in the row before, null in a group's first).

    ``by + order`` must identify a row (a unique tiebreaker such as an id is
    part of ``order``). Project the frame to the columns you need first: rows
    are range-exchanged, written and dealt by (range partition, group) once.
    The write is a job of its own, run when this is called; the files lie
    under the shared checkpoint folder.
    """
    by, order, sums, lags = list(by), list(order), list(sums), list(lags)
    spark = df.sparkSession
    keys = by + order
    # Without an explicit count the range exchange is sized by AQE; coalesced
    # partitions are still contiguous key ranges, which is all that is needed.
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    path = scratch_path(spark, "numbered")
    stamped = ranged.sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    stamped.write.parquet(path)
    local = spark.read.schema(stamped.schema).parquet(path).withColumn("_part", F.shiftrightunsigned("_at", 33))

    run = Window.partitionBy("_part", *by).orderBy("_at")
    upto = run.rowsBetween(Window.unboundedPreceding, 0)
    group = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("k"))
    rows = local.withColumn("_lpos", F.row_number().over(run).cast("long") - 1)
    rows = rows.withColumns({f"_lcum_{s}": F.sum(F.coalesce(F.col(s), F.lit(0)).cast("long")).over(upto) for s in sums}) if sums else rows
    rows = rows.withColumns({f"_lag_{c}": F.lag(c).over(run) for c in lags}) if lags else rows

    # what each range partition begins and ends with
    facts = local.groupBy("_part", *by).agg(
        F.min("_at").alias("_lo"), F.max("_at").alias("_hi"), F.count(F.lit(1)).alias("n"),
        *[F.sum(F.coalesce(F.col(s), F.lit(0)).cast("long")).alias(f"s_{s}") for s in sums],
        *[F.max_by(F.struct(c), "_at").alias(f"l_{c}") for c in lags])
    carried = ["n", *[f"s_{s}" for s in sums], *[f"l_{c}" for c in lags]]
    ends = facts.groupBy("_part").agg(
        F.min_by(group, "_lo").alias("_first"), F.max_by(group, "_hi").alias("_last"), F.max_by(F.struct(*carried), "_hi").alias("t"))
    # tails in range order, and one question per partition: what came before of its first group
    tails = ends.select(F.col("_last").alias("g"), "_part", F.lit(False).alias("asks"), *[F.col(f"t.{c}").alias(c) for c in carried])
    asks = ends.select(F.col("_first").alias("g"), "_part", F.lit(True).alias("asks"),
                       *[F.lit(None).cast(tails.schema[c].dataType).alias(c) for c in carried])
    earlier = Window.partitionBy("g").orderBy("_part").rangeBetween(Window.unboundedPreceding, -1)
    answers = tails.unionByName(asks).select(
        "asks", F.col("_part").alias("_p"), F.col("g").alias("_first"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_o_{c}") for c in carried[:1 + len(sums)]],
        *[F.last(f"l_{c}", ignorenulls=True).over(earlier).alias(f"_o_l_{c}") for c in lags]).where("asks").drop("asks")

    joined = rows.join(F.broadcast(answers), F.col("_part") == F.col("_p"))
    goes_on = group.eqNullSafe(F.col("_first"))
    added = {pos_col: F.col("_lpos") + F.when(goes_on, F.col("_o_n")).otherwise(0)}
    for s in sums:
        added[f"cum_{s}"] = F.col(f"_lcum_{s}") + F.when(goes_on, F.col(f"_o_s_{s}")).otherwise(0)
    for c in lags:
        added[f"prev_{c}"] = F.when(goes_on & (F.col("_lpos") == 0), F.col(f"_o_l_{c}").getField(c)).otherwise(F.col(f"_lag_{c}"))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[v.alias(k) for k, v in added.items()])

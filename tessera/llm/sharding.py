"""Sharding by a Feistel permutation over global row numbers.

Every row gets a global number 0..N-1, a keyed permutation of 0..N-1 maps it
to a position, and position p lies in shard ``p % shards`` at slot
``p div shards``. Shard and slot of a row follow from its number, N and the
seed alone, so a lost shard is rebuilt without moving any other row, and the
counts of any two shards differ by one at most (law ``rows``).

DataFrame functions only: the numbering is a range exchange of narrow rows (no
text), the permutation is column arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, saved, text_or_empty

ROUNDS = 6
#: Steps of cycle walking. The domain a*a (a = ceil(sqrt(n))) exceeds n by less
#: than 2*sqrt(n)+1, and a walk is never longer than that excess plus one; from
#: n = 4096 on 64 steps leave a chance below 1e-90 of an unfinished walk, which
#: ``permuted`` turns into an error instead of a wrong position.
WALK_STEPS = 192


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _rounds(x: Column, side: Column, seed: int) -> Column:
    """One pass of the Feistel network on Z_side x Z_side (a bijection of
    0..side*side-1). Halves are carried through the rounds in a struct, so
    that each round is evaluated once."""
    start = F.struct(_div(x, side).alias("l"), F.pmod(x, side).alias("r"))
    keys = F.array(*[F.lit(seed * 1000003 + k) for k in range(ROUNDS)])

    def turn(s: Column, key: Column) -> Column:
        return F.struct(s["r"].alias("l"), F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], key), side), side).alias("r"))

    return F.aggregate(keys, start, turn, lambda s: s["l"] * side + s["r"])


def permuted(x: Column, n: Column, seed: int) -> Column:
    """Position of number ``x`` (0 <= x < n) under the seed's permutation of
    0..n-1: Feistel network, walked until the value falls below n. Only the
    few values that miss at the first pass enter the loop."""
    root = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    side = F.when(root * root < n, root + 1).otherwise(root)

    def walk(s: Column) -> Column:
        steps = F.sequence(F.lit(1), F.lit(WALK_STEPS))
        return F.aggregate(steps, s["y"], lambda y, _: F.when(y < s["n"], y).otherwise(_rounds(y, s["a"], seed)),
                           lambda y: F.when(y < s["n"], y).otherwise(F.raise_error(F.lit("cycle walk unfinished")).cast("long")))

    given = let(F.struct(x.cast("long").alias("x"), n.cast("long").alias("n"), side.alias("a")),
                lambda s: F.struct(_rounds(s["x"], s["a"], seed).alias("y"), s["n"].alias("n"), s["a"].alias("a")))
    return let(given, lambda s: F.when(s["y"] < s["n"], s["y"]).otherwise(walk(s)))


def global_rows(df: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """Number the rows 0..N-1 in ``order`` and add ``n_rows`` = N.

    A range exchange sorts the rows, each partition numbers its own, and the
    counts of the earlier partitions (one row per partition, the only
    broadcast) are added. The sorted rows are written once before they are
    used twice, because the bounds of a second range exchange may differ.
    Rows equal in every order column may swap numbers; they are
    interchangeable if ``order`` holds every column that is used later.
    """
    local = saved(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("_at", F.monotonically_increasing_id()), name)
    part, inside = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = local.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    every = Window.orderBy("_part")
    offsets = counts.select("_part", (F.sum("_n").over(every) - F.col("_n")).alias("_before"),
                            F.sum("_n").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n_rows"))
    return (local.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + inside).drop("_at", "_part", "_before"))


def shard_rows(df: DataFrame, shards: int, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard, row_number, n_rows``.

    size: UTF-8 bytes of the text plus 1 (null text: 1). text_crc32: unsigned
    CRC-32 of those bytes (null: 0). law: ``rows``. grown_shard: null (one more
    shard deals the rows anew under this law). Row numbers follow (id, CRC,
    size), null ids first; rows equal in all three are interchangeable. An
    empty table gives no rows; other columns of ``df`` are not read.
    """
    text = text_or_empty(F.col(text_col))
    narrow = df.select(F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    numbered = global_rows(narrow, ["doc_id", "text_crc32", "size"])
    placed = numbered.withColumn("_pos", permuted(F.col("row_number"), F.col("n_rows"), seed))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.pmod("_pos", F.lit(shards)).cast("int").alias("shard"),
        _div(F.col("_pos"), F.lit(shards)).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row_number", "n_rows")


def row_of(shard: Column, slot: Column, shards: int) -> Column:
    """Position held by (shard, slot); with the permutation it names the row."""
    return slot * F.lit(shards) + shard

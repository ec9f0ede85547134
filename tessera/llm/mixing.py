"""Mixing sources to target weights by a multivariate-hypergeometric tree.

The words that the mix takes from a source are one stream: its documents in a
seeded random order, passed over once or more often until the source's quota
is reached. The stream is cut into blocks of ``block_words`` words, so every
source has an exact quota of blocks. A splitting tree deals these quotas to
the output shards: the root holds the vector of all quotas, every node halves
its blocks between its children and draws how many blocks of each source go
left (multivariate hypergeometric, so exactly the law of a random permutation
of all blocks, without ever listing them). A leaf is a shard with an exact
number of blocks of every source; it draws them as a range of the permuted
block numbers of that source, so shards are disjoint and together complete.
Rows are put in random order only inside their shard.

What is gathered on the driver is one row per source (name and words), which
does not grow with the documents of a source.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import few, let, saved, words
from .sharding import permuted

#: Copies (an id and five numbers each) that are broadcast to their texts.
BROADCAST_ROWS = 1_000_000
#: Rows that one window of the stream order holds, about.
WINDOW_ROWS = 4096


def source_targets(sizes: dict[str | None, int], weights: tuple[float, ...], share: float, max_repeat: float) -> dict[str | None, float]:
    """Target words per source. Sources by code point, null last, weigh
    ``weights`` in turn and share ``share`` times all words; a target stops at
    ``max_repeat`` times its source's words and the excess is shared again by
    weight among the others, until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    limit = {s: max_repeat * sizes[s] for s in order}
    target: dict[str | None, float] = {}
    total, free = share * sum(sizes.values()), order
    while free:
        left = total - sum(target.values())
        whole = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / whole > limit[s]]
        if not over:
            target.update({s: left * weight[s] / whole for s in free})
            break
        target.update({s: float(limit[s]) for s in over})
        free = [s for s in free if s not in target]
    return target


def split_blocks(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """``[shard, source]`` block counts: the leaves of the splitting tree.
    Columns sum to ``quotas``; row sums differ by one at most per level."""
    rng = np.random.default_rng(seed)
    leaves: list[np.ndarray] = []

    def node(blocks: np.ndarray, n: int) -> None:
        if n == 1:
            leaves.append(blocks)
            return
        here = int(blocks.sum())
        left = n // 2
        take = here * left // n
        drawn = _hypergeometric(rng, blocks, take)
        node(drawn, left)
        node(blocks - drawn, n - left)

    node(np.asarray(quotas, dtype=np.int64), shards)
    return np.vstack(leaves)


def _hypergeometric(rng: np.random.Generator, blocks: np.ndarray, take: int) -> np.ndarray:
    """One multivariate-hypergeometric draw as a chain of univariate draws.
    numpy draws up to 1e9 blocks a time; beyond that counts are split evenly
    first, which keeps sums exact."""
    out, rest = np.zeros_like(blocks), int(blocks.sum())
    for i, own in enumerate(map(int, blocks)):
        rest -= own
        if take == 0:
            break
        if own + rest < 1_000_000_000:
            got = int(rng.hypergeometric(own, rest, take)) if own else 0
        else:  # normal law of the same mean and variance, cut to what is possible
            n, p = own + rest, own / (own + rest)
            sd = (take * p * (1 - p) * (n - take) / max(1, n - 1)) ** 0.5
            got = int(min(own, take, max(0, take - rest, round(rng.normal(take * p, sd)))))
        out[i], take = got, take - got
    return out


def measured(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Narrow rows (doc_id, source, size, order), written once."""
    return saved(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("ord")), "mix_sizes")


def stream_positions(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Add ``start``: words of the source before this document in its random
    order. The order is a hash, so ranges of it hold about ``WINDOW_ROWS``
    rows each however large a source is; running sums go over one range at a
    time and over the totals of the ranges."""
    spread = counts.select(F.col("source").alias("_s"), F.ceil(F.col("n") / WINDOW_ROWS).alias("_ranges"))
    placed = rows.join(spread, rows["source"].eqNullSafe(spread["_s"])).drop("_s")
    unit = F.shiftrightunsigned(F.col("ord"), 11).cast("double") / F.lit(float(1 << 53))
    placed = placed.withColumn("_range", F.least(F.floor(unit * F.col("_ranges")), F.col("_ranges") - 1))
    inside = Window.partitionBy("source", "_range").orderBy(F.col("ord") < 0, "ord", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("source").alias("_s"), F.col("_range").alias("_r"),
                            F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_before"))
    local = placed.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return (local.join(offsets, local["source"].eqNullSafe(offsets["_s"]) & (local["_range"] == offsets["_r"]))
            .withColumn("start", F.col("_before") + F.col("_in"))
            .drop("_ranges", "_range", "_in", "_s", "_r", "_before"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_repeat: int = 2, shards: int = 8,
        block_words: int = 1024, whole_documents: bool = False, seed: int = 11, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target,
    taken, copies``; copies is an array of (copy, words, block, shard, place),
    one entry per pass that takes the document.

    size counts words; a null or empty text has none and is taken with no
    words if its place in the stream lies inside the quota. The last document
    of a source's stream is cut at the quota, so the taken words are the
    target rounded to a word; with ``whole_documents`` it is taken whole if
    more than half of it lies inside, else left. place orders the rows of a
    shard (a hash, for the local shuffle). Rows equal in id and size are
    interchangeable. A null source is a source of its own, the last one. An
    empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = measured(docs, seed, id_col, text_col, source_col)
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    # one row per source
    known = {r["source"]: int(r["words"]) for r in counts.collect()}
    target = source_targets(known, weights, share, max_repeat)
    order = list(target)
    quota = {s: int(round(target[s])) for s in order}
    blocks = [-(-quota[s] // block_words) for s in order]
    dealt = split_blocks(blocks, shards, seed).cumsum(axis=0) if order else np.zeros((shards, 0), dtype=np.int64)
    plan = spark.createDataFrame(
        [(s, known[s], float(target[s]), quota[s], int(blocks[i]), [int(x) for x in dealt[:, i]]) for i, s in enumerate(order)],
        "p_source string, source_size long, target double, quota long, n_blocks long, shard_ends array<long>")
    placed = stream_positions(rows, counts)
    planned = placed.join(plan, placed["source"].eqNullSafe(plan["p_source"])).drop("p_source")
    copies = F.transform(F.sequence(F.lit(0), F.lit(int(max_repeat) - 1)), lambda c: _copy(c, block_words, whole_documents, seed))
    taken = planned.withColumn("copies", F.filter(copies, lambda x: x["words"] >= 0))
    return taken.select("doc_id", "source", "size", "source_size", "target",
                        F.aggregate("copies", F.lit(0).cast("long"), lambda a, x: a + x["words"]).alias("taken"), "copies")


def _copy(c: Column, block_words: int, whole: bool, seed: int) -> Column:
    """What pass ``c`` takes of the document; words -1: nothing."""
    at = c * F.col("source_size") + F.col("start")
    room = F.col("quota") - at
    if whole:
        # half of the document or more lies inside; its own words stay within max_repeat copies
        words_taken = F.when((room > 0) & (room * 2 >= F.col("size")), F.col("size")).otherwise(F.lit(-1).cast("long"))
    else:
        words_taken = F.when(room > 0, F.least(room, F.col("size"))).otherwise(F.lit(-1).cast("long"))
    block = F.call_function("div", at, F.lit(block_words)).cast("long")
    inside = F.least(block, F.col("n_blocks") - 1)
    spot = F.when(room > 0, permuted(F.greatest(inside, F.lit(0)), F.greatest(F.col("n_blocks"), F.lit(1)), seed)).otherwise(F.lit(-1))
    shard = let(spot, lambda p: F.size(F.filter("shard_ends", lambda e: e <= p)))
    return F.struct(c.alias("copy"), words_taken.alias("words"), block.alias("block"), shard.alias("shard"),
                    F.xxhash64(F.lit(seed + 1), F.col("doc_id"), c).alias("place"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", pieces: int = 32, **options) -> DataFrame:
    """The mix as rows of ``docs``, one for each copy, with all columns of
    ``docs``: whole documents, dealt to the output shards and in random order
    inside each.

    A row is found again by its id and source, and by its size where these are
    shared; rows equal in all three are treated alike, as the draw that comes
    first in the order of draws, so reruns agree. Null and empty texts have no
    words and go as their place says. An empty table gives no rows."""
    names = docs.columns
    plan = mix(docs, whole_documents=True, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    drawn = plan.groupBy("doc_id", "source", "size").agg(F.min("copies").alias("copies"))
    drawn = saved(drawn.select(F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("size").alias("_mix_size"), "copies"), "mix_draws")
    sizes = drawn.groupBy("_mix_id", "_mix_source").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("_mix_id").alias("_i"), F.col("_mix_source").alias("_s"), F.lit(True).alias("_shared"))
    told = drawn.join(few(sizes, BROADCAST_ROWS), F.col("_mix_id").eqNullSafe(F.col("_i")) & F.col("_mix_source").eqNullSafe(F.col("_s")), "left")
    chosen = saved(told.select("_mix_id", "_mix_source", F.when(F.col("_shared"), F.col("_mix_size")).alias("_mix_size"), F.explode("copies").alias("_mix")), "mix_copies")
    # words are counted again only where a size decides
    same = docs[id_col].eqNullSafe(F.col("_mix_id")) & docs[source_col].cast("string").eqNullSafe(F.col("_mix_source"))
    same = same & F.when(F.col("_mix_size").isNull(), F.lit(True)).otherwise(F.size(words(docs[text_col])) == F.col("_mix_size"))
    joined = docs.join(few(chosen, BROADCAST_ROWS), same)
    # a shard is many tasks: pieces of it by the random place, sorted inside
    return joined.repartition("_mix.shard", F.pmod("_mix.place", F.lit(pieces))).sortWithinPartitions("_mix.shard", "_mix.place").select(*[F.col(f"`{c}`") for c in names])

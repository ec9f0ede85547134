"""Tokens, vocabulary and packing (K1-K8).

K1-K3 and K6-K8 are column expressions and aggregations. K4 (BPE training)
works on the table of distinct words, so the corpus size only matters once
(K2): a pass merges the words a batch at a time as one array and returns the
change of the pair counts. K5 encodes words inside the
partitions that hold them (Arrow batches) with the merge list in the closure;
its size is bounded by the vocabulary size, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from heapq import heapify, heappop, heappush, nsmallest
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import word_tokens
from ..registry import BPE_SPECIAL_TOKENS, BPE_VOCAB_SIZE
from ..session import scratch_path
from .sequence import number_within


# ------------------------------------------------------------------ K2, K3

def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """K2: (word, freq) over all pre-tokens of ``text`` (map-side combined)."""
    return (df.select(F.explode_outer(word_tokens(text)).alias("word")).where(F.col("word").isNotNull())
            .groupBy("word").agg(F.count(F.lit(1)).alias("freq")))


def symbols_of(word: Column) -> Column:
    """Initial symbols of a word: its characters."""
    return F.split(word, "")


def pair_counts(words: DataFrame, symbols: str = "symbols", freq: str = "freq") -> DataFrame:
    """K3: adjacent symbol pairs weighted by word frequency."""
    s = F.col(symbols)
    pairs = F.transform(F.sequence(F.lit(1), F.size(s) - 1), lambda i: F.struct(
        F.element_at(s, i).alias("left"), F.element_at(s, i + 1).alias("right")))
    ex = words.where(F.size(s) >= 2).select(F.explode_outer(pairs).alias("p"), F.col(freq).alias("f")) \
        .where(F.col("p").isNotNull())
    return ex.groupBy("p.left", "p.right").agg(F.sum("f").cast("long").alias("count"))


def merge_pair(symbols: Column, left: str, right: str) -> Column:
    """Apply one merge left to right, non-overlapping, inside each array."""
    init = F.struct(F.array().cast("array<string>").alias("a"), F.lit(True).alias("free"))

    def step(acc, x):
        last = F.element_at(acc["a"], -1)
        hit = acc["free"] & (F.size(acc["a"]) > 0) & (last == F.lit(left)) & (x == F.lit(right))
        merged = F.concat(F.slice(acc["a"], 1, F.size(acc["a"]) - 1), F.array(F.lit(left + right)))
        return F.when(hit, F.struct(merged.alias("a"), F.lit(False).alias("free"))) \
            .otherwise(F.struct(F.concat(acc["a"], F.array(x)).alias("a"), F.lit(True).alias("free")))
    return F.aggregate(symbols, init, step, lambda acc: acc["a"])


# ------------------------------------------------------------------ K4

#: Initial pairs that the driver holds, the most frequent first. Only pairs of
#: two characters can be left out, and their counts never grow.
KNOWN_PAIRS = 200_000
#: Merges tried in one pass, at most.
MOST_TRIED = 32
#: Merges after which the words are written anew, so that a pass repeats few.
WRITE_EVERY = 48


def merge_word(word: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """Symbols of a word after its merges: always the pair of lowest rank, all
    its occurrences from the left. Pairs wait in a heap over a linked list, so
    a word of n letters takes n log n steps."""
    symbols = list(word)
    n = len(symbols)
    if n < 2:
        return symbols
    heap = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    if not heap:
        return symbols
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive: list[str | None] = list(symbols)
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        # the entry may be out of date: its symbols are gone or changed
        if alive[i] is None or j >= n or ranks.get((alive[i], alive[j])) != rank:
            continue
        alive[i], alive[j] = alive[i] + alive[j], None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((alive[i], alive[k]))) is not None:
                heappush(heap, (r, i))
        h = before[i]
        if h >= 0 and (r := ranks.get((alive[h], alive[i]))) is not None:
            heappush(heap, (r, h))
    return [x for x in alive if x is not None]


def _merged(symbols: list[str], left: str, right: str) -> list[str]:
    out, i, n = [], 0, len(symbols)
    while i < n:
        if symbols[i] == left and i + 1 < n and symbols[i + 1] == right:
            out.append(left + right)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def _packed(symbols: np.ndarray, lengths: np.ndarray, freqs: np.ndarray, kind: str) -> pa.RecordBatch:
    """The words of a batch in one row: their symbols as one array with -1
    before, between and after them, and their frequencies."""
    ends = np.cumsum(lengths + 1)
    flat = np.full(ends[-1] + 1 if len(ends) else 1, -1, dtype=kind)
    inside = np.ones(len(flat), dtype=bool)
    inside[0] = False
    inside[ends] = False
    flat[inside] = symbols
    return pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], type=pa.binary()), pa.array([freqs.astype(np.int64).tobytes()], type=pa.binary())],
                                      names=["symbols", "freqs"])


def _merge_flat(flat: np.ndarray, weights: np.ndarray, a: int, b: int, new: int):
    """One merge in all words of a batch, left to right. Returns the arrays
    after it and the places of the merges, before and after (None: nowhere)."""
    hits = np.flatnonzero((flat[:-1] == a) & (flat[1:] == b))
    if not len(hits):
        return flat, weights, None, None
    if a == b:  # in a row of equal symbols every second pair
        first = np.concatenate([[True], hits[1:] != hits[:-1] + 1])
        start = np.maximum.accumulate(np.where(first, np.arange(len(hits)), 0))
        hits = hits[(np.arange(len(hits)) - start) % 2 == 0]
    kept = np.ones(len(flat), dtype=bool)
    kept[hits + 1] = False
    after = flat.copy()
    after[hits] = new
    return after[kept], weights[kept], hits, hits - np.arange(len(hits))


class _PairSums:
    """Sums of (step, left, right), each one number, added up in pieces."""

    def __init__(self):
        self.keys, self.sums, self.held = [], [], 0

    def add(self, step: int, flat: np.ndarray, weights: np.ndarray, places: np.ndarray, sign: int = 1) -> None:
        """The pairs of symbols at ``places`` and after."""
        left, right = flat[places].astype(np.int64), flat[places + 1].astype(np.int64)
        real = (left >= 0) & (right >= 0)
        self._hold((step << 48) | (left[real] << 24) | right[real], sign * weights[places[real]])
        if self.held > 2_000_000:
            self.total()

    def _hold(self, keys: np.ndarray, sums: np.ndarray) -> None:
        if len(keys):
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            self.keys.append(keys[first])
            self.sums.append(np.add.reduceat(sums[order], first))
            self.held += len(first)

    def total(self) -> pa.RecordBatch:
        keys, sums = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (self.keys, self.sums))
        self.keys, self.sums, self.held = [], [], 0
        self._hold(keys, sums)
        keys, sums = (x[0] if x else np.zeros(0, dtype=np.int64) for x in (self.keys, self.sums))
        self.held = 0  # what is summed up does not count
        changed = sums != 0
        keys = keys[changed]
        return pa.RecordBatch.from_arrays([pa.array((keys >> 48).astype(np.int32)), pa.array(((keys >> 24) & 0xFFFFFF).astype(np.int32)),
                                           pa.array((keys & 0xFFFFFF).astype(np.int32)), pa.array(sums[changed])], names=["step", "left", "right", "count"])


_PAIR_SCHEMA = "step int, left int, right int, count long"
_STATE_SCHEMA = "symbols binary, freqs binary"


def _read_state(batches, merges, kind: str):
    """The words of each row after ``merges``, and beside each symbol the frequency of its word."""
    for batch in batches:
        for symbols, freqs in zip(batch.column("symbols"), batch.column("freqs")):
            flat = np.frombuffer(symbols.as_buffer(), dtype=kind)
            weights = np.append(0, np.repeat(np.frombuffer(freqs.as_buffer(), dtype=np.int64), np.diff(np.flatnonzero(flat < 0))))
            for m in merges:
                flat, weights, _, _ = _merge_flat(flat, weights, *m)
            yield flat, weights


def _characters(alphabet: Sequence[str], kind: str):
    """Arrow pass: words to the numbers of their characters in the alphabet (sorted), a row for each batch."""
    points = np.array([ord(c) for c in alphabet], dtype=np.uint32)

    def run(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
            yield _packed(np.searchsorted(points, flat), np.array([len(w) for w in words], dtype=np.int64),
                          batch.column("freq").to_numpy(zero_copy_only=False), kind)

    return run


def _merged_state(merges, kind: str):
    """Arrow pass: the words after ``merges``; those of one symbol are left out, as they hold no pair."""
    def run(batches):
        for flat, weights in _read_state(batches, merges, kind):
            ends = np.flatnonzero(flat < 0)
            lengths, freqs = np.diff(ends) - 1, weights[ends[1:]]
            kept = lengths > 1
            yield _packed(flat[flat >= 0][np.repeat(kept, lengths)], lengths[kept], freqs[kept], kind)

    return run


def _pairs_of(merges, kind: str):
    """Arrow pass: pair counts of the words under ``merges``, summed in the task."""
    def run(batches):
        sums = _PairSums()
        for flat, weights in _read_state(batches, merges, kind):
            sums.add(0, flat, weights, np.arange(len(flat) - 1))
        yield sums.total()

    return run


def _changes_of(merges, tried, kind: str):
    """Arrow pass: how each merge of ``tried``, applied after ``merges`` and
    those before it, changes the pair counts: only pairs at a merged place do."""
    def run(batches):
        sums = _PairSums()
        for flat, weights in _read_state(batches, merges, kind):
            for step, m in enumerate(tried):
                after, weights_after, old, new = _merge_flat(flat, weights, *m)
                if old is not None:
                    sums.add(step, flat, weights, np.unique(np.concatenate([old - 1, old, old + 1])), -1)
                    sums.add(step, after, weights_after, np.unique(np.concatenate([new - 1, new])))
                flat, weights = after, weights_after
        yield sums.total()

    return run


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("step", "left", "right").agg(F.sum("count").alias("count"))


def train_bpe(words: DataFrame, vocab_size: int = BPE_VOCAB_SIZE,
              special: Sequence[str] = tuple(BPE_SPECIAL_TOKENS), known_pairs: int = KNOWN_PAIRS):
    """K4: BPE vocabulary from a (word, freq) table of distinct words.

    Vocabulary = special tokens, then the alphabet (sorted), then one token
    per merge. Each merge is the most frequent adjacent pair, ties broken by
    (left, right) order: exactly the one-merge-at-a-time rule.

    Pair counts are kept on the driver (the ``known_pairs`` most frequent pairs
    of characters, and all pairs with a merged symbol) and change by
    differences: a pass takes the pairs that lead the counts, merges them one
    after the other in all words, an Arrow batch of words at a time as one
    array, and returns the change of every pair count by each merge. The driver
    replays the merges while each is indeed the leading pair; the rest of the
    pass is void. A pass repeats the merges since the words were last written
    (``WRITE_EVERY``) and keeps no state, so a lost executor loses nothing. If
    the lead falls to the count of a pair that was left out, all pairs are
    counted again. Returns (vocab, merges), both bounded by ``vocab_size``."""
    spark = words.sparkSession
    path = scratch_path(spark, "bpe_words")
    words.select("word", "freq").write.parquet(path)
    words = spark.read.parquet(path)
    alphabet = sorted(r["c"] for r in words.select(F.explode(symbols_of(F.col("word"))).alias("c")).distinct().collect())
    vocab = list(special) + [c for c in alphabet if c not in special]
    merges: list[tuple[str, str]] = []
    # symbols are numbered by their text: one that two merges make is one symbol
    letters = sorted(c for c in alphabet if c)
    symbols = list(letters)
    number = {c: i for i, c in enumerate(symbols)}

    # a pass makes one merge at least and tries no more than MOST_TRIED
    kind = "<i2" if len(letters) + (MOST_TRIED + 1) * vocab_size < 1 << 15 else "<i4"

    def numbered(pairs) -> list[tuple[int, int, int]]:
        for a, b in pairs:
            if a + b not in number:
                number[a + b] = len(symbols)
                symbols.append(a + b)
        return [(number[a], number[b], number[a + b]) for a, b in pairs]

    def written(rows: DataFrame) -> DataFrame:
        at = scratch_path(spark, "bpe_state")
        rows.write.parquet(at)
        return spark.read.parquet(at)

    state = written(words.where(F.length("word") >= 2).mapInArrow(_characters(letters, kind), _STATE_SCHEMA))
    n_written = 0

    def counted(most: int) -> tuple[dict, int]:
        top = _summed(state.mapInArrow(_pairs_of(numbered(merges[n_written:]), kind), _PAIR_SCHEMA)).orderBy(F.col("count").desc(), "left", "right").limit(most + 1).collect()
        return {(symbols[r["left"]], symbols[r["right"]]): r["count"] for r in top[:most]}, (top[most]["count"] if len(top) > most else 0)

    def leading(n: int) -> list:
        return nsmallest(n, counts.items(), key=lambda x: (-x[1], x[0]))

    counts, left_out = counted(known_pairs)
    tries = 4
    while len(vocab) < vocab_size:
        best = leading(min(tries, vocab_size - len(vocab)))
        if left_out and (not best or best[0][1] <= left_out):
            known_pairs *= 4
            counts, left_out = counted(known_pairs)
            continue
        if not best:
            break
        tried = [p for p, c in best if c > left_out]
        if len(merges) - n_written >= WRITE_EVERY:
            state = written(state.mapInArrow(_merged_state(numbered(merges[n_written:]), kind), _STATE_SCHEMA))
            n_written = len(merges)
        changes: dict[int, list] = {}
        for r in _summed(state.mapInArrow(_changes_of(numbered(merges[n_written:]), numbered(tried), kind), _PAIR_SCHEMA)).collect():
            changes.setdefault(r["step"], []).append(((symbols[r["left"]], symbols[r["right"]]), r["count"]))
        done = 0
        for k, pair in enumerate(tried):
            if done and leading(1)[0][0] != pair:
                break
            merges.append(pair)
            vocab.append(pair[0] + pair[1])
            for p, c in changes.get(k, []):
                # a pair of characters that is not held was left out; its count only falls
                if p in counts or len(p[0]) > 1 or len(p[1]) > 1:
                    counts[p] = counts.get(p, 0) + c
                    if counts[p] <= 0:
                        del counts[p]
            done += 1
        tries = min(MOST_TRIED, 2 * tries) if done == len(tried) else max(4, done + 2)
    return vocab, merges


def train_bpe_reference(words: DataFrame, vocab_size: int = BPE_VOCAB_SIZE,
                        special: Sequence[str] = tuple(BPE_SPECIAL_TOKENS)):
    """One merge per pass (the definition ``train_bpe`` must reproduce);
    kept for tests."""
    base = words.select("word", "freq", symbols_of(F.col("word")).alias("symbols"))
    table = base.checkpoint()
    alphabet = [r["c"] for r in table.select(F.explode("symbols").alias("c")).distinct().orderBy("c").collect()]
    vocab = list(special) + [c for c in alphabet if c not in special]
    merges = []
    while len(vocab) < vocab_size:
        best = pair_counts(table).orderBy(F.col("count").desc(), "left", "right").first()
        if best is None:
            break
        merges.append((best["left"], best["right"]))
        vocab.append(best["left"] + best["right"])
        table = table.withColumn("symbols", merge_pair(F.col("symbols"), best["left"], best["right"])).checkpoint()
    return vocab, merges


# ------------------------------------------------------------------ K5

#: Words that a task remembers with their ids; then it starts anew.
REMEMBERED_WORDS = 200_000
#: A longer word is encoded each time.
LONGEST_REMEMBERED = 64
#: Words of a batch that are encoded at a time; one longer text is taken alone.
WORDS_AT_A_TIME = 500_000


def bpe_encode(df: DataFrame, text: str, vocab: Sequence[str], merges: Sequence[tuple[str, str]],
               keep: Sequence[str] = ("id",), unk_token: str = "[UNK]") -> DataFrame:
    """K5: text → token ids (unknown symbols → [UNK]). Words are encoded in
    the partition that holds the row, so no token is shuffled; a task remembers
    a bounded number of words, looks each distinct word of some texts up once and
    puts the ids of all together as arrays. The merge list travels in the closure
    (bounded by the vocabulary). A null or empty text has no ids."""
    ranks = {tuple(m): i for i, m in enumerate(merges)}
    ids = {t: i for i, t in enumerate(vocab)}
    unk = ids[unk_token]
    keep = list(keep)
    base = df.select(*keep, word_tokens(text).alias("_w"))

    def run(batches):
        known: dict[str, list[int]] = {}

        def encoded(word):
            got = known.get(word)
            if got is None:
                got = [ids.get(s, unk) for s in merge_word(word, ranks)]
                if len(word) <= LONGEST_REMEMBERED:
                    if len(known) >= REMEMBERED_WORDS:
                        known.clear()
                    known[word] = got
            return got

        def of_texts(texts: pa.ListArray) -> pa.ListArray:
            n_words = texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            words = texts.flatten().dictionary_encode()
            each = [encoded(w) for w in words.dictionary.to_pylist()]
            n_ids = np.array([len(x) for x in each], dtype=np.int64)
            all_ids = np.fromiter(chain.from_iterable(each), dtype=np.int32, count=int(n_ids.sum()))
            place = words.indices.to_numpy(zero_copy_only=False)
            n = n_ids[place]
            ends = np.append(0, np.cumsum(n))
            # every word takes its stretch of ``all_ids``
            at = np.arange(ends[-1]) + np.repeat((np.cumsum(n_ids) - n_ids)[place] - ends[:-1], n)
            cuts = ends[np.append(0, np.cumsum(n_words))]
            return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(all_ids[at]))

        for batch in batches:
            held = np.append(0, np.cumsum(batch.column("_w").value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)))
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(held, held[lo] + WORDS_AT_A_TIME, side="right")) - 1)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), of_texts(part.column("_w"))], names=[*keep, "ids"])
                lo = hi

    fields = [f for f in base.schema.fields if f.name in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    return base.mapInArrow(run, T.StructType(fields))


# ------------------------------------------------------------------ K6, K7

def length_stats(df: DataFrame, n_tokens: str, limit: int, by: Sequence[str] = ("split",)) -> DataFrame:
    """K6: min / mean / max / exact percentiles / share above the limit."""
    n = F.col(n_tokens)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min(n).cast("long").alias("min_tokens"),
        F.avg(n).alias("mean_tokens"), F.max(n).cast("long").alias("max_tokens"),
        F.percentile(n, 0.5).alias("p50"), F.percentile(n, 0.9).alias("p90"), F.percentile(n, 0.99).alias("p99"),
        F.avg(F.when(n > limit, 1.0).otherwise(0.0)).alias("share_over"))


def truncate_tokens(tokens: Column, n: int) -> Column:
    """K7: keep the first n tokens."""
    return F.slice(tokens, 1, n)


# ------------------------------------------------------------------ K8

def pack(df: DataFrame, n_tokens: str, max_length: int, order_by: Sequence[str], eos: int = 1) -> DataFrame:
    """K8: concatenate examples in order (each followed by ``eos`` end
    tokens) and cut into blocks of ``max_length``. Running token offsets come
    from the distributed numbering (no single-partition window); every
    example is exploded into the blocks it crosses, so a block only needs its
    own rows. Output: (block_id, n_tokens, n_examples)."""
    sized = df.select(*order_by, (F.col(n_tokens) + F.lit(eos)).cast("long").alias("_len"))
    num = number_within(sized, list(order_by), sums=["_len"])
    end = F.col("cum__len")
    start = end - F.col("_len")
    blocks = F.sequence(F.floor(start / max_length).cast("long"), F.floor((end - 1) / max_length).cast("long"))
    ex = num.where(F.col("_len") > 0).select(start.alias("s"), end.alias("e"), F.explode_outer(blocks).alias("block_id")) \
        .where(F.col("block_id").isNotNull())
    part = F.least(F.col("e"), (F.col("block_id") + 1) * max_length) - F.greatest(F.col("s"), F.col("block_id") * max_length)
    return ex.groupBy("block_id").agg(F.sum(part).cast("long").alias("n_tokens"),
                                      F.count(F.lit(1)).alias("n_examples"))


def pack_blocks(df: DataFrame, tokens: str, max_length: int, order_by: Sequence[str], end) -> DataFrame:
    """K8 as data: token arrays in order, each followed by the token ``end``,
    cut into blocks of ``max_length``. Output: ``block_id, tokens, examples``;
    examples has, by place, the order columns of every example in the block and
    the places [start, stop) of the block that it takes; only the last block
    may be shorter. ``order_by`` must identify a row. A null array counts as an
    empty one (its end token stays); an empty table gives no blocks.

    Offsets come from the distributed numbering of (order columns, length); the
    arrays are shuffled once to meet them and cut there, and once, as pieces,
    to their blocks, whose size is bounded by ``max_length``."""
    order_by = list(order_by)
    element = df.schema[tokens].dataType.elementType
    ended = F.concat(F.coalesce(F.col(tokens), F.array().cast(T.ArrayType(element))), F.array(F.lit(end).cast(element)))
    rows = df.select(*order_by, ended.alias("_tokens"))
    placed = number_within(rows.select(*order_by, F.size("_tokens").cast("long").alias("_len")), order_by, sums=["_len"])
    placed = placed.select(*[F.col(c).alias(f"_o_{c}") for c in order_by], (F.col("cum__len") - F.col("_len")).alias("_from"))
    same = F.lit(True)
    for c in order_by:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    both = rows.join(placed, same)
    first, last = F.floor(F.col("_from") / max_length), F.floor((F.col("_from") + F.size("_tokens") - 1) / max_length)
    cut = both.select(*order_by, "_from", "_tokens", F.explode(F.sequence(first, last)).alias("block_id"))
    lo = F.greatest(F.col("_from"), F.col("block_id") * max_length)
    hi = F.least(F.col("_from") + F.size("_tokens"), (F.col("block_id") + 1) * max_length)
    piece = F.struct((lo - F.col("block_id") * max_length).cast("int").alias("start"), (hi - F.col("block_id") * max_length).cast("int").alias("stop"),
                     *order_by, F.slice("_tokens", (lo - F.col("_from") + 1).cast("int"), (hi - lo).cast("int")).alias("tokens"))
    blocks = cut.select("block_id", piece.alias("p")).groupBy("block_id").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return blocks.select("block_id", F.flatten(F.col("p.tokens")).alias("tokens"),
                         F.transform("p", lambda x: F.struct(*[x[c].alias(c) for c in order_by], x["start"].alias("start"), x["stop"].alias("stop"))).alias("examples"))

"""Near duplicates by HyperMinHash.

A document's set is that of its distinct word shingles, each a 64-bit hash.
The first bits of a hash choose one of 128 buckets; of the smallest hash in a
bucket the sketch keeps the number of leading zeros and the ten bits after
them (the mantissa), 16 bits in all. Empty buckets of short documents borrow
from another bucket in a fixed random order. Four registers make a band; two
documents that agree in a band are candidates. Candidates pass a Jaccard
estimate from two mantissa bits of each register, corrected for registers that
agree by chance, and are then verified on their full sets.

Documents with equal sets are one class first, so thousands of copies are one
row from there on. Links are found in two steps. First every member of a band
key is compared with the key's smallest member only, and the verified links
give components. Then, among keys that still hold several components, members
of different components are compared in blocks of bounded size, so a link
between different texts is not lost, while no key lists its pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import few, saved, text_or_empty
from .components import connected_components

BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
REST = 64 - BUCKET_BITS
MANTISSA = 10
ROWS = 4
BANDS = BUCKETS // ROWS
#: Ids of documents that are fetched by a broadcast; more go through a shuffle.
BROADCAST_IDS = 1_000_000
#: Words that a task remembers with their hash.
REMEMBER = 100_000
#: Shingles and members of a block of a key, about; a task compares two blocks.
BLOCK_SHINGLES, BLOCK_MEMBERS = 250_000, 512
#: Members of a part of a large key, rows of a group of small keys, and members
#: that are compared with those after them at once, by their short registers.
PART_MEMBERS, GROUP_ROWS, STRIPE = 2048, 8192, 128
#: Characters of text that a task works on at once.
CHUNK = 2_000_000

_U = np.uint64
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                         0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=_U)
_PROBES = np.vstack([np.random.default_rng(97 + b).permutation(BUCKETS) for b in range(BUCKETS)])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Words(dict):
    """Word (bytes) -> 64-bit hash."""

    def __missing__(self, w: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(w)
        if len(self) < REMEMBER:
            self[w] = h
        return h


def shingle_sets(texts: list[str | None], size: int, words: _Words | None = None) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every whole text; A-Z count as a-z,
    fewer words than ``size`` make one shingle, none an empty set."""
    words = _Words() if words is None else words
    split = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    n = np.array([len(w) for w in split])
    flat = np.fromiter((words[w] for ws in split for w in ws), dtype=_U, count=int(n.sum()))
    whole = np.zeros(max(0, len(flat) - size + 1), dtype=_U)
    for k in range(size):
        whole += flat[k:len(flat) - size + 1 + k] * _MULTIPLIERS[k]
    whole = _mix(whole)
    out, at = [], 0
    for k in n.tolist():
        if k >= size:
            out.append(np.unique(whole[at:at + k - size + 1]))
        elif k:
            out.append(_mix((flat[at:at + k] * _MULTIPLIERS[:k]).sum(keepdims=True, dtype=_U) + _U(k)))
        else:
            out.append(np.zeros(0, dtype=_U))
        at += k
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """[document, bucket] 16-bit registers: leading zeros and mantissa of the
    smallest hash of the bucket; empty buckets borrow. Sets must not be empty."""
    starts = np.arange(BUCKETS, dtype=_U) << _U(REST)
    low = np.zeros((len(sets), BUCKETS), dtype=_U)
    filled = np.zeros((len(sets), BUCKETS), dtype=bool)
    for d, s in enumerate(sets):
        at = np.searchsorted(s, starts)
        value = s[np.minimum(at, len(s) - 1)]
        filled[d] = (at < len(s)) & (value >> _U(REST) == np.arange(BUCKETS, dtype=_U))
        low[d] = value & _U((1 << REST) - 1)
    exponent = np.maximum(np.frexp(low.astype(np.float64))[1] - 1, 0)
    zeros = REST - exponent
    mantissa = ((low << (_U(REST) - exponent.astype(_U))) >> _U(REST - MANTISSA)) & _U((1 << MANTISSA) - 1)
    reg = ((zeros.astype(_U) << _U(MANTISSA)) | mantissa).astype(np.uint16)
    for d in np.flatnonzero(~filled.all(axis=1)):
        source = _PROBES[np.arange(BUCKETS), filled[d][_PROBES].argmax(axis=1)]
        reg[d] = np.where(filled[d], reg[d], reg[d][source])
    return reg


def band_keys(reg: np.ndarray) -> np.ndarray:
    """[document, band] 64-bit keys; bands do not share keys."""
    packed = np.ascontiguousarray(reg).view(_U).reshape(len(reg), BANDS)
    return _mix(packed + np.arange(1, BANDS + 1, dtype=_U) * _MULTIPLIERS[0]).view(np.int64)


def short_registers(reg: np.ndarray) -> list[np.ndarray]:
    """Two mantissa bits of each register as four 64-bit columns: the low
    bits of all registers in two, the next bits in two."""
    bits = [np.packbits((reg >> k & 1).astype(np.uint8), axis=1).view(np.int64) for k in (0, 1)]
    return [bits[0][:, 0], bits[0][:, 1], bits[1][:, 0], bits[1][:, 1]]


def least_agreeing(similarity: float) -> int:
    """Registers whose short form must agree. Of unlike ones a quarter agrees
    by chance, so J is estimated as (4p - 1) / 3 from the share p that agrees;
    the bound lies seven standard deviations below what ``similarity`` gives."""
    p = similarity + (1 - similarity) / 4
    return int(BUCKETS * p - 7 * math.sqrt(BUCKETS * p * (1 - p)))


def _chunks(batch):
    """(first row, texts) of slices of about ``CHUNK`` characters."""
    column = batch.column("text")
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    lo, base = 0, 0
    while lo < len(column):
        hi = min(len(column), int(np.searchsorted(ends, base + CHUNK)) + 1)
        yield lo, column.slice(lo, hi - lo).to_pylist()
        lo, base = hi, int(ends[hi - 1])


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


SKETCH = "doc_id long, set_hash binary, n_shingles long, bands array<long>, l0 long, l1 long, h0 long, h1 long"


def _sketch(size: int):
    def run(batches):
        words = _Words()
        for batch in batches:
            for lo, texts in _chunks(batch):
                sets = shingle_sets(texts, size, words)
                some = [i for i, s in enumerate(sets) if len(s)]
                bands, short = np.zeros((len(sets), 0), np.int64), [np.zeros(len(sets), np.int64) for _ in range(4)]
                rows = [np.zeros(0, np.int64)] * len(sets)
                if some:
                    reg = registers([sets[i] for i in some])
                    bands = band_keys(reg)
                    for i, b in zip(some, bands):
                        rows[i] = b
                    for col, got in zip(short, short_registers(reg)):
                        col[some] = got
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, len(texts)), pa.array([_digest(s) for s in sets], type=pa.binary()),
                    pa.array([len(s) for s in sets], type=pa.int64()), _lists(rows), *[pa.array(c) for c in short],
                ], names=["doc_id", "set_hash", "n_shingles", "bands", "l0", "l1", "h0", "h1"])
            if len(words) >= REMEMBER:
                words = _Words()

    return run


def _full_sets(size: int):
    def run(batches):
        words = _Words()
        for batch in batches:
            for _, texts in _chunks(batch):
                sets = shingle_sets(texts, size, words)
                yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for s in sets], type=pa.binary()), _lists(sets)], names=["set_hash", "shingles"])

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))


def _alike(x: str, y: str, percent: int) -> Column:
    """Sizes allow the similarity, and the short registers make it likely.
    ``x`` and ``y`` are what stands before the two sides' column names."""
    n = [F.col(f"{s}n_shingles") for s in (x, y)]
    differ = F.lit(0)
    for k in "01":
        differ = differ + F.bit_count(F.col(f"{x}l{k}").bitwiseXOR(F.col(f"{y}l{k}")).bitwiseOR(F.col(f"{x}h{k}").bitwiseXOR(F.col(f"{y}h{k}"))))
    return (F.least(*n) * 100 >= F.greatest(*n) * percent) & (F.lit(BUCKETS) - differ >= least_agreeing(percent / 100))


def _sets_of(nodes: DataFrame, classes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(node, shingles): the full sets of some classes, from their texts, which
    are read again. Their ids are broadcast if they are few, else joined."""
    wanted = saved(classes.select("node", "set_hash", "min_id").join(nodes.select("node").distinct(), "node"), "near_wanted")
    ids = wanted.select(F.col("min_id").alias("_id")).distinct()
    chosen = texts.join(few(ids, BROADCAST_IDS), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    sets = chosen.mapInArrow(_full_sets(size), "set_hash binary, shingles array<long>")
    return saved(wanted.join(sets, "set_hash").dropDuplicates(["node"]).select("node", "shingles"), "near_sets")


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of class nodes whose full sets are similar."""
    pairs = saved(pairs.select("a", "b").distinct(), "near_pairs")
    sets = _sets_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), classes, texts, size)
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", common.alias("i"), (F.size("sa") + F.size("sb")).alias("n"))
    return both.where(F.col("i") * 100 >= (F.col("n") - F.col("i")) * percent).select("a", "b")


def _common(flat: np.ndarray, of: np.ndarray, m: int) -> np.ndarray:
    """[set, set] sizes of intersections, by matrix products over slices of
    the shingles that two sets or more hold."""
    _, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[inverse] > 1
    column = (np.cumsum(count > 1) - 1)[inverse[shared]]
    row, order = of[shared], np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((m, m), dtype=np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 1024):
        start, end = np.searchsorted(column, [lo, lo + 1024])
        held = np.zeros((m, 1024), dtype=np.float32)
        held[row[start:end], column[start:end] - lo] = 1
        out += held @ held.T
    return out


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links (a, b) to keep so that they join the same nodes
    without a circle: union-find in the order given."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    keep = np.zeros(len(a), dtype=bool)
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = top(x), top(y)
        if x != y:
            root[x] = y
            keep[i] = True
    return keep


def _links(percent: int):
    """Links between members of different components in one pair of blocks of
    a key: a spanning forest of the components, fewer links than members."""
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        node, comp, block = (group.column(c).to_numpy() for c in ("node", "comp", "block"))
        lists = group.column("shingles").combine_chunks()
        n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.float32)
        both = _common(lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(n)), n.astype(np.int64)), len(n))
        crossed = group.column("lo")[0].as_py() != group.column("hi")[0].as_py()
        found_a, found_b = [], []
        for lo in range(0, len(n), STRIPE):  # a few rows of the matrix at once
            rows = slice(lo, lo + STRIPE)
            linked = both[rows] * 100 >= (n[rows, None] + n[None, :] - both[rows]) * percent
            linked &= (comp[rows, None] != comp[None, :]) & (node[rows, None] > node[None, :])
            if crossed:
                linked &= block[rows, None] != block[None, :]
            a, b = np.nonzero(linked)
            found_a.append(a + lo)
            found_b.append(b)
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        keep = _forest(comp[a], comp[b])
        return pa.table({"a": node[a[keep]], "b": node[b[keep]]})

    return run


def _likely(percent: int):
    """Members of a group of keys that the estimate likes together with a
    member of another component."""
    least = least_agreeing(percent / 100)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("key").combine_chunks()
        key, comp, n, part = (group.column(c).to_numpy() for c in ("key", "comp", "n_shingles", "part"))
        low = [group.column(c).to_numpy().view(_U) for c in ("l0", "l1")]
        high = [group.column(c).to_numpy().view(_U) for c in ("h0", "h1")]
        crossed = group.column("lo")[0].as_py() != group.column("hi")[0].as_py()
        end, stay = np.searchsorted(key, key, side="right"), np.zeros(len(key), dtype=bool)
        for lo in range(0, len(key), STRIPE):
            hi = min(lo + STRIPE, len(key))
            last = int(end[hi - 1])
            x, y = (slice(lo, hi), None), (None, slice(lo, last))
            ok = (key[x] == key[y]) & (comp[x] != comp[y])
            ok &= np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * percent
            if crossed:
                ok &= part[x] != part[y]
            if not ok.any():
                continue
            differ = sum(np.bitwise_count((p[x] ^ p[y]) | (q[x] ^ q[y])) for p, q in zip(low, high))
            ok &= BUCKETS - differ.astype(np.int64) >= least
            stay[lo:hi] |= ok.any(axis=1)
            stay[lo:last] |= ok.any(axis=0)
        return group.filter(pa.array(stay)).select(["key", "node", "comp", "n_shingles"])

    return run


def _dealt(rest: DataFrame) -> DataFrame:
    """Rows of keys with the group that compares them: keys that fit share a
    group by a hash; a larger key is cut in parts by a hash of the member, and
    every pair of parts is a group (own, lo, hi)."""
    groups = max(1, -(-rest.count() // GROUP_ROWS))
    large = saved(rest.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > PART_MEMBERS)
                  .select(F.col("key").alias("large_key"), F.ceil(F.col("held") / PART_MEMBERS).alias("parts")), "near_large")
    rows = rest.join(large, F.col("key") == F.col("large_key"), "left")
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), parts))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda k: F.struct(F.least("part", k).alias("lo"), F.greatest("part", k).alias("hi")))
    own = F.when(parts > 1, F.struct(F.lit(1).alias("large"), F.col("key").alias("k"))).otherwise(F.struct(F.lit(0).alias("large"), F.pmod(F.xxhash64("key"), F.lit(groups)).alias("k")))
    return rows.select(*rest.columns, "part", own.alias("own"), F.explode(pairs).alias("p")).select(*rest.columns, "part", "own.large", "own.k", "p.lo", "p.hi")


def _links_across(rest: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between members of one key that are in different
    components. ``rest`` has a row for each key that holds several components
    and each of its members.

    A member stays if the estimate likes any member of another component; keys
    are dealt to groups of bounded size for that, a large one to pairs of its
    parts, and a row per member leaves them, not per pair. Those that stay are
    compared on their full sets in blocks of bounded size, in the same way;
    only links leave them, fewer than members."""
    stay = saved(_dealt(rest).groupBy("large", "k", "lo", "hi").applyInArrow(_likely(percent), "key long, node long, comp long, n_shingles long").distinct(), "near_stay")
    sets = _sets_of(stay, classes, texts, size)
    sizes = stay.groupBy("key").agg(F.greatest(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS)).alias("blocks"))
    dealt = stay.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("lo"), F.greatest("block", j).alias("hi")))
    dealt = dealt.select("key", "node", "comp", "block", F.explode(pairs).alias("p")).select("key", "node", "comp", "block", "p.lo", "p.hi")
    return dealt.join(sets, "node").groupBy("key", "lo", "hi").applyInArrow(_links(percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``; cases
    as in ``components_of_rows``, which also has the hash of the row's set."""
    return components_of_rows(docs, shingle_words, percent, id_col, text_col).drop("set_hash")


def components_of_rows(docs: DataFrame, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, set_hash, component_id, kept``.

    Two documents are linked if 100 * |common shingles| >= percent * |all
    shingles|; component_id is the smallest id that links reach (itself
    included), kept says that it is the document's own. A document without
    words has an empty set and is linked with nothing. Repeated rows get the
    same component; null ids count only where a component has no other (then
    component_id is null and kept). An empty table gives no rows; other
    columns are not read.

    A link at the similarity bound is missed if no band agrees: chance
    (1 - J^4)^32, 6e-11 at 0.85 and 5e-8 at 0.8.
    """
    texts = _texts(docs, id_col, text_col)
    sketch = saved(texts.mapInArrow(_sketch(shingle_words), SKETCH), "near_sketch")
    classes = saved(
        sketch.where("n_shingles > 0").groupBy("set_hash").agg(
            F.min("doc_id").alias("min_id"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("bands").alias("bands"),
            *[F.any_value(c).alias(c) for c in ("l0", "l1", "h0", "h1")]).withColumn("node", F.monotonically_increasing_id()), "near_classes")
    facts = classes.select("node", "n_shingles", "l0", "l1", "h0", "h1")
    keys = classes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "first")
    members = saved(keys.join(shared, "key"), "near_members")

    # step 1: every member against the smallest of its key
    star = members.where("node > first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    likely = star.join(facts.alias("x"), star["a"] == F.col("x.node")).join(facts.alias("y"), star["b"] == F.col("y.node")).where(_alike("x.", "y.", percent))
    likely = saved(likely.select("a", "b"), "near_likely")
    # one link of each member first, then those whose ends are still apart
    first = saved(_verified(likely.groupBy("a").agg(F.min("b").alias("b")), classes, texts, shingle_words, percent), "near_links")
    joined = connected_components(first)
    side = lambda c: joined.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
    apart = likely.join(side("a"), "a", "left").join(side("b"), "b", "left").where(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select("a", "b")
    links = saved(first.union(_verified(apart, classes, texts, shingle_words, percent)), "near_links")
    found = connected_components(links)

    # step 2: keys that hold several components
    labelled = saved(members.join(found, "node", "left").select("key", "node", F.coalesce("label", "node").alias("comp")), "near_labelled")
    open_keys = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    rest = saved(labelled.join(open_keys, "key").join(facts, "node"), "near_rest")
    more = saved(_links_across(rest, classes, texts, shingle_words, percent), "near_links")
    final = connected_components(links.union(more))

    named = classes.select("node", "set_hash", "min_id").join(final, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("min_id").alias("component_id"))
    by_set = named.join(smallest, "label").select("set_hash", "component_id")
    rows = sketch.select("doc_id", "set_hash", "n_shingles").join(by_set, "set_hash", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", "set_hash", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _with_set_hash(at: int, size: int):
    """Rows as they are and the hash of the set of column ``at``."""
    def run(batches):
        words = _Words()
        for batch in batches:
            only_text = pa.RecordBatch.from_arrays([batch.column(at)], names=["text"])
            for lo, texts in _chunks(only_text):
                hashes = pa.array([_digest(s) for s in shingle_sets(texts, size, words)], type=pa.binary())
                part = batch.slice(lo, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, hashes], names=[*batch.schema.names, "_near_set"])

    return run


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document stays, with their columns as they are.

    Of rows with one id and one set one stays; rows that share an id (or have
    none) and hold different texts are decided text by text. Null, empty and
    blank texts are linked with nothing, so each id of them stays. An empty
    table gives no rows. Only rows of shared ids are shuffled."""
    rows = saved(components_of_rows(docs, shingle_words, percent, id_col, text_col).select(F.col("doc_id").alias("_near_id"), F.col("set_hash").alias("_near_hash"), "kept"), "near_kept")
    ids = saved(rows.groupBy("_near_id").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept")).where("kept or n > 1"), "near_ids")
    own = docs[id_col].cast("long").eqNullSafe(F.col("_near_id"))
    once = docs.join(few(ids.where("n = 1 and kept").select("_near_id"), BROADCAST_IDS), own, "left_semi")
    shared = ids.where("n > 1").select("_near_id")
    if not shared.limit(1).count():
        return once
    names = docs.columns
    several = docs.join(few(shared, BROADCAST_IDS), own, "left_semi")
    hashed = several.mapInArrow(_with_set_hash(names.index(text_col), shingle_words), T.StructType([*docs.schema.fields, T.StructField("_near_set", T.BinaryType())]))
    kept = rows.where("kept").select("_near_id", "_near_hash").distinct()
    stay = hashed.join(kept, hashed[id_col].cast("long").eqNullSafe(F.col("_near_id")) & (F.col("_near_set") == F.col("_near_hash")), "left_semi")
    return once.unionByName(stay.dropDuplicates([id_col, "_near_set"]).select(*[F.col(f"`{c}`") for c in names]))

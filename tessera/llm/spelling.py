"""Spelling variants: near words by blocked Gram matrices of letter counts.

Two words are near if one inserted, deleted or replaced code point makes them
equal. Their letter counts then differ by a squared distance of at most two,
which matrix products of blocks of count vectors give for all pairs of a block
at once; pairs within that distance are verified letter by letter.

A block holds words of two adjacent lengths, m and m + 1, that share the first
m div 2 code points or the last m - m div 2 of them: one edit leaves one of the
two halves of the shorter word as it is, so every near pair meets in a block.
Blocks are packed into groups of bounded size; one with more words than fit is
dealt to pairs of its parts, each a group of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, text_or_empty

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Letters are counted by the last five bits of their code point; letters that
#: share a count can only bring words nearer.
DIMENSIONS = 32
#: Rows of a group, and words of a part of a large block, about.
GROUP_ROWS, PART_WORDS = 8192, 2048
#: Rows of a block that are multiplied with the rows after them at once.
STRIPE = 128
#: Words that a task counts before it gives its counts away.
COUNTED = 300_000
#: Longest word of a group that is compared in padded arrays.
PADDED = 48


def _counted(least_length: int, changed):
    """Partial (word, n) of the texts of a task."""
    def run(batches):
        counts: Counter = Counter()

        def out():
            got = pa.RecordBatch.from_arrays([pa.array(list(counts), type=pa.string()), pa.array(list(counts.values()), type=pa.int64())], names=["word", "n"])
            counts.clear()
            return got

        for batch in batches:
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                for word, n in Counter(RUN.findall(data.lower().decode("utf-8", "surrogatepass"))).items():  # bytes: A-Z only
                    if len(word) >= least_length:
                        word = changed(doc_id, word) if changed else word
                        if len(word) >= least_length:
                            counts[word] += n
                if len(counts) >= COUNTED:
                    yield out()
        yield out()

    return run


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3, changed=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of whole texts, lower-cased (A-Z), with their counts
    over all documents. ``changed(doc_id, word)`` may rewrite a word before it
    is counted. Tasks count first, so a frequent word is one row of each."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    parts = rows.mapInArrow(_counted(least_length, changed), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _blocks_of(word: str) -> list[tuple[int, int]]:
    """(key, shorter length) of the word's blocks: first and last half of its
    own length as the shorter one, and of the length before it. The lowest bit
    of a key says which half."""
    out = []
    for m in (len(word), len(word) - 1):
        half = m // 2
        for side, part in ((0, word[:half]), (1, word[len(word) - (m - half):])):
            h = xxhash.xxh3_64_intdigest(f"{m}:{side}:{part}".encode())
            out.append(((h >> 2) * 2 + side, m))
    return out


def _keyed(batches):
    for batch in batches:
        words, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
        rows = [(key, m, w, n) for w, n in zip(words, counts) for key, m in _blocks_of(w)]
        cols = list(zip(*rows)) if rows else [()] * 4
        types = [pa.int64(), pa.int32(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types)], names=["key", "shorter", "word", "n"])


def one_edit(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _verified(words: list[str], padded: np.ndarray | None, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs are near, with words[i] no longer than words[j]."""
    if padded is None:
        return np.array([one_edit(words[x], words[y]) for x, y in zip(i.tolist(), j.tolist())], dtype=bool)
    a, b, n = padded[i], padded[j], size[i]
    differ = a != b
    same = size[i] == size[j]
    out = same & (differ.sum(axis=1) == 1)
    # inserted: equal up to a place, and from there on the longer one shifted
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    column = np.arange(a.shape[1] - 1)
    shifted = a[:, :-1] != b[:, 1:]
    wrong = (shifted & (column >= first[:, None]) & (column < n[:, None])).any(axis=1)
    return out | (~same & ~wrong)


def near_in_group(key: np.ndarray, shorter: np.ndarray, words: list[str], part: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the near pairs that share a block, rows sorted by key. A pair
    counts in its first-half block, and in its last-half block only if its
    first halves differ, so it is found once; with ``part`` only pairs of
    different parts count."""
    none = np.zeros(0, dtype=np.int64)
    m = len(words)
    size = np.array([len(w) for w in words])
    if m < 2:
        return none, none
    widest = int(size.max())
    points = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    of = np.repeat(np.arange(m), size)
    exact = np.float32 if widest <= 1000 else np.float64
    vectors = np.bincount(of * DIMENSIONS + (points & (DIMENSIONS - 1)), minlength=m * DIMENSIONS).reshape(m, DIMENSIONS).astype(exact)
    square = (vectors * vectors).sum(axis=1)
    padded = None
    if widest <= PADDED:
        padded = np.zeros((m, widest + 1), dtype=np.uint8)
        padded[of, np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)] = points
    end = np.searchsorted(key, key, side="right")
    found_i, found_j = [none], [none]
    for lo in range(0, m - 1, STRIPE):
        hi = min(lo + STRIPE, m)
        last = int(end[hi - 1])
        distance = square[lo:hi, None] + square[None, lo:last] - 2 * (vectors[lo:hi] @ vectors[lo:last].T)
        close = (distance <= 2) & (key[lo:hi, None] == key[None, lo:last])
        i, j = np.nonzero(close)
        i, j = i + lo, j + lo
        right = (i < j) & (np.minimum(size[i], size[j]) == shorter[i]) & (shorter[i] == shorter[j])
        if part is not None:
            right &= part[i] != part[j]
        i, j = i[right], j[right]
        swap = size[i] > size[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        near = _verified(words, padded, size, i, j)
        i, j = i[near], j[near]
        once = np.array([key[x] % 2 == 0 or words[x][:shorter[x] // 2] != words[y][:shorter[x] // 2] for x, y in zip(i.tolist(), j.tolist())], dtype=bool)
        found_i.append(i[once])
        found_j.append(j[once])
    return np.concatenate(found_i), np.concatenate(found_j)


def _near(group: pa.Table) -> pa.Table:
    group = group.sort_by("key").combine_chunks()
    words, n = group.column("word").to_pylist(), group.column("n").to_numpy()
    crossed = group.column("lo")[0].as_py() != group.column("hi")[0].as_py()
    i, j = near_in_group(group.column("key").to_numpy(), group.column("shorter").to_numpy(), words, group.column("part").to_numpy() if crossed else None)
    both_i, both_j = np.concatenate([i, j]), np.concatenate([j, i])
    return pa.table({"word": pa.array([words[x] for x in both_i.tolist()], type=pa.string()),
                     "near": pa.array([words[x] for x in both_j.tolist()], type=pa.string()), "near_n": pa.array(n[both_j])})


def near_words(vocab: DataFrame) -> DataFrame:
    """(word, near, near_n) for every near pair of ``vocab`` (word, n), in both
    directions, each once. Words are of letters up to U+00FF."""
    keyed = saved(vocab.select("word", "n").mapInArrow(_keyed, "key long, shorter int, word string, n long"), "spelling_keys")
    groups = max(1, -(-keyed.count() // GROUP_ROWS))
    large = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > PART_WORDS) \
        .select(F.col("key").alias("large_key"), F.ceil(F.col("held") / PART_WORDS).alias("parts"))
    large = saved(large, "spelling_large")
    rows = keyed.join(large, F.col("key") == F.col("large_key"), "left")
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("word"), F.col("parts"))).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("part", part)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1), lambda k: F.struct(F.least("part", k).alias("lo"), F.greatest("part", k).alias("hi")))
    # a block that fits shares its group with others, a part pair has its own
    own = F.when(F.col("parts") > 1, F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(groups)) - groups)
    dealt = rows.select("key", "shorter", "word", "n", "part", own.alias("own"), F.explode(pairs).alias("p"))
    return dealt.select("key", "shorter", "word", "n", "part", "own", "p.lo", "p.hi").groupBy("own", "lo", "hi").applyInArrow(_near, "word string, near string, near_n long")


def variants(vocab: DataFrame, ratio: int = 2) -> DataFrame:
    """One row per word of ``vocab`` (word, n; words distinct): ``word, form,
    root, n, n_near, form_n``.

    ``form`` is the near word of largest n (ties: the smallest in code-point
    order) if that is at least ``ratio`` (two or more) times the word's own,
    else null, as is form_n; ``root`` is the word that forms lead to. n grows
    from form to form, so there is no circle, and jumps double the distance. An
    empty vocabulary gives no rows.
    """
    near = saved(near_words(vocab), "spelling_near")
    # largest n first, then the smallest word: two aggregates, both with partial sums
    top = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.max("near_n").alias("top_n"))
    tied = near.join(top.select(F.col("word").alias("w"), "top_n"), (F.col("word") == F.col("w")) & (F.col("near_n") == F.col("top_n")))
    first = tied.groupBy("word").agg(F.min("near").alias("top"))
    all_rows = vocab.join(top, "word", "left").join(first, "word", "left")
    large = F.col("top_n") >= ratio * F.col("n")
    rows = saved(all_rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(large, F.col("top")).alias("form"), F.when(large, F.col("top_n")).alias("form_n")), "spelling_forms")
    # only words with a form move
    step = saved(rows.where("form is not null").select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("far"))
        new = saved(step.join(ahead, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "spelling_roots")
        step = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            break
    return rows.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def with_lost_letter(doc_id: int | None, word: str) -> str:
    """The word without code point h % length if 97 divides h = crc32 of
    ``<doc_id>:<word>``; the id of a null is empty."""
    data = word.encode()
    h = zlib.crc32(data, zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id))
    if h % 97:
        return word
    i = h % len(word)
    return word[:i] + word[i + 1:]


def spelling_variants(docs: DataFrame, changed=None, **options) -> DataFrame:
    """Variants of the words of all documents (see ``vocabulary``, ``variants``).

    Words are runs of letters A-Z, a-z and U+00C0 to U+00FF of the whole text;
    texts without one (null, empty, blank) add nothing; every row counts, also
    repeated ones and those with a null id. Very long words are compared like
    others. An empty table gives no rows; other columns are not read.
    """
    vocab = saved(vocabulary(docs, changed=changed, **options), "spelling_words")
    return variants(vocab)

"""Language-model scores: a log-bilinear model trained with noise contrast.

The words are counted over all training documents. The most frequent ones and
an end token are classes of their own, all others one class; a word of that
class has the add-one share of its count in it, so the model gives every text
a normalised probability. The model is log-bilinear in the previous token,
``score(w | h) = (C r_h) . q_w + b_w``. Its training set are the pairs of
neighbouring classes of the whole corpus, counted by Spark; whole passes over
all counted pairs, weighted by their counts, train it in numpy by
noise-contrastive estimation with unigram noise. One matrix product of all
contexts with all words then gives the normalised log-probabilities that the
scoring tasks look up.

Bounded: classes (``CLASSES``, so pairs are at most its square) and the
dictionary of frequent words that tasks hold (``DICTIONARY``). Counts of all
other words are found by a join.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, text_or_empty

#: Words that are classes of the model.
CLASSES = 1024
#: Frequent words whose counts every scoring task holds.
DICTIONARY = 200_000
#: Words above that number that may be fetched because their counts are nearly one.
TIES = 50_000
#: Length of the vectors.
WIDTH = 24
#: Characters of text that a task works on at once, and words that it counts before it hands them on.
CHUNK, COUNTED = 8_000_000, 400_000
#: The end token in the table of counts (no word is empty).
END = ""


def training(id_col: Column, folds: int = 7, held: int = 2) -> Column:
    """True for documents that the model learns from; a null id counts as an empty one."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) != held


def _chunks(batch):
    texts = batch.column("text").to_pylist()
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield lo, texts[lo:i + 1]
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, texts[lo:]


def tokens(texts: list[str]) -> list[list[bytes]]:
    """Words of each whole text, A-Z as a-z."""
    return [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]


def _strings(words) -> pa.Array:
    return pa.array(words, type=pa.binary()).cast(pa.string())


def _count(batches):
    seen: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([_strings(list(seen)), pa.array(list(seen.values()), type=pa.int64())], names=["word", "n"])

    for batch in batches:
        for _, texts in _chunks(batch):
            seen.update(chain.from_iterable(tokens(texts)))
            seen[b""] += len(texts)
            if len(seen) > COUNTED:
                yield rows()
                seen.clear()
    if seen:
        yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all of ``docs``; tasks add up before the shuffle. The
    end token is the empty word."""
    return docs.select("text").mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def most_frequent(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """At most ``most`` words with the largest counts, in falling order.

    A histogram over sixteenth powers of two (some hundreds of rows) gives the
    count from which on words are fetched, so no task sends more than these.
    Where words of nearly one count would exceed the bound by over ``TIES``
    (as those that occur once do), they are left to the join altogether.
    """
    step = F.floor(F.log2("c") * 16)
    words = counts.where(F.col("word") != END)
    steps = sorted(((r["s"], r["n"]) for r in words.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    total, least = 0, None
    for s, n in steps:
        if total >= most or total + n > most + TIES:
            break
        total, least = total + n, s
    if least is None:
        return []
    table = words.where(step >= least).select("word", "c").toArrow()
    return sorted(zip(table["word"].to_pylist(), table["c"].to_pylist()), key=lambda x: (-x[1], x[0]))[:most]


class _Index(dict):
    """Word -> place in the dictionary, -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


def _places(split: list[list[bytes]], index: _Index) -> tuple[np.ndarray, np.ndarray]:
    """Place of every word, and of which text it is."""
    n = np.array([len(w) for w in split], dtype=np.int64)
    flat = np.fromiter(map(index.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(n.sum()))
    return flat, n


def _classes(flat: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Previous and own class of every token, ends included, and the tokens'
    counts by text. Classes: 0..k-1 words, k other words, k+1 end (also what
    stands before a text)."""
    own = np.full(len(flat) + len(n), k + 1, dtype=np.int64)
    stops = np.cumsum(n + 1) - 1
    inner = np.ones(len(own), dtype=bool)
    inner[stops] = False
    own[inner] = np.where((flat >= 0) & (flat < k), flat, k)
    return np.concatenate([[k + 1], own[:-1]])[:len(own)], own, n + 1


def _pairs(words: list[bytes]):
    k = len(words)
    size = k + 2

    def run(batches):
        index = _Index((w, i) for i, w in enumerate(words))
        cells = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            for _, texts in _chunks(batch):
                before, own, _ = _classes(*_places(tokens(texts), index), k)
                cells += np.bincount(before * size + own, minlength=size * size)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[at])], names=["cell", "n"])

    return run


def _sums(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Rows added up by their index."""
    return np.stack([np.bincount(at, weights=x, minlength=size) for x in rows.T], axis=1)


def shares(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, weight) of one pass: every cell with its whole count, in equal
    parts of at most the mean count; twice as many as cells at most."""
    parts = np.ceil(counts / counts.mean()).astype(np.int64).clip(1) if len(counts) else np.zeros(0, np.int64)
    return np.repeat(np.arange(len(counts)), parts), np.repeat(counts / np.maximum(parts, 1), parts)


def train(cells: np.ndarray, counts: np.ndarray, size: int, passes: int = 24, steps: int = 600, batch: int = 4096, noise: int = 128, k: float = 16.0,
          width: int = WIDTH, rate: float = 0.1, seed: int = 7) -> np.ndarray:
    """[context, word] table of log10 probabilities.

    Whole passes over all cells in random order, each weighted by its count:
    ``passes`` of them, or as many more as make up ``steps`` minibatches.
    Noise-contrastive estimation: every pair against ``k`` words of noise
    from the unigram law (add-one, so no word is impossible), carried by
    ``noise`` shared words per minibatch, so that scores are matrix products;
    Adagrad steps. Contexts that never occurred keep the unigram law nearly.
    """
    rng = np.random.default_rng(seed)
    own = np.bincount(cells % size, weights=counts, minlength=size) + 1.0
    unigram = own / own.sum()
    log_noise = np.log(k * unigram)
    r = rng.normal(0, 0.1, (size, width))
    q = rng.normal(0, 0.1, (size, width))
    c, b = np.eye(width), np.log(unigram)
    grads = [np.full(x.shape, 1e-3) for x in (r, q, c, b)]
    unigram_sum = np.cumsum(unigram)
    at, weight = shares(counts)
    weight /= weight.mean() if len(weight) else 1.0
    each = -(-len(at) // batch)  # minibatches of a pass
    for now in (x for _ in range(max(passes, -(-steps // each)) if each else 0) for x in np.array_split(rng.permutation(len(at)), each)):
        h, w, much = cells[at[now]] // size, cells[at[now]] % size, weight[now]
        v = np.searchsorted(unigram_sum, rng.random(noise), side="right").clip(0, size - 1)
        rh = r[h]
        x = rh @ c.T
        hit = much / (1 + np.exp(np.einsum("ij,ij->i", x, q[w]) + b[w] - log_noise[w]))  # 1 - P(from the data)
        miss = -(k / noise) * much[:, None] / (1 + np.exp(-(x @ q[v].T + (b[v] - log_noise[v])[None, :])))  # -P(from the data)
        dx = hit[:, None] * q[w] + miss @ q[v]
        dq = _sums(w, hit[:, None] * x, size) + _sums(v, miss.T @ x, size)
        db = np.bincount(w, weights=hit, minlength=size) + np.bincount(v, weights=miss.sum(axis=0), minlength=size)
        dr = _sums(h, dx @ c, size)
        for value, grad, total in ((r, dr, grads[0]), (q, dq, grads[1]), (c, dx.T @ rh, grads[2]), (b, db, grads[3])):
            grad /= len(now) ** 0.5
            total += grad * grad
            value += rate * grad / np.sqrt(total)
    logits = (r @ c.T) @ q.T + b[None, :]
    top = logits.max(axis=1, keepdims=True)
    return (logits - top - np.log(np.exp(logits - top).sum(axis=1, keepdims=True))) / np.log(10)


def _train(size: int):
    def run(batches):
        parts = list(batches)
        table = pd.concat(parts).sort_values("cell") if parts else pd.DataFrame({"cell": [], "n": []})
        out = train(table["cell"].to_numpy(np.int64), table["n"].to_numpy(np.float64), size)
        yield pd.DataFrame({"table": [out.astype("<f4").tobytes()]})

    return run


DOC = ("doc_id long, held_out boolean, n_tokens long, known long, base double, model double, other long, other_sum double, rare array<string>")


def _score(shared, k: int):
    """Per document what the dictionary and the model say, and the words that
    are in neither."""
    size = k + 2

    def run(batches):
        words, logc, end_logc, end_known, raw = shared.value
        index = _Index((w, i) for i, w in enumerate(words))
        table = np.frombuffer(raw, dtype="<f4").astype(np.float64)
        for batch in batches:
            for lo, texts in _chunks(batch):
                split = tokens(texts)
                flat, n = _places(split, index)
                before, own, m = _classes(flat, n, k)
                of_word, of_token = np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(n)), m)

                def per_text(of, x):
                    return np.bincount(of, weights=x, minlength=len(n)).astype(np.float64)  # noqa: B023

                seen = flat >= 0
                value = np.where(seen, logc[np.where(seen, flat, 0)] if len(logc) else 0.0, 0.0)
                rare = [[] for _ in range(len(n))]
                if not seen.all():
                    every = list(chain.from_iterable(split))
                    for i in np.flatnonzero(~seen).tolist():
                        rare[of_word[i]].append(every[i])
                other = ~(seen & (flat < k))
                ends = np.concatenate([[0], np.cumsum([len(x) for x in rare])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, len(texts)), batch.column("held_out").slice(lo, len(texts)), pa.array(m),
                    pa.array(per_text(of_word, seen).astype(np.int64) + end_known), pa.array(per_text(of_word, value) + end_logc),
                    pa.array(per_text(of_token, table[before * size + own])), pa.array(per_text(of_word, other).astype(np.int64)),
                    pa.array(per_text(of_word, np.where(other, value, 0.0))),
                    pa.ListArray.from_arrays(pa.array(ends), _strings(list(chain.from_iterable(rare)))),
                ], names=["doc_id", "held_out", "n_tokens", "known", "base", "model", "other", "other_sum", "rare"])

    return run


def score_documents(docs: DataFrame, classes: int = CLASSES, dictionary: int = DICTIONARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``.

    Tokens are the words and one end; a null or empty text is its end alone.
    base_score: log10 probability under add-one word counts of the training
    documents; score: under the model; both of the whole text. Repeated
    training rows count as often as they occur. Without training documents
    every count is 0. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (~training(F.col(id_col))).alias("held_out"), text_or_empty(F.col(text_col)).alias("text"))
    learn = rows.where(~F.col("held_out"))
    counts = saved(word_counts(learn), "lm_counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"),
                       F.coalesce(F.sum(F.when(F.col("word") == END, F.col("c"))), F.lit(0)).alias("e")).first()
    n, v, ends = int(total["n"]), int(total["v"]), int(total["e"])
    frequent = most_frequent(counts, dictionary)
    words = [w.encode("utf-8", "surrogatepass") for w, _ in frequent]
    logc = np.log10(np.array([c for _, c in frequent], dtype=np.float64) + 1)
    k = min(classes, len(words))
    others_n = n - ends - sum(c for _, c in frequent[:k])
    others_v = v - (ends > 0) - k

    pairs = saved(learn.select("text").mapInArrow(_pairs(words[:k]), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")), "lm_pairs")
    got = pairs.repartition(1).mapInPandas(_train(k + 2), "table binary").collect()  # at most (classes + 2)^2 cells
    table = got[0]["table"] if got else train(np.zeros(0, np.int64), np.zeros(0), k + 2).astype("<f4").tobytes()
    shared = spark.sparkContext.broadcast((words, logc, float(np.log10(ends + 1)), int(ends > 0), bytes(table)))

    first = saved(rows.mapInArrow(_score(shared, k), DOC).withColumn("row", F.monotonically_increasing_id()), "lm_rows")
    rare = first.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
    found = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rare_sum"), F.count("c").alias("rare_known"))
    both = first.drop("rare").join(found, "row", "left").na.fill({"rare_sum": 0.0, "rare_known": 0})
    base = F.col("base") + F.col("rare_sum") - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))
    score = F.col("model") + F.col("other_sum") + F.col("rare_sum") - F.col("other") * F.lit(float(np.log10(others_n + others_v + 1)))
    return both.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.col("rare_known")).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
                       base.alias("base_score"), score.alias("score"))

"""Quality classifier: ordinal regression on graded ratings.

A cumulative-link model (proportional odds) over hashed text features: one
weight vector ``w`` shared by all grades and ordered thresholds,
``P(grade > k) = sigmoid(w.x - t_k)``. A document gets its expected grade and
the tail probability of reaching the grade that is asked for.

The model is fitted in numpy on a bounded sample of rated documents, taken by
a hash of the id; it is a few megabytes and goes to the tasks that score all
documents, batch by batch.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, text_or_empty

BITS = 18
#: Rated documents that the model is fitted on, at most.
SAMPLE_ROWS = 20_000
GRADES = 3

_RUNS = re.compile(r"[^\W\d_]+")
_UPPER = bytes(range(65, 91))
_SYMBOLS = b"#*$%&|<>"
_MARKS = b"!?"


def features(text: str) -> np.ndarray:
    """Sorted distinct buckets of the whole text: its letter runs in lower
    case, the first five letters of the longer ones (compounds share them),
    and bins of a few shares (symbols, capitals, exclamation, distinct
    words), each a feature of its own."""
    runs = _RUNS.findall(text.lower())
    kinds = set(runs)
    heads = {"\x01" + k[:5] for k in kinds if len(k) > 5}
    raw = text.encode("utf-8", "replace")
    n = max(1, len(runs))

    def share(allowed: bytes, of: int) -> int:
        return _bin((len(raw) - len(raw.translate(None, allowed))) / of)

    shape = [f"\x00symbols{share(_SYMBOLS, n)}", f"\x00upper{share(_UPPER, max(1, len(raw)))}", f"\x00marks{share(_MARKS, n)}",
             f"\x00length{min(12, n.bit_length())}", f"\x00distinct{int(10 * len(kinds) / n)}x{min(12, n.bit_length())}"]
    crc, mask = zlib.crc32, (1 << BITS) - 1
    return np.unique(np.fromiter([crc(k.encode()) & mask for g in (kinds, heads, shape) for k in g], dtype=np.int32))


def _bin(x: float) -> int:
    """0, then halving steps from 1/256 up."""
    return 0 if x < 1 / 256 else min(9, 1 + int(np.log2(x * 256)))


class Ordinal:
    """Weights of the buckets and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every k, one row per score."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -500, 500)))

    def score(self, texts: list[str]) -> np.ndarray:
        return np.array([self.weights[features(t)].sum() for t in texts], dtype=np.float64)


def associated(flat: np.ndarray, row: np.ndarray, grades: np.ndarray, least_docs: int, least_z: float) -> np.ndarray:
    """Which buckets go with the grade: the documents that hold the bucket
    reach a grade more or less often than all documents do, by ``least_z``
    standard deviations. Words of a few documents say nothing and would
    otherwise only learn those documents by heart."""
    df = np.bincount(flat, minlength=1 << BITS).astype(float)
    z = np.zeros(1 << BITS)
    for k in range(1, GRADES):
        reach = (grades >= k).astype(float)
        base = reach.mean()
        if 0 < base < 1:
            hits = np.bincount(flat, weights=reach[row], minlength=1 << BITS)
            z = np.maximum(z, np.abs(hits - df * base) / np.sqrt(np.maximum(df, 1) * base * (1 - base)))
    return (df >= least_docs) & (z >= least_z)


def fit(rows: list[np.ndarray], grades: np.ndarray, rounds: int = 300, l2: float = 1e-5, least_docs: int = 3, least_z: float = 4.5) -> Ordinal:
    """Full-batch gradient descent with per-weight step sizes.

    Buckets that do not go with the grade keep weight 0. Every grade weighs
    as the root of its size, so a rare grade is not drowned. With
    no rows, or one grade only, the weights are 0 and the thresholds far below
    (every document reaches every grade).
    """
    weights, thresholds = np.zeros(1 << BITS), np.full(GRADES - 1, -30.0)
    present = np.unique(grades) if len(grades) else np.array([])
    if len(present) < 2:
        return Ordinal(weights, thresholds)
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate(rows)
    row = np.repeat(np.arange(len(rows)), sizes)
    use = associated(flat, row, grades, least_docs, least_z)[flat]
    flat, row = flat[use], row[use]
    counts = np.bincount(grades, minlength=GRADES).astype(float)
    own = (len(grades) / len(present) / np.maximum(counts, 1))[grades] ** 0.5
    own /= own.sum()
    share = np.cumsum(np.bincount(grades, weights=own, minlength=GRADES))[:-1].clip(1e-3, 1 - 1e-3)
    t0, gaps = np.log(share[0] / (1 - share[0])), np.diff(np.log(share / (1 - share))).clip(0.1)
    raw = np.concatenate([[t0], np.log(gaps)])  # ordered by construction
    m, v = np.zeros(1 << BITS), np.zeros(1 << BITS)
    mt, vt = np.zeros(len(raw)), np.zeros(len(raw))
    for step in range(1, rounds + 1):
        t = np.concatenate([raw[:1], raw[0] + np.cumsum(np.exp(raw[1:]))])
        s = np.bincount(row, weights=weights[flat], minlength=len(rows))
        p = 1 / (1 + np.exp(-np.clip(s[:, None] - t[None, :], -50, 50)))
        # probability of the grade itself: difference of neighbouring tails
        tail = np.hstack([np.ones((len(s), 1)), p, np.zeros((len(s), 1))])
        pick = np.arange(len(s))
        here = np.maximum(tail[pick, grades] - tail[pick, grades + 1], 1e-12)
        slope = np.hstack([np.zeros((len(s), 1)), p * (1 - p), np.zeros((len(s), 1))])
        ds = -own * (slope[pick, grades] - slope[pick, grades + 1]) / here
        dt = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            d = p[:, k] * (1 - p[:, k])
            dt[k] = np.sum(own * d * ((grades == k + 1).astype(float) - (grades == k)) / here)
        graw = np.concatenate([[dt.sum()], [dt[k:].sum() * np.exp(raw[k]) for k in range(1, len(raw))]])
        g = np.bincount(flat, weights=ds[row], minlength=1 << BITS) + l2 * weights
        rate = 0.15 * min(1.0, 2 * (1 - step / (rounds + 1)))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mt, vt = 0.9 * mt + 0.1 * graw, 0.99 * vt + 0.01 * graw * graw
        fix1, fix2 = 1 - 0.9 ** step, 1 - 0.99 ** step
        weights = weights - rate * (m / fix1) / (np.sqrt(v / fix2) + 1e-7)
        raw = raw - rate * (mt / fix1) / (np.sqrt(vt / fix2) + 1e-7)
    return Ordinal(weights, np.concatenate([raw[:1], raw[0] + np.cumsum(np.exp(raw[1:]))]))


def grade(quality: Column, toxic: Column) -> Column:
    """Graded rating of a label row: 0 bad quality, 1 good but toxic, 2 good.
    A null in either counts as not rated."""
    return F.when(quality.isNull() | toxic.isNull(), None).when(quality == 0, 0).when(toxic != 0, 1).otherwise(2)


def _described(batches):
    """(id, grade, features) of rated texts."""
    for batch in batches:
        rows = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("grade"), pa.array(rows, type=pa.list_(pa.int32()))], names=["_id", "grade", "features"])


def rated_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 5) -> DataFrame:
    """(grade, features) of at most ``rows`` rated documents, by a hash of the
    id; a document with several ratings occurs once for each, and rows that
    share an id count one by one towards ``rows``. Ids are ranked first; texts
    are read for the chosen ones and described where they lie, so that only
    numbers reach the training task."""
    rated = labels.select(F.col("doc_id").alias("_id"), grade(F.col("quality"), F.col("toxic")).alias("grade")).where("_id is not null and grade is not null")
    by_hash = F.xxhash64(F.lit(seed), "_id")
    chosen = saved(rated.orderBy(by_hash, "_id", "grade").limit(rows), "rated_ids")
    # at most ``rows`` rows of two numbers
    texts = docs.select(F.col("doc_id").alias("_id"), text_or_empty(F.col("text")).alias("text")).join(F.broadcast(chosen), "_id")
    described = saved(texts.mapInArrow(_described, "_id long, grade int, features array<int>"), "rated_features")
    return described.orderBy(by_hash, "_id", "grade", "features").limit(rows).select("grade", "features")


def _train(batches):
    grades, rows = [], []
    for batch in batches:
        grades.append(batch.column("grade").to_numpy())
        lists = batch.column("features")
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        rows += [flat[lo:hi] for lo, hi in zip(ends[:-1], ends[1:])]
    model = fit(rows, np.concatenate(grades).astype(np.int64) if grades else np.array([], dtype=np.int64))
    yield pa.RecordBatch.from_pydict({"weights": [model.weights.astype("<f4").tobytes()], "thresholds": [model.thresholds.astype("<f8").tobytes()]})


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Ordinal:
    """Fit on the sample, in one task (its input is bounded by ``rows``)."""
    sample = rated_sample(docs, labels, rows)
    got = sample.coalesce(1).mapInArrow(_train, "weights binary, thresholds binary").collect()
    if not got:
        return fit([], np.array([], dtype=np.int64))
    return Ordinal(np.frombuffer(got[0]["weights"], "<f4").astype(np.float64), np.frombuffer(got[0]["thresholds"], "<f8"))


def scorer(spark: SparkSession, model: Ordinal):
    """Column function text -> struct(expected_grade, tail_probability).
    The tail is the probability of the highest grade."""
    shared = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))

    @F.pandas_udf("expected_grade double, tail_probability double")
    def rate(texts: pd.Series) -> pd.DataFrame:
        weights, thresholds = shared.value
        own = Ordinal(weights, thresholds)
        tails = own.tails(own.score(texts.tolist()))
        return pd.DataFrame({"expected_grade": tails.sum(axis=1), "tail_probability": tails[:, -1]})

    return lambda text: rate(text_or_empty(text))


def rate_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.6, rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per input row: ``doc_id, expected_grade, tail_probability,
    kept`` (tail at ``threshold`` or above).

    A null text is rated as an empty one. Repeated rows are rated alike. No
    usable labels: every document is kept. An empty table gives no rows; other
    columns are not read.
    """
    rate = scorer(docs.sparkSession, train(docs, labels, rows))
    rated = docs.select("doc_id", rate(F.col("text")).alias("r"))
    return rated.select("doc_id", "r.expected_grade", "r.tail_probability", (F.col("r.tail_probability") >= threshold).alias("kept"))


#: Texts that a task rates at once while it filters rows.
RATED_AT_ONCE = 500


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.6, rows: int = SAMPLE_ROWS, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they are.

    Each row is decided by its own text, also where rows share an id or have
    none; a null text is rated as an empty one; repeated rows stay or go
    together; texts are rated whole. No usable labels: every row stays. An
    empty table gives no rows; other columns pass through."""
    model = train(docs, labels, rows)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))
    at = docs.columns.index(text_col)

    def keep(batches):
        own = Ordinal(*shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, RATED_AT_ONCE):
                part = batch.slice(lo, RATED_AT_ONCE)
                tails = own.tails(own.score([t or "" for t in part.column(at).to_pylist()]))
                yield part.filter(pa.array(tails[:, -1] >= threshold))

    return docs.mapInArrow(keep, docs.schema)

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from conftest import SF001
from llm_fixtures import AWKWARD, make_docs
from pyspark.sql import functions as F

from tessera.llm.lbl import score_documents, shares, train

WORD = re.compile("[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """(held_out, n_tokens, n_known, train_tokens, base_score) per row."""
    toks = [WORD.findall((t or "").translate(LOW)) + [None] for _, t in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    c = Counter(w for x, h in zip(toks, held) if not h for w in x)
    n, v = sum(c.values()), len(c)
    return [(h, len(x), sum(w in c for w in x), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x)) for x, h in zip(toks, held)]


def same(rows, got):
    key = lambda x: (str(x[0]), *x[1:5], round(x[5], 4))
    want = sorted(key((d, *b)) for (d, _), b in zip(rows, brute(rows)))
    have = sorted(key(tuple(r)[:6]) for r in got)
    assert [x[:5] for x in have] == [x[:5] for x in want]
    assert np.allclose([x[5] for x in have], [x[5] for x in want], rtol=1e-9, atol=2e-4)


def test_base_scores_on_the_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for dictionary in (200_000, 300):
        got = score_documents(docs, dictionary=dictionary).collect()
        same(rows, got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_by_join_or_dictionary_are_the_same(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(rnd.randint(0, 40)))) for i in range(300)]
    full = {r.doc_id: tuple(r) for r in score_documents(make_docs(spark, rows), classes=4).collect()}
    join = {r.doc_id: tuple(r) for r in score_documents(make_docs(spark, rows), classes=4, dictionary=5).collect()}
    for d, x in full.items():
        assert x[:5] == join[d][:5] and np.allclose(x[5:], join[d][5:])


def test_model_is_normalised_and_learns_pairs():
    rng = np.random.default_rng(1)
    size = 30
    truth = rng.dirichlet(np.full(size, 0.1), size)
    counts = np.maximum(0, (truth * 20000).round())
    cells = np.flatnonzero(counts)
    table = train(cells, counts.ravel()[cells], size)
    p = 10 ** table
    assert np.allclose(p.sum(axis=1), 1)
    unigram = counts.sum(axis=0) / counts.sum()
    model = (counts * table).sum() / counts.sum()
    plain = (counts * np.log10(unigram + 1e-12)).sum() / counts.sum()
    best = (counts * np.log10(np.maximum(truth, 1e-12))).sum() / counts.sum()
    assert model > plain + 0.7 * (best - plain)


def test_scores_sum_to_one_over_words(spark):
    """The probability of all one-word texts, unseen words as one, is at most that of the first token."""
    rows = [(i, "a b a c d e f a b".split()[i % 9]) for i in range(400)]
    got = score_documents(make_docs(spark, rows + [(5000, "zzz")]), classes=3).collect()
    text = dict(rows)
    by = {text.get(r.doc_id, "zzz"): r.score for r in got}
    assert 0.2 < sum(10 ** x for x in by.values()) <= 1.001


def test_awkward_and_empty(spark):
    base = make_docs(spark, AWKWARD).withColumn("row", F.lit("clash")).withColumn("held_out", F.lit(1))
    same([r[:2] for r in AWKWARD], score_documents(base).collect())
    assert score_documents(make_docs(spark, [])).count() == 0
    alone = [(d, "x y") for d in range(40) if zlib.crc32(str(d).encode()) % 7 == 2]
    got = score_documents(make_docs(spark, alone)).collect()
    same(alone, got)
    assert all(r.train_tokens == 0 and r.base_score == 0 for r in got)


def test_most_frequent_is_bounded(spark, monkeypatch):
    from tessera.llm import lbl

    rows = [("", 900)] + [(f"top{i}", 1000 - i) for i in range(20)] + [(f"rare{i}", 1) for i in range(500)]
    df = spark.createDataFrame(rows, "word string, c long")
    monkeypatch.setattr(lbl, "TIES", 100)
    assert lbl.most_frequent(df, 30) == [(f"top{i}", 1000 - i) for i in range(20)]
    assert lbl.most_frequent(df, 5) == [(f"top{i}", 1000 - i) for i in range(5)]
    assert lbl.most_frequent(df.limit(0), 5) == []


def test_a_pass_takes_every_counted_pair():
    counts = np.concatenate([np.ones(50_000), [5.0, 123_456.0, 7_000.0]])
    at, weight = shares(counts)
    assert np.allclose(np.bincount(at, weights=weight), counts) and weight.max() <= counts.mean() and len(at) <= 2 * len(counts)
    assert len(shares(np.zeros(0))[0]) == 0


def test_training_reaches_every_context(monkeypatch):
    """One step asked for, a pass of several made: no counted context is left out."""
    from tessera.llm import lbl

    seen, real = set(), lbl._sums
    monkeypatch.setattr(lbl, "_sums", lambda at, rows, size: (seen.update(at.tolist()), real(at, rows, size))[1])
    size = 900
    train(np.arange(size - 1) * size + 7, np.ones(size - 1), size, steps=1, batch=64, noise=8, width=2)
    assert set(range(size - 1)) <= seen

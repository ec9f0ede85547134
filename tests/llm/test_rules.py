import random
import re
from collections import Counter

import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import AWKWARD, make_docs
from pyspark.sql import functions as F

from tessera.llm.rules import counts, estimate, judge

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "\n", " ", "\t", "é#", "\U0001F600", "\x0b", "\r", " "]), max_size=60).map("".join), min_size=1, max_size=30))
def test_counts_equal_brute_force(spark, texts):
    got = {r.doc_id: tuple(r[c] for c in BASE) for r in counts(make_docs(spark, list(enumerate(texts)))).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_counts_on_the_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r.doc_id: tuple(r[c] for c in BASE) for r in judge(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}


def test_estimate_finds_rule_accuracies():
    rnd = random.Random(4)
    truth = [(0.98, 0.2), (0.95, 0.6), (0.97, 0.3), (0.9, 0.5)]
    seen = Counter()
    for _ in range(40000):
        good = rnd.random() < 0.85
        v = tuple(0 if rnd.random() < 0.2 else (1 if rnd.random() < (g if good else b) else -1) for g, b in truth)
        seen[v] += 1
    prior, right = estimate(sorted(seen.items()), 4)
    assert prior == pytest.approx(0.85, abs=0.1)
    for (g, b), (tg, tb) in zip(right, truth):
        assert g == pytest.approx(tg, abs=0.03) and b == pytest.approx(tb, abs=0.25)


def test_verdict_against_labels(spark):
    got = judge(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    rows = got.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r.quality: r.kept for r in rows.collect()}
    assert kept[1] > 0.99 and kept[0] < 0.05


def test_awkward_and_empty(spark):
    base = make_docs(spark, AWKWARD).withColumn("w", F.lit("clash")).withColumn("n_words", F.lit(1))
    got = judge(base).collect()
    assert sorted(tuple(r[c] for c in BASE) for r in got) == sorted(brute(r[1]) for r in AWKWARD)
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 10 or r.n_words == 30000)
    assert judge(make_docs(spark, [])).count() == 0

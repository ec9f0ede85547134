import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF0001
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import AWKWARD, make_docs
from pyspark.sql import functions as F

from tessera.llm import spelling
from tessera.llm.spelling import near_in_group, one_edit, spelling_variants, variants, with_lost_letter

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def edits(word, letters):
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i + k:] for i in range(len(word) + 1) for k in (0, 1) for c in letters}
    return out - {word}


def brute(n):
    """Variants of a word table by making all single edits of every word."""
    letters = {c for w in n for c in w}
    out = {}
    for w in n:
        near = [v for v in edits(w, letters) if v in n and v != w]
        top = min(near, key=lambda v: (-n[v], v), default=None)
        form = top if top is not None and n[top] >= 2 * n[w] else None
        out[w] = [form, w, n[w], len(near), form and n[form]]
    for w, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {(w, *row) for w, row in out.items()}


def counted(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            w = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                n[w] += 1
    return {w: k for w, k in n.items() if k >= 3}


def collected(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return [tuple(r) for r in df.collect()]


def test_tables(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    got = collected(spelling_variants(docs, changed=with_lost_letter))
    want = brute(counted([(r.doc_id, r.text) for r in docs.collect()]))
    assert len(got) == len(set(got)) and set(got) == want and any(r[1] for r in want)


WORDS = st.text(alphabet="abñÿ", min_size=5, max_size=9)


@settings(max_examples=6, deadline=None)
@given(st.dictionaries(WORDS, st.integers(3, 40), min_size=1, max_size=120))
def test_dense_words(spark, n):
    vocab = spark.createDataFrame(list(n.items()), "word string, n long")
    got = collected(variants(vocab))
    assert len(got) == len(n) and set(got) == brute(n)


def test_large_blocks_are_dealt(spark, monkeypatch):
    rnd = random.Random(4)
    n = {"ab" + "".join(rnd.choice("abc") for _ in range(rnd.randint(3, 6))): rnd.randint(3, 90) for _ in range(500)}
    monkeypatch.setattr(spelling, "PART_WORDS", 20)
    monkeypatch.setattr(spelling, "GROUP_ROWS", 50)
    got = collected(variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert len(got) == len(n) and set(got) == brute(n)


@settings(max_examples=200, deadline=None)
@given(WORDS, st.integers(0, 9), st.sampled_from(["a", "ñ", ""]), st.integers(0, 1))
def test_one_edit(word, i, c, skip):
    other = word[:i] + c + word[i + skip:]
    assert one_edit(word, other) == one_edit(other, word) == (other in edits(word, set("abñÿ")))
    rows = sorted((key, m, w) for w in {word, other} for key, m in spelling._blocks_of(w))
    a, b = near_in_group(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), [r[2] for r in rows])
    assert len(a) == len(b) == int(one_edit(word, other))


def test_long_words(spark):
    long = "x" * 3000
    n = {long: 9, long + "x": 4, "y" + long: 3, long[:-1] + "é": 20, "é" * 60: 5, "é" * 59: 11}
    assert set(collected(variants(spark.createDataFrame(list(n.items()), "word string, n long")))) == brute(n)


def test_awkward_and_empty(spark):
    rows = [*AWKWARD, (8, "Straße straße STRASSE strasse ×÷×÷× " * 3), (None, "hello hello hello hellos"), (9, "hellos Hellos hello hello hello")]
    base = make_docs(spark, rows).withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    got = collected(spelling_variants(base, changed=with_lost_letter))
    assert len(got) == len(set(got)) and set(got) == brute(counted([r[:2] for r in rows]))
    plain = {r[0]: r for r in collected(spelling_variants(base))}
    assert plain["hellos"][1:3] == ("hello", "hello") and plain["x" * 40000 if "x" * 40000 in plain else "hello"][1] is None
    assert spelling_variants(make_docs(spark, [])).count() == 0


@pytest.mark.parametrize("doc_id", [None, 7])
def test_lost_letter(doc_id):
    seen = [with_lost_letter(doc_id, f"word{'a' * k}") for k in range(400)]
    assert sum(len(w) != 4 + k for k, w in enumerate(seen)) > 0

import hashlib
import random
import re
import zlib

import numpy as np
from conftest import SF0001
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import AWKWARD, make_docs
from pyspark.sql import functions as F

from tessera.llm.runs import crossing, periodic_runs, run_digests, text_runs

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(w):
    """Runs by comparing every word with the one a period before it."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            s, length = i, j - i + q
            if length >= max(6, 4 * q) and not any(q % r == 0 and all(w[x] == w[x + r] for x in range(s, s + length - r)) for r in range(1, q)):
                out.append((s, length, q))
            i = j + 1
    return sorted(out)


def plain(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            sha("".join(f"{s},{x},{q}\n" for s, x, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def encoded(w):
    return [str(x).encode() for x in w]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 9)), min_size=1, max_size=8))
def test_runs_of_repeated_parts(parts):
    w = [x for part, times in parts for x in part * times]
    assert text_runs([encoded(w)]) == [brute(w)]


def test_runs_of_random_words():
    rnd = random.Random(7)
    texts = [[rnd.randrange(rnd.choice([1, 2, 3, 40])) for _ in range(rnd.randrange(90))] for _ in range(600)]
    texts += [list("abaababaabaab" * 12), ["x"] * 1000, list("ab" * 100 + "abc" * 50 + "b" * 40), []]
    for k in (5, 31, 97):  # periods of many words
        base = [f"w{i}" for i in range(k)]
        texts.append(base[-2:] + base * 5 + base[:k // 2] + ["z"] + base * 4)
    assert text_runs([encoded(w) for w in texts]) == [brute(w) for w in texts]


def test_crossing_needs_both_sides():
    w = np.array([1, 2] * 6 + [3])
    assert crossing(w, 6) == {(0, 12, 2)} and crossing(w, 12) == set() and crossing(np.array([1] * 12), 1) == {(0, 12, 1)}


def test_tables(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    got = run_digests(docs)
    assert got.columns == COLUMNS
    got = {tuple(r) for r in got.collect()}
    want = {plain(r.doc_id, r.text if len(r.text or "") < 20000 else None) for r in docs.collect() if len(r.text or "") < 20000}
    assert want <= got and len(got) == docs.count() and any(r[1] for r in want)


def test_tiled_documents(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 2) for _ in range(rnd.randint(0, 200)))) for i in range(400)]
    assert sorted(map(tuple, run_digests(make_docs(spark, rows)).collect())) == sorted(plain(*r) for r in rows)


def test_collapsed_text(spark):
    rows = [(1, "so  he said ha ha ha\tha ha ha ha and left"), (2, "a b a b a b"), (3, "a b a b a b a b a b c")]
    got = {r.doc_id: r for r in periodic_runs(make_docs(spark, rows)).collect()}
    assert got[1].collapsed == "so he said ha and left" and [tuple(x) for x in got[1].runs] == [(3, 7, 1)]
    assert got[2].runs == [] and got[2].collapsed == "a b a b a b"
    assert got[3].collapsed == "a b c" and got[3].n_words == 11


def test_awkward_and_empty(spark):
    base = make_docs(spark, AWKWARD).withColumn("runs", F.lit("clash")).withColumn("top", F.lit(1)).withColumn("w", F.lit(2))
    got = run_digests(base).collect()
    assert len(got) == len(AWKWARD)
    by_id = {r.doc_id: r for r in got}
    empty = hashlib.sha256(b"").hexdigest()
    assert all(by_id[i].n_runs == 0 and by_id[i].start is None and by_id[i].collapsed_sha256 == empty == by_id[i].runs_sha256 for i in (1, 2, 3))
    assert (by_id[4].n_runs, by_id[4].length, by_id[4].period) == (1, 30000, 1)
    assert by_id[None].n_runs == 0
    assert run_digests(make_docs(spark, [])).count() == 0

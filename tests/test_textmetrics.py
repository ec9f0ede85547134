"""Text metrics: hand values and properties."""

import math
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import gramsets
from tessera.operators import textmetrics as tm


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "k int, c string, r string, r2 string")


def test_bleu_identity_and_zero(spark):
    df = _pairs(spark, [(1, "the cat sat on the mat", "the cat sat on the mat", None),
                        (2, "a b c d e", "a b c d e", None)])
    assert tm.bleu(df, ["k"], "c", "r").first().bleu == pytest.approx(1.0)
    no = _pairs(spark, [(1, "x y z w", "a b c d", None)])
    assert tm.bleu(no, ["k"], "c", "r").first().bleu == 0.0


def test_bleu_brevity(spark):
    df = _pairs(spark, [(1, "a b c d", "a b c d e f g h", None)])
    r = tm.bleu(df, ["k"], "c", "r").first()
    assert r.bp == pytest.approx(math.exp(1 - 8 / 4))
    assert r.bleu == pytest.approx(math.exp(1 - 8 / 4))


def test_rouge_and_token_f1(spark):
    df = _pairs(spark, [(1, "a b c", "a b d", "x"), (2, "", "", None), (3, "q", "", None)])
    r1 = tm.rouge_n(df, ["k"], "c", "r", 1).first()
    assert r1.rouge_1 == pytest.approx((2 / 3 + 0 + 0) / 3)
    tf = tm.token_f1(df, ["k"], "c", ["r", "r2"]).first()
    # pair 1: best of 2/3 and 0; pair 2: both empty → 1; pair 3: one empty → 0
    assert tf.token_f1 == pytest.approx((2 / 3 + 1 + 0) / 3)
    em = tm.exact_match(_pairs(spark, [(1, "The Cat!", "x", "the cat"), (2, "a", "b", None)]), "c", ["r", "r2"])
    assert em.first().exact_match == pytest.approx(0.5)


def test_rouge_l_and_edit_rate(spark):
    df = _pairs(spark, [(1, "a b c d", "a c d", None)])
    assert tm.rouge_l(df, "c", "r").first().rouge_l == pytest.approx(2 * 0.75 * 1 / 1.75)
    w = tm.word_edit_rate(df, "c", "r").first()
    assert (w.edits, w.ref_words) == (1, 3)


def test_chrf_identity(spark):
    df = _pairs(spark, [(1, "hello world", "hello world", None)])
    assert tm.chrf(df, ["k"], "c", "r").first().chrf == pytest.approx(1.0)


def test_sari_copy_source(spark):
    df = spark.createDataFrame([(1, "a b c d e", "a b c d e", "a b c d e"), (2, "a b c", "a b c", "a b c")],
                               "k int, s string, h string, r string")
    # keep everything, nothing to add or delete: F_keep = 1, F_add = 0, P_del = 0 per order;
    # row 2 has no 4-grams, and an order without n-grams scores 0 (zero-denominator rule)
    assert tm.sari(df, ["k"], "s", "h", "r").first().sari == pytest.approx((1 / 3 + 0.25) / 2)


def test_gulpease(spark):
    df = spark.createDataFrame([(1, "Ciao mondo. Bello!"), (2, "...")], "id int, text string")
    r = {x.id: x for x in tm.gulpease(df).collect()}
    assert r[1].gulpease == pytest.approx(89 + (300 * 2 - 10 * 14) / 3)
    assert r[2].gulpease is None


def test_gram_builders_agree(spark):
    df = spark.createDataFrame([("a bb c, d! e",), ("",), ("x",), ("àé ßü  ç",)], "t string")
    from tessera.functions.text import word_tokens
    toks = df.select(word_tokens("t", lower=True).alias("w")).collect()
    for r in toks:
        for n in range(1, 5):
            exp_w = [" ".join(r.w[i:i + n]) for i in range(len(r.w) - n + 1)]
            got_w = spark.createDataFrame([(r.w,)], "w array<string>").select(tm.word_grams(F.col("w"), n)).first()[0]
            assert got_w == exp_w


def _plain_overlaps(pairs, char_n, word_n):
    """Sums per order by counting the grams of each pair."""
    sums = {}
    for c, r, cw, rw in pairs:
        for a, b, offset, most in ((c or "", r or "", 0, char_n), (cw or [], rw or [], 100, word_n)):
            for n in range(1, most + 1):
                x, y = (Counter(tuple(t[i:i + n]) for i in range(len(t) - n + 1)) for t in (a, b))
                row = sums.setdefault(offset + n, [0, 0, 0])
                for k, v in enumerate(((x & y).total(), x.total(), y.total())):
                    row[k] += v
    return sums


_text = st.text(alphabet="ab€𝄞", max_size=30) | st.none()
_ids = st.lists(st.integers(-2**63, 2**63 - 1) | st.integers(0, 2), max_size=12) | st.none()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(_text, _text, _ids, _ids), max_size=12), st.integers(1, 60), st.integers(1, 5))
def test_gram_overlaps_against_counters(pairs, symbols, rows):
    schema = pa.schema([("c_text", pa.string()), ("r_text", pa.string()), ("c_words", pa.list_(pa.int64())), ("r_words", pa.list_(pa.int64()))])
    table = pa.Table.from_pylist([dict(zip(schema.names, p)) for p in pairs], schema=schema)
    before, gramsets.SYMBOLS = gramsets.SYMBOLS, symbols
    try:
        out = list(gramsets.gram_overlaps(6, 2)(iter(table.to_batches(max_chunksize=rows))))
    finally:
        gramsets.SYMBOLS = before
    got = {r["n"]: [r["ov"], r["ct"], r["rt"]] for b in out for r in b.to_pylist()}
    assert {n: v for n, v in got.items() if any(v)} == {n: v for n, v in _plain_overlaps(pairs, 6, 2).items() if any(v)}


def test_pairs_without_grams_still_count(spark):
    df = _pairs(spark, [(1, "a b", "a b", None), (2, None, "", None), (None, "a", "a", None), (4, "x y", "", None)])
    assert tuple(tm.rouge_n(df, ["k"], "c", "r", 2).first()) == (4, pytest.approx(0.25))
    assert tm.bleu(df, ["k"], "c", "r").first().bleu == 0.0  # no gram of order 4 anywhere
    assert tm.sari(df.withColumnRenamed("r", "s").withColumn("r", F.col("s")), ["k"], "s", "c", "r").first().n == 4
    assert tm.chrf(df, ["k"], "c", "r").first().n_orders >= 1
    empty = df.limit(0)
    assert tm.chrf(empty, ["k"], "c", "r").first().chrf == 0.0
    assert tm.rouge_n(empty, ["k"], "c", "r", 1).first().n_pairs == 0
    assert tm.token_f1(empty, ["k"], "c", ["r"]).first().n == 0


_WORDS = [None, "", "a", "a a a b", "a b a b a b", "b a, b a!", "x y z", "a" * 40 + " b a b", "a a a b b b b"]


def test_gram_sums_against_counters(spark):
    rows = [(i % 23 if i % 7 else None, _WORDS[i % 9], _WORDS[i * 5 % 8], _WORDS[i // 9 % 9]) for i in range(81)]  # keys repeat and are null
    df = spark.createDataFrame(rows, "k int, h string, r string, s string")
    tokens = {c: tm.word_tokens(F.col(c), lower=True) for c in "hrs"}
    got = tm.gram_sums(df, ["k"], tokens, [1, 2, 3], {
        "hr": lambda h, r, s: F.least(h, r), "pen": lambda h, r, s: F.greatest(F.lit(0), F.least(h, s) - F.least(h, r)),
        "h": lambda h, r, s: h, "sets": lambda h, r, s: (h > 0) & (s == 0)}).collect()
    want = {}
    for k, *toks in df.select("k", *tokens.values()).collect():
        for n in (1, 2, 3):
            for c, t in zip(want.setdefault((k, n), [Counter(), Counter(), Counter()]), toks):
                c.update(tuple(t[i:i + n]) for i in range(len(t) - n + 1))
    assert {(x.k, x.n): (x.hr, x.pen, x.h, x.sets) for x in got} == {
        at: ((h & r).total(), ((h & s) - (h & r)).total(), h.total(), len(set(h) - set(s))) for at, (h, r, s) in want.items()}
    assert len(got) == len(want)


def test_grams_are_counted_inside_the_row_of_the_pair(spark):
    df = spark.createDataFrame([(1, "a b c", "a b", "c"), (2, "a", None, "b")], "k int, h string, r string, s string")
    jobs = {"bleu": tm.bleu(df, ["k"], "h", "r"), "rouge": tm.rouge_n(df, ["k"], "h", "r", 2), "f1": tm.token_f1(df, ["k"], "h", ["r", "s"]),
            "ibleu": tm.ibleu(df, ["k"], "h", "r", "s"), "gleu": tm.gleu_plus(df, ["k"], "h", "r", "s"), "sari": tm.sari(df, ["k"], "s", "h", "r")}
    for name, job in jobs.items():
        plan = job._jdf.queryExecution().optimizedPlan().toString()
        assert "explode" not in plan, name  # no row per gram
        assert plan.count("collect_list") == 1, name  # the pairs are read and counted once

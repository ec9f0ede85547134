"""Set/span/judgement metrics on hand-made rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import structured as st


def test_set_prf(spark):
    g = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "ex int, item string")
    p = spark.createDataFrame([(1, "a"), (2, "d"), (2, "d")], "ex int, item string")
    r = st.set_prf(g, p, ["ex", "item"]).first()
    assert (r.tp, r.fp, r.fn) == (1, 1, 2)
    assert r.f == pytest.approx(2 * 0.5 * (1 / 3) / (0.5 + 1 / 3))


def test_bio_to_spans_rules(spark):
    tags = ["B-PER", "I-PER", "O", "I-LOC", "I-LOC", "I-PER", "B-ORG", "B-ORG"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(tags)], "doc_id int, pos long, tag string")
    spans = sorted((r.start, r.end, r.type) for r in st.bio_to_spans(df, "tag").collect())
    assert spans == [(0, 1, "PER"), (3, 4, "LOC"), (5, 5, "PER"), (6, 6, "ORG"), (7, 7, "ORG")]


def test_long_types_stay_apart(spark):
    long = "x" * 1500
    tags = [f"B-{long}a", f"I-{long}a", f"I-{long}b"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(tags)], "doc_id int, pos long, tag string")
    assert sorted((r.start, r.end, r.type[-1]) for r in st.bio_to_spans(df, "tag").collect()) == [(0, 1, "a"), (2, 2, "b")]
    arr = spark.createDataFrame([(1, tags)], "doc_id int, tags array<string>")
    assert sorted((r.start, r.end, r.type[-1]) for r in st.spans_from_tags(arr, "tags").collect()) == [(0, 1, "a"), (2, 2, "b")]


def test_prompt_rates_past_turn_100(spark):
    rows = [(1, 100, "a", [("ends_with", ".")]), (2, 0, "a.", [("ends_with", ".")])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string, rules array<struct<rule:string,arg:string>>") \
        .withColumn("prompt", F.struct("conv_id", "turn"))
    got = {r.rule: (r.n, r.pass_rate) for r in st.constraint_pass_rates(st.constraint_checks(df, "prompt", "text", F.col("rules")), "prompt").collect()}
    assert got["__prompt__"] == (2, 0.5)


def _pass_brute(n, c, k):
    if n - c < k:
        return 1.0
    return 1.0 - math.prod(1 - k / i for i in range(n - c + 1, n + 1))


def test_pass_at_k(spark):
    rows = [(p, i, i < c) for p, (n, c) in enumerate([(12, 3), (10, 0), (15, 14), (4, 2)]) for i in range(n)]
    df = spark.createDataFrame(rows, "problem int, attempt int, passed boolean")
    out = {r.k: r for r in st.pass_at_k(df, [1, 10]).collect()}
    exp10 = [_pass_brute(n, c, 10) for n, c in [(12, 3), (10, 0), (15, 14)]]
    assert out[10].pass_at_k == pytest.approx(sum(exp10) / 3)
    assert (out[10].n_scored, out[10].n_skipped) == (3, 1)
    assert out[1].pass_at_k == pytest.approx((3 / 12 + 0 + 14 / 15 + 2 / 4) / 4)


def test_anls_vqa(spark):
    df = spark.createDataFrame([(1, "Roma", "roma", None), (2, "Romb", "Roma", "x"), (3, "abc", "xyz", None)],
                               "k int, p string, g1 string, g2 string")
    r = st.anls(df, ["k"], "p", ["g1", "g2"]).first()
    assert r.anls == pytest.approx((1 + 0.75 + 0) / 3)
    assert r.vqa_accuracy == pytest.approx((1 / 3) / 3)


def test_fever(spark):
    claims = spark.createDataFrame([(1, "S", "S"), (2, "R", "S"), (3, "S", "S")], "claim_id int, y_true string, y_pred string")
    ge = spark.createDataFrame([(1, 0, "a"), (1, 0, "b"), (1, 1, "c"), (3, 0, "d")], "claim_id int, set_id int, item string")
    pe = spark.createDataFrame([(1, "c"), (3, "e")], "claim_id int, item string")
    r = st.fever_score(claims, ge, pe).first()
    assert r.label_accuracy == pytest.approx(2 / 3) and r.fever_score == pytest.approx(1 / 3)
    # a claim without gold evidence needs none
    more = claims.unionByName(spark.createDataFrame([(4, "N", "N"), (5, "N", "S")], claims.schema))
    r = st.fever_score(more, ge, pe).first()
    assert r.label_accuracy == pytest.approx(3 / 5) and r.fever_score == pytest.approx(2 / 5)


def test_soft_match_identity(spark):
    rows = [(0, "cand", 0, [1.0, 0.0]), (0, "ref", 1, [1.0, 0.0]), (0, "cand", 2, [0.0, 2.0]), (0, "ref", 3, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "pair_id int, side string, vec_id int, embedding array<float>")
    assert st.soft_match(df).first().f1 == pytest.approx(1.0)


def _plain_soft_match(rows):
    """Mean precision, recall and F1 over pairs, cell by cell."""
    def cosine(a, b):
        n = math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
        return sum(x * y for x, y in zip(a, b)) / n if n else 0.0
    scores = []
    for p in sorted({r[0] for r in rows if r[0] is not None}):
        c, r = ([x[3] for x in rows if x[0] == p and x[1] == s and x[3] is not None] for s in ("cand", "ref"))
        if c and r:
            pr, rc = (sum(max(cosine(a, b) for b in other) for a in one) / len(one) for one, other in ((c, r), (r, c)))
            scores.append((pr, rc, 2 * pr * rc / (pr + rc) if pr + rc else 0.0))
    return len(scores), [sum(x[k] for x in scores) / len(scores) for k in range(3)]


@pytest.mark.parametrize("block", [st.VECTOR_BLOCK, 3])
def test_soft_match_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(st, "VECTOR_BLOCK", block)
    draw = random.Random(5)
    vec = lambda: [float(draw.randint(-3, 3)) for _ in range(4)]
    rows = [(1, draw.choice(("cand", "ref")), i, vec()) for i in range(40)]  # one pair of many blocks
    rows += [(2, "cand", 100, vec()), (2, "ref", 101, [0.0] * 4), (3, "cand", 102, vec()), (4, "cand", 103, None), (4, "ref", 104, vec()),
             (None, "cand", 105, vec()), (None, "ref", 106, vec()), (5, "cand", 107, vec()), (5, "ref", 108, vec()), (5, "ref", 109, None)]
    df = spark.createDataFrame(rows, "pair_id int, side string, vec_id int, embedding array<double>")
    got = st.soft_match(df).first()
    n, means = _plain_soft_match(rows)
    assert got.n_pairs == n == 3
    assert [got.precision, got.recall, got.f1] == pytest.approx(means)
    assert st.soft_match(df.limit(0)).first().n_pairs == 0


def test_span_f1_of_missing_and_empty_tags(spark):
    rows = [(1, ["B-x", "I-x", "O", "B-y"], ["B-x", "I-x", "O", "B-x"]), (2, [], None), (3, None, ["B-y"]), (4, ["I-y"], ["B-y"])]
    df = spark.createDataFrame(rows, "doc_id int, gold_tags array<string>, pred_tags array<string>")
    out = {(r.scope, r.type): (r.tp, r.fp, r.fn) for r in st.span_f1_arrays(df).collect()}
    assert out == {("type", "x"): (1, 1, 0), ("type", "y"): (1, 1, 1), ("micro", None): (2, 2, 1), ("macro", None): (2, 2, 1)}


def test_clause_match(spark):
    df = spark.createDataFrame([("SELECT a, b FROM t WHERE x = 1 AND y = 2", "select b,a from t where y = 2 and x = 1"),
                                ("SELECT a FROM t ORDER BY a", "SELECT a FROM t")], "g string, p string")
    assert [r.exact_set_match for r in st.clause_match(df, "g", "p").collect()] == [True, False]
    more = [("SELECT a,\n b FROM t", "SELECT x,\n y FROM t", False), ("SELECT a FROM t\nWHERE x = 1", "SELECT a FROM t\nWHERE x = 2", False),
            ("SELECT 1", "garbage", False), ("SELECT a FROM t", "garbage", False), ("SELECT a\nFROM t", "select  a from t", True),
            ("SELECT a FROM t WHERE x = 'A'", "SELECT a FROM t WHERE x = 'a'", False),
            ("SELECT a FROM t GROUP BY a HAVING n > 1", "SELECT a FROM t GROUP BY a HAVING n > 2", False),
            ("SELECT a FROM t ORDER BY a LIMIT 1", "SELECT a FROM t ORDER BY a", False)]
    got = st.clause_match(spark.createDataFrame(more, "g string, p string, want boolean"), "g", "p").collect()
    assert [r.exact_set_match for r in got] == [r.want for r in got]


def test_json_validity_and_fields(spark):
    df = spark.createDataFrame([(1, '{"k": 1}', '{"k": 1}'), (2, '{"k": 2}', '{"k": 2'), (3, '{"k": 3}', '{"k": "x"}')],
                               "example_id int, gold string, pred string")
    v = [r.valid for r in st.json_validity(df, "pred", {"k": "integer"}).orderBy("example_id").collect()]
    assert v == [True, False, False]
    other = spark.createDataFrame([(1, '{"name": "a", "x y": [1], "b": true}'), (2, '{"name": 1, "x y": [1], "b": true}'), (3, '[1]')], "i int, j string")
    v = st.json_validity(other, "j", {"name": "string", "x y": "array", "b": "boolean"}).orderBy("i").collect()
    assert [r.valid for r in v] == [True, False, False]
    micro = [r for r in st.field_prf(df, "example_id", "gold", "pred").collect() if r.scope == "micro"][0]
    assert (micro.tp, micro.fp, micro.fn) == (1, 1, 2)


def test_clause_match_at_depth_and_in_quotes(spark):
    rows = [("SELECT count(a, b), c FROM t", "SELECT c, count( a,b ) FROM t", True),
            ("SELECT count(a, b), c FROM t", "SELECT count(a, c), b FROM t", False),
            ("SELECT a FROM t WHERE x = 'p, q from r'", "select a from t where x = 'p, q from r'", True),
            ("SELECT a FROM t WHERE x = 'p, q from r'", "SELECT a FROM t WHERE x = 'q from r, p'", False),
            ("SELECT a FROM t WHERE x = 'it''s and more' AND y = 1", "SELECT a FROM t WHERE y = 1 AND x = 'it''s and more'", True),
            ("SELECT a FROM t WHERE x = '(' AND y = 1", "SELECT a FROM t WHERE y = 1 AND x = '('", True),
            ("SELECT a FROM t WHERE b IN (SELECT c FROM u WHERE d = 1 AND e = 2) AND f = 3", "SELECT a FROM t WHERE f = 3 AND b IN (SELECT c FROM u WHERE d = 1 AND e = 2)", True),
            ("SELECT a FROM t WHERE b IN (SELECT c FROM u) LIMIT 2", "SELECT a FROM t WHERE b IN (SELECT c FROM u LIMIT 2)", False),
            (None, "SELECT a FROM t", False), ("SELECT f(g(a, b), h) FROM t", "SELECT f( g(a , b),h ) FROM t", True), ("SELECT a) FROM t", "SELECT a FROM t", False)]
    got = st.clause_match(spark.createDataFrame(rows, "g string, p string, want boolean"), "g", "p").collect()
    assert [r.exact_set_match for r in got] == [r.want for r in got]

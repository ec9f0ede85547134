import hashlib
import random
import re

import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import AWKWARD, make_docs
from pyspark.sql import functions as F

from tessera.llm.automaton import Rule, Scanner, compiled
from tessera.llm.secrets import BASE, RULES, find_secrets, masked, secret_digests

ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")


def brute(text):
    """The base spans by one plain pattern per kind, dropped afterwards."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return [(BASE[k], s, e) for s, k, e in sorted(out)]


def written(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def same(rows, got):
    order = [r.kind for r in RULES]
    assert got and all(r.doc_id in rows for r in got)
    for r in got:
        want = brute(rows[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(written(want).encode()).hexdigest(), rows[r.doc_id][:300]
        assert [r[f"n_{k}"] for k in BASE] == [sum(x[0] == k for x in want) for k in BASE]
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        assert [x for x in spans if x[0] in BASE] == want
        assert spans == sorted(spans, key=lambda x: (x[1], order.index(x[0])))


BITS = ["password", "PASSWD", "secret", "token", "Api_Key", "apikey", "'", '"', " ", ":", "=", "==", "abc", "x1/+_.-", "AKIA", "AKIAKIA", "Z9", "0123456789", "deadbeef" * 3,
        "f" * 23, "G", "é", "\U0001F600", "\n", "tok", "toke", "pass", "passw", "\x00", "ghp_", "eyJ", ".", "://", "@", "sk_live_", "-----BEGIN ", "PRIVATE KEY-----"]


def test_base_spans_equal_plain_patterns(spark):
    rnd = random.Random(11)
    rows = {i: "".join(rnd.choice(BITS) for _ in range(rnd.randint(1, 30))) for i in range(4000)}
    rows[5000] = "token=" * 20000
    rows[5001] = "é" * 1000 + "a" * 100000 + " secret: " + "b" * 50000
    rows[5002] = "token=token:abcdefgh token=token:secret=abcdefgh AKIA" + "A" * 16
    same(rows, secret_digests(make_docs(spark, list(rows.items()))).collect())


def test_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = secret_digests(docs).collect()
    same({r.doc_id: r.text for r in docs.collect()}, got)
    assert sum(r.n_access + r.n_assign + r.n_hex for r in got)


@pytest.fixture(scope="module")
def scanner():
    return Scanner(compiled(RULES))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=30).map("".join))
def test_every_rule_equals_its_own_pattern(scanner, text):
    data = text.encode()
    got = scanner.spans(data)
    for n, rule in enumerate(RULES):
        both = rule.keep if rule.drop is None else f"(?P<k>{rule.keep})|{rule.drop}"
        want = [m.span() for m in re.finditer(both.encode(), data) if m.end() - m.start() >= rule.least and (rule.drop is None or m["k"] is not None)]
        assert [(s, e) for s, e, r in got if r == n] == want


def test_added_forms(spark):
    text = "é ghp_" + "a1B2" * 9 + " then eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.c2lnbmF0dXJl, -----BEGIN RSA PRIVATE KEY-----"
    row = secret_digests(make_docs(spark, [(1, text)])).first()
    assert row.spans == "github:2:42,web_token:48:101,private_key:103:134"
    assert row.n_assign == row.n_access == row.n_hex == 0


def test_automaton_is_minimal_and_refuses_other_rules():
    a = compiled([Rule("x", "ab|cb"), Rule("y", "b+")])
    assert len(a.table) // 256 == 4  # nothing open, a or c read, b after them, b by itself
    assert Scanner(a).spans(b"abb cb") == [(0, 2, 0), (1, 3, 1), (4, 6, 0), (5, 6, 1)]
    for bad in ("a(bc)?", "a*", "abcd|c"):
        with pytest.raises(ValueError):
            compiled([Rule("bad", bad)])


def test_masked(spark):
    docs = make_docs(spark, [(1, "é token=abcdef012345678901234567 end"), (2, "clean"), (3, None)])
    spans = find_secrets(docs).select(F.col("doc_id").alias("id"), "spans")
    got = {r.doc_id: r.t for r in docs.join(spans, F.col("id") == docs["doc_id"]).select("doc_id", masked(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert got == {1: "é [secret] end", 2: "clean", 3: None}


def test_awkward_and_empty(spark):
    base = make_docs(spark, AWKWARD).withColumn("spans", F.lit("clash")).withColumn("kind", F.lit(1))
    got = secret_digests(base).collect()
    assert len(got) == len(AWKWARD) and all(r.spans == "" for r in got)
    assert secret_digests(make_docs(spark, [])).count() == 0

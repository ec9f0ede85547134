import hashlib
import random
import re

from conftest import SF001
from llm_fixtures import AWKWARD, make_docs
from pyspark.sql import functions as F

from tessera.llm.pii import KINDS, boost, calibrated, find_personal_data, predict, redact

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    text = text or ""
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def written(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def same(rows, got):
    for r in got:
        want = brute(rows[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(written(want).encode()).hexdigest(), rows[r.doc_id][:200]
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x[0] == k for x in want) for k in KINDS]
        spans = [(a, int(b), int(c)) for a, b, c in (x.split(":") for x in r.spans.split(",") if x)]
        assert set(want) <= set(spans) and len(spans) == len(want) + r.n_added
        assert spans == sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def test_base_spans_equal_plain_patterns(spark):
    rnd = random.Random(5)
    bits = ["a@b.c", "_d@e-f.g.h", "@", ".", "1", "255", "256", "0001", "4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "+", "+1 (375) 555-4393",
            " ", "-", "(", ")", "x", "é", "\U0001F600", "\n", "12", "1.2.3.4", "%", "+49 30 1234567", "..", "7 ", "99999999999"]
    rows = {i: "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 25))) for i in range(1500)}
    rows[2000] = "me@host.org, " * 700 + "1 2 " * 20000
    rows[2001] = "a" * 200000 + "@" + "b." * 1000 + "c"
    rows[2002] = "1." * 2000 + "9" * 100000
    same(rows, find_personal_data(make_docs(spark, list(rows.items()))).collect())


def test_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = find_personal_data(docs).collect()
    same({r.doc_id: r.text for r in docs.collect()}, got)
    assert sum(r.n_added for r in got) <= 0.01 * len(got)


def test_trees_learn_and_calibrate():
    rnd = random.Random(2)
    rows = []
    for _ in range(300):
        x = tuple(rnd.randint(0, 3) for _ in range(13))
        p = 0.97 if (x[1] >= 2 and x[4] < 2) or x[6] == 3 else 0.03
        n = rnd.randint(20, 60)
        pos = sum(rnd.random() < p for _ in range(n))
        rows.append((x, pos, n - pos, p))
    model = boost([r[:3] for r in rows])
    assert sum((predict(model, x) > 0) == (p > 0.5) for x, _, _, p in rows) > 0.97 * len(rows)
    bound = calibrated(model, [(0, *r[:3]) for r in rows], 0.9)[0]
    good = sum(r[1] for r in rows if predict(model, r[0]) >= bound)
    bad = sum(r[2] for r in rows if predict(model, r[0]) >= bound)
    assert good / (good + bad) >= 0.9
    assert calibrated(model, [(0, *r[:3]) for r in rows], 1.0) == {} and boost([]) == (0.0, [])


def test_a_form_that_the_base_misses_is_added(spark):
    rnd = random.Random(8)
    rows = [(i, f"some words +1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)} and more") for i in range(400)]
    rows += [(i, f"chapter {rnd.randint(1, 99)} of {rnd.randint(1000, 2100)} words") for i in range(400, 600)]
    rows += [(999, "some words (375) 555-4393 and more")]
    got = {r.doc_id: r for r in find_personal_data(make_docs(spark, rows)).collect()}
    assert got[999].spans == "phone:11:25" and got[999].n_phone == 0 and got[999].n_added == 1
    assert sum(r.n_added for r in got.values()) == 1


def test_redaction(spark):
    df = spark.createDataFrame([("é me@host.org or 1.2.3.4!",)], "text string").withColumn("doc_id", F.lit(1))
    spans = find_personal_data(df).select("doc_id", "span_list")
    assert df.join(spans, "doc_id").select(redact(F.col("text"), F.col("span_list")).alias("t")).first().t == "é [email] or [ip]!"


def test_awkward_and_empty(spark):
    base = make_docs(spark, [*AWKWARD, (9, "9" * 50000), (10, "+1" * 20000)]).withColumn("kind", F.lit("clash")).withColumn("base", F.lit(1))
    got = find_personal_data(base).collect()
    assert len(got) == len(AWKWARD) + 2 and all(r.spans == "" for r in got)
    assert find_personal_data(make_docs(spark, [])).count() == 0

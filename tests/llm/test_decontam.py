
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import AWKWARD, make_docs
from pyspark.sql import functions as F

from tessera.llm import decontam
from tessera.llm.decontam import leaks, raw_words, template_words, without_leaks

ITEMS = [(1, "A train leaves Boston at 7 with 120 kg of coal and arrives in Denver after 45 hours on the long road. How far did it go from Boston?"),
         (2, "What is the capital of the country where the old river meets the northern sea?"),
         (3, "Name the largest moon"), (4, None), (5, ""), (6, "12 13 14 15 16 17 18 19 20"), (2, "What is the capital of the country where the old river meets the northern sea?")]
FILL = "Some words come first and they say nothing at all."


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_templates(spark):
    df = spark.createDataFrame([("He paid 3.5 dollars to Ann Lee. Then 7 km, 1.2a X2.5!",)], "text string")
    r = df.select(template_words(F.col("text")).alias("t"), raw_words(F.col("text")).alias("w")).first()
    assert r.t == ["he", "paid", "§d", "§u", "to", "§n", "§n", "then", "§d", "§u", "1.2a", "x2.5"]
    assert r.w == ["he", "paid", "3.5", "dollars", "to", "ann", "lee", "then", "7", "km", "1.2a", "x2.5"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "B", "1", ".", "!", " ", "x", "2", "§", "-", "É", "km"]), max_size=30).map("".join), min_size=5, max_size=40))
def test_template_and_values_are_aligned(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert all(r.a == r.b for r in df.select(F.size(template_words(F.col("text"))).alias("a"), F.size(raw_words(F.col("text"))).alias("b")).collect())


DOCS = [
    (10, f"{FILL} {ITEMS[0][1]} {FILL}"),  # verbatim
    (11, f"{FILL} {ITEMS[0][1].replace('Boston', 'Paris').replace('Denver', 'Rome').replace('120', '88').replace('45', '9').replace(' 7 ', ' 3 ')}"),  # other values
    (12, f"{FILL} {ITEMS[0][1].replace('Boston', 'Paris', 1)}"),  # one edited name
    (13, FILL), (14, f"x {ITEMS[1][1].upper()}"), (15, ITEMS[1][1].replace(" ", "  \n")),
    (16, "please name the largest moon of all"), (17, "1 2 3 4 5 6 7 8 9 10 11"), (18, " ".join(ITEMS[1][1].split()[:9])),
    (19, "word " * 30000 + ITEMS[1][1] + " word" * 30000),
]


@pytest.mark.parametrize("most", [decontam.BROADCAST_ROWS, 0])
def test_leaks_and_slots(spark, monkeypatch, most):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", most)
    monkeypatch.setattr(decontam, "BROADCAST_IDS", most)
    got = {(r.doc_id, r.item_id): (r.n_slots, r.n_changed) for r in leaks(make_docs(spark, DOCS), items(spark)).collect()}
    assert set(got) == {(10, 1), (11, 1), (12, 1), (14, 2), (15, 2), (16, 3), (19, 2)}
    assert got[10, 1] == (8, 0) and got[11, 1] == (8, 6)
    left = without_leaks(make_docs(spark, DOCS), items(spark))
    assert sorted(r.doc_id for r in left.collect()) == [13, 17, 18]


def brute(rows, bench, width=8):
    """Verbatim passages only: documents with half of an item's windows or more."""
    def clean(t):
        import re
        return re.sub(r"[^\w]+", " ", (t or "").lower()).split()
    out, table = set(), {}
    for i, t in bench:
        w = clean(t)
        for k in range(len(w) - width + 1):
            table.setdefault(tuple(w[k:k + width]), set()).add((i, len(w) - width + 1))
    for d, t in rows:
        w, hits = clean(t), {}
        for k in range(len(w) - width + 1):
            for x in table.get(tuple(w[k:k + width]), ()):
                hits.setdefault(x, set()).add(tuple(w[k:k + width]))
        out |= {(d, i) for (i, n), s in hits.items() if 2 * len(s) >= n}
    return out


def test_passages_of_the_tables(spark):
    docs, bench = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in leaks(docs, bench).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()]) and got


def test_awkward_and_empty(spark):
    base = make_docs(spark, [*AWKWARD, (None, ITEMS[1][1]), (5, ITEMS[1][1])]).withColumn("hash", F.lit("clash")).withColumn("item_id", F.lit(1))
    got = {(r.doc_id, r.item_id) for r in leaks(base, items(spark)).collect()}
    assert got == {(None, 2), (5, 2)}
    left = without_leaks(base, items(spark))
    assert left.columns == base.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 5, 6, 7]  # only the leaking texts of null and 5 go
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks(base, none).count() == 0 and leaks(make_docs(spark, []), items(spark)).count() == 0
    assert without_leaks(base, none).count() == base.count()


LONG = "a farmer sells 30 boxes of apples to the old market and keeps the other boxes for Anna and her two sons"


def found(spark, docs, bench):
    return {(r.doc_id, r.item_id): (r.n_slots, r.n_changed) for r in leaks(make_docs(spark, docs), spark.createDataFrame(bench, "item_id long, text string")).collect()}


def test_capitals_and_sentence_breaks_do_not_hide_a_passage(spark):
    quoted = "What did the old farmer carry home after the long day at the market?"
    bench = [(1, LONG), (2, quoted)]
    docs = [(1, f"{FILL} {LONG.upper()} {FILL}"), (2, LONG.title()), (3, f"Q: {quoted}"), (4, f"one line without a mark\n{quoted}"),
            (5, f'he said "{quoted.replace(" ", chr(10))}"'), (6, LONG.upper().replace("30", "47")), (7, FILL.upper()), (8, FILL.title())]
    assert set(found(spark, docs, bench)) == {(1, 1), (2, 1), (3, 2), (4, 2), (5, 2), (6, 1)}
    df = spark.createDataFrame([("then IT IS THE END of Anna. Q: What",)], "text string")
    r = df.select(template_words(F.col("text")).alias("t"), template_words(F.col("text"), breaks=True).alias("b")).first()
    assert r.t == ["then", "it", "is", "the", "end", "of", "§n", "q", "§n"] and r.b == r.t[:-1] + ["what"]


def test_planted_capitals_of_the_tables(spark):
    """Every passage found by plain words is found, also in capitals."""
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()][:40]
    docs = [(i, t.upper()) for i, t in bench] + [(1000 + i, t.title()) for i, t in bench]
    assert {(i, i) for i, _ in bench} | {(1000 + i, i) for i, _ in bench} <= set(found(spark, docs, bench))


def test_edits_and_partial_quotes(spark):
    """One word changed, put in or left out anywhere, and 13 words of a long item."""
    short = "which of the two wooden bridges over the quiet river was built before the war"
    long = " ".join(f"{a}{b}" for a in ("red", "dry", "old", "new", "wet") for b in ("leaf", "moss", "sand", "wind", "rock", "fern", "lake", "reed"))
    bench = [(1, short), (2, long)]
    docs, want = [], set()
    for item, text in bench:
        w = text.split()
        for i in range(len(w)):
            for part in (w[:i] + ["other"] + w[i + 1:], w[:i] + w[i + 1:], w[:i] + ["more", "words"] + w[i:]):
                want.add((len(docs), item))
                docs.append((len(docs), f"{FILL} {' '.join(part)} {FILL}"))
    w = long.split()
    want.add((1000, 2))
    docs += [(1000, f"{FILL} {' '.join(w[9:22])} {FILL}"), (1001, f"{FILL} {' '.join(w[9:21])} {FILL}"), (1002, " ".join(sorted(w)))]
    assert set(found(spark, docs, bench)) == want


def test_slots_that_differ_do_not_hide_a_match(spark):
    task = ("a farmer sells 30 boxes of apples and 45 boxes of pears to the old market in the town and then "
            "keeps 12 boxes for the cold winter and gives 8 boxes to the school near the wide river")
    own = task.split()[:24]
    docs = [(1, " ".join(own) + " 30 boxes for 45 friends in 30 days and 45 weeks to come"),  # quoted, then numbers of its own
            (2, task.replace("45", "31", 1).replace("8 boxes", "31 boxes")),  # two values became equal
            (3, "add 7 red pens to 7 blue pens then take 7 green pens from 7 black pens and count every one"),  # all became equal
            (4, ITEMS[0][1].replace("Boston", "Paris", 1)), (5, FILL)]  # one of two equal names was edited
    got = found(spark, docs, [(1, task), (2, ITEMS[0][1]), (3, "add 3 red pens to 5 blue pens then take 4 green pens from 6 black pens and count every one")])
    assert set(got) == {(1, 1), (2, 1), (4, 2)}
    assert got[1, 1][1] == 0 and got[2, 1] == (4, 2) and got[4, 2] == (8, 1)
    changed = task.replace("30", "5").replace("45", "6").replace("12", "9").replace("8 boxes", "9 boxes")
    assert found(spark, [(6, changed)], [(1, task)]) == {(6, 1): (4, 4)}  # all changed, two of them to one value


def test_rows_that_share_an_id_are_decided_by_their_text(spark):
    rows = [(None, f"{FILL} {ITEMS[0][1]}"), (None, "a clean text without an id"), (7, ITEMS[1][1]), (7, "another clean text"), (8, None)]
    left = without_leaks(make_docs(spark, rows), items(spark)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in left) == [(0, "a clean text without an id"), (7, "another clean text"), (8, "")]

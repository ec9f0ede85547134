"""Alignment columns and edits against textbook dynamic programmes."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF0001
from tessera.functions.text import word_tokens
from tessera.operators import alignment as al
from tessera.sources import fixtures as fx


def dp_lcs(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            m[i][j] = m[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(m[i - 1][j], m[i][j - 1])
    return m[-1][-1]


def dp_edit(a, b):
    prev = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        cur = [i] + [0] * len(b)
        for j in range(1, len(b) + 1):
            cur[j] = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (a[i - 1] != b[j - 1]))
        prev = cur
    return prev[-1]


def measured(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i long, a array<string>, b array<string>")
    rows = df.select("i", al.common_length(F.col("a"), F.col("b")).alias("l"), al.word_distance(F.col("a"), F.col("b")).alias("d")).orderBy("i").collect()
    return [(r.l, r.d) for r in rows]


words = st.lists(st.sampled_from(["a", "b", "c", "the", "é", "\U0001F600"]), max_size=20)
#: Around the bounds of one and two digits of the bit vector.
long_words = st.integers(58, 130).flatmap(lambda n: st.lists(st.sampled_from("abcdefgh"), min_size=n, max_size=n))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=60), st.lists(st.tuples(long_words, long_words), max_size=4))
def test_columns_equal_plain_programmes(spark, short, longer):
    pairs = short + longer
    assert measured(spark, pairs) == [(dp_lcs(a, b), dp_edit(a, b)) for a, b in pairs]


def test_many_distinct_words(spark):
    a, b = [f"w{i}" for i in range(700)], [f"w{i}" for i in range(350, 900)]
    same = [f"x{i}" for i in range(200)]
    pairs = [(a, b), (same, same), (same, []), ([], same), (same, same[::-1]), (None, same), (same, None)]
    assert measured(spark, pairs) == [(350, 700 - 350 + 200), (200, 0), (0, 200), (0, 200), (1, 200), (None, None), (None, None)]


def applied(a, edits):
    out, at = [], 0
    for s, e, new in edits:
        out += [*a[at:s], *new]
        at = e
    return out + a[at:]


@settings(max_examples=400, deadline=None)
@given(words, words)
def test_edits_give_the_target(a, b):
    edits = al.word_edits(a, b)
    assert applied(a, edits) == b
    assert sum(max(e - s, len(new)) for s, e, new in edits) == dp_edit(a, b)
    assert all(x[1] < y[0] for x, y in zip(edits, edits[1:])) and all(a[s:e] != new for s, e, new in edits)


def test_edits_of_plain_sentences():
    edits = lambda a, b: al.word_edits(a.split(), b.split())
    assert edits("he go to school", "he goes to the school") == [(1, 2, ["goes"]), (3, 3, ["the"])]
    assert edits("a b c", "c") == [(0, 2, [])] and edits("", "x y") == [(0, 0, ["x", "y"])] and edits("x", "x") == []


def test_edits_of_the_tables(spark):
    srh = fx.src_ref_hyp(spark, SF0001)
    edits = al.text_edits(srh, ["conv_id", "turn"], "source", "reference")
    per = edits.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("start", "end", "replacement"))).alias("e"))
    src, ref = word_tokens("source"), word_tokens("reference")
    none = F.array().cast("array<struct<start:long,end:long,replacement:string>>")
    both = srh.join(per, ["conv_id", "turn"], "left").select(al.apply_edits(src, F.coalesce("e", none)).alias("got"), ref.alias("want"))
    assert both.count() > 10 and both.where("got <> want").count() == 0


def test_edits_of_null_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", "a b"), (3, "a b", None), (None, "x", "y")], "id long, s string, t string").withColumn("start", F.lit(9))
    got = {tuple(r) for r in al.text_edits(df, ["id"], "s", "t").collect()}
    assert got == {(2, 0, 0, "a b"), (3, 0, 2, ""), (None, 0, 1, "y")}
    assert al.text_edits(df.where("false"), ["id"], "s", "t").count() == 0

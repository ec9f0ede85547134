"""Prompt rendering and label decoding on hand-made rows."""

import time

from pyspark.sql import functions as F

from tessera.functions import prompts as pr
from tessera.functions import text as tx
from tessera.operators import prepare as pp
from tessera.registry import get_task


def test_render_prompt_with_and_without_system(spark):
    df = spark.createDataFrame([(1, "  ciao \n", "positivo"), (2, None, None)], "id int, text string, label string")
    out = df.select("id", pr.render_prompt(F.col("text"), F.col("label"), "SYS", "Testo").alias("t")).collect()
    got = {r.id: r.t for r in out}
    assert got[1] == ("<start_of_turn>user\nSYS\n\nTesto: ciao\n<end_of_turn>\n"
                      "<start_of_turn>model\npositivo\n<end_of_turn>")
    assert got[2].startswith("<start_of_turn>user\nSYS\n\nTesto: \n")
    nosys = df.select(pr.render_prompt(F.col("text"), F.col("label"), "", "Istruzione").alias("t")).first().t
    assert nosys.startswith("<start_of_turn>user\nIstruzione: ciao\n")


def test_task01_decode_and_passthrough(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (-1,), (7,)], "code int")
    t = get_task("01")
    words = [r[0] for r in df.select(tx.decode_label("code", {int(k): v for k, v in t.label_map.items()},
                                                     "neutro")).collect()]
    assert words == ["negativo", "positivo", "neutro", "neutro", "neutro"]
    raw = spark.createDataFrame([("0",), ("3",), ("-1",), ("9",), ("x",)], "r string")
    m = get_task("03").label_map
    assert [r[0] for r in raw.select(tx.decode_passthrough("r", m)).collect()] == ["World", "Sci-Tech", "-1", "9", "x"]


def test_small_transforms(spark):
    df = spark.createDataFrame([("\n\t a b \r\n", "", "x" * 81, "POSITIVE!")], "a string, b string, c string, d string")
    r = df.select(tx.strip("a").alias("s"), tx.first_nonempty("b", "a").alias("f"), tx.shorten("c", 80).alias("h"),
                  tx.normalise_prediction("d").alias("n"), tx.stars_to_class(F.lit(3)).alias("st")).first()
    assert r.s == "a b" and r.f == "a b" and r.h == "x" * 80 + "..." and r.n == "positivo" and r.st == "positivo"


def test_prepare_task_falls_back_to_first_column(spark):
    df = spark.createDataFrame([("only",)], "foo string")
    text = pp.prepare_task(df, "13", keep=()).first().text
    assert "Testo: only\n" in text


def test_options_and_inputs(spark):
    df = spark.createDataFrame([(["x", "y"], "p", "h")], "o array<string>, a string, b string")
    r = df.select(pr.render_options("o").alias("o"), pr.render_inputs(["a", "b"], ["Premessa", "Ipotesi"]).alias("i")).first()
    assert r.o == "A) x\nB) y" and r.i == "Premessa: p\nIpotesi: h"


def test_option_labels(spark):
    df = spark.range(0, 800)
    labels = [r[0] for r in df.select(pr.option_label(F.col("id"))).orderBy("id").collect()]
    assert labels[:3] == ["A", "B", "C"] and labels[25] == "Z" and labels[26] == "AA" and labels[701] == "ZZ"
    assert labels[702] == "AAA" and len(set(labels)) == 800


def test_label_map_as_written_never_hits(spark):
    m = get_task("03").label_map
    raw = spark.createDataFrame([("0",), ("3",)], "r string")
    assert [r[0] for r in raw.select(tx.decode_passthrough("r", m, as_written=True)).collect()] == ["0", "3"]
    assert [r[0] for r in raw.select(tx.decode_passthrough("r", m)).collect()] == ["World", "Sci-Tech"]


def test_option_labels_do_not_wrap(spark):
    def label(n):
        out, n = "", n + 1
        while n:
            n, r = divmod(n - 1, 26)
            out = chr(65 + r) + out
        return out
    some = [0, 25, 26, 701, 702, 18277, 18278, 475253, 475254, 475255, 12356629, 12356630, 2**31 - 1]
    df = spark.createDataFrame([(n,) for n in some], "id int")
    assert [r[0] for r in df.select(pr.option_label(F.col("id"))).collect()] == [label(n) for n in some]


def test_strip_equals_the_plain_pattern_and_takes_long_runs(spark):
    from pyspark.sql import functions as F

    from tessera.functions.text import strip
    texts = [a + m + b for a in ("", " ", "\n\t ", "\u2028") for m in ("", "x", "x  y", "\u0085", "x\r\ny", "\u00a0") for b in ("", " ", "\n", " \r\n", " \u2028", "\u0085 ", "\x0b\f", " \n\u2029")]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    assert all(r.a == r.b for r in df.select(strip("t").alias("a"), F.regexp_replace("t", r"^\s+|\s+$", "").alias("b")).collect())
    long = spark.range(1).select(F.concat(F.lit("a"), F.repeat(F.lit(" "), 300_000), F.lit("b")).alias("t"))
    start = time.time()
    assert long.select(F.length(strip("t"))).first()[0] == 300_002
    assert time.time() - start < 20

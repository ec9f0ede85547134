"""Derived relations: how each operator family gets its input from the driver
tables. Every relation is a lazy DataFrame over the given tables, so its size
grows with them; nothing is generated on the driver.

Rules (shared with the DuckDB oracle in ``tessera.plans.oracle``):

- labelled      documents ⋈ labels on doc_id
- split         doc_id % 10: 0-7 train, 8 validation, 9 test
- preds         y_true = quality; y_base = doc_id % 2; y_ft = n_chars >= 1400
- pairs         assistant turn (candidate) with the user turn before it
                (reference) and the user turn after it (second reference);
                where conv_id % 10 = 0 the candidate is the upper-cased reference
- src_ref_hyp   turns t, t+1, t+2 of one conversation
- bio           word tokens of each whole document; gold tag: capitalised
                token opens (B-) or, after a capitalised token, continues (I-),
                type by token length % 3; predicted: same, only tokens longer
                than 3 characters
- boundaries    events per user ordered by (ts, event_id); gold = 'signup';
                predicted = 'signup' with value > 50 or 'error' with value > 100
- attempts      orders: problem = o_custkey, passed = o_orderstatus 'F'
- judgements    events: item = user_id; purchase win, view tie, error loss
- json_out      gold = props; predicted cut by one character when
                event_id % 10 = 0, else k := event_id % 100 when event_id % 7 = 0
- vec_pairs     embeddings: sentence pair = vec_id div 8, candidate side =
                even vec_id, reference side = odd vec_id
- page_stream   documents as OCR pages: stream = source, page order = doc_id
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import CAPITALISED_PATTERN, word_tokens
from .tables import read_table

ENTITY_TYPES = ("PER", "ORG", "LOC")  # by token length % 3


def split_of(id_col: Column | str) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    r = F.pmod(c, F.lit(10))
    return F.when(r < 8, F.lit("train")).when(r == 8, F.lit("validation")).otherwise(F.lit("test"))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    labels = read_table(spark, sf, "labels")
    return docs.join(labels, "doc_id")


def with_split(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return df.withColumn("split", split_of(id_col))


def preds(spark: SparkSession, sf: str) -> DataFrame:
    """(example_id, y_true, y_base, y_ft) with string labels."""
    lab = labelled(spark, sf)
    return lab.select(
        F.col("doc_id").alias("example_id"),
        F.col("quality").cast("string").alias("y_true"),
        F.pmod(F.col("doc_id"), F.lit(2)).cast("string").alias("y_base"),
        F.when(F.col("n_chars") >= 1400, F.lit("1")).otherwise(F.lit("0")).alias("y_ft"),
    )


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """(conv_id, turn, candidate, reference, reference2). Turn numbers have no
    gaps, so the neighbouring turns are equi-joins on turn ± 1."""
    conv = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    cand = conv.where(F.col("role") == "assistant").select("conv_id", "turn", F.col("text").alias("_cand"))
    prev = conv.where(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("reference"))
    nxt = conv.where(F.col("role") == "user").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reference2"))
    j = cand.join(prev, ["conv_id", "turn"]).join(nxt, ["conv_id", "turn"], "left")
    candidate = F.when(F.pmod(F.col("conv_id"), F.lit(10)) == 0,
                       F.upper(F.replace(F.col("reference"), F.lit("ß"), F.lit("ss")))).otherwise(F.col("_cand"))
    return j.select("conv_id", "turn", candidate.alias("candidate"), "reference", "reference2")


def src_ref_hyp(spark: SparkSession, sf: str) -> DataFrame:
    conv = read_table(spark, sf, "conversations").select("conv_id", "turn", "text")
    a = conv.select("conv_id", "turn", F.col("text").alias("source"))
    b = conv.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reference"))
    c = conv.select("conv_id", (F.col("turn") - 2).alias("turn"), F.col("text").alias("hypothesis"))
    return a.join(b, ["conv_id", "turn"]).join(c, ["conv_id", "turn"])


def _tag(tok: Column, prev_tok: Column, restrict: bool) -> Column:
    def is_ent(t: Column) -> Column:
        cond = t.rlike(CAPITALISED_PATTERN)
        if restrict:
            cond = cond & (F.length(t) > 3)
        return F.coalesce(cond, F.lit(False))

    etype = F.element_at(F.array(*[F.lit(x) for x in ENTITY_TYPES]), (F.pmod(F.length(tok), F.lit(3)) + 1).cast("int"))
    return (F.when(~is_ent(tok), F.lit("O"))
            .when(is_ent(prev_tok), F.concat(F.lit("I-"), etype))
            .otherwise(F.concat(F.lit("B-"), etype)))


def bio_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Per document: (doc_id, tokens, gold_tags, pred_tags) as arrays — tags
    are computed inside the row from each token and the one before it."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    toks = docs.select("doc_id", word_tokens("text").alias("tokens"))
    prev = lambda i: F.get(F.col("tokens"), i - 1)  # noqa: E731 - null before the first token
    return toks.select(
        "doc_id", "tokens",
        F.transform("tokens", lambda t, i: _tag(t, prev(i), False)).alias("gold_tags"),
        F.transform("tokens", lambda t, i: _tag(t, prev(i), True)).alias("pred_tags"))


def bio(spark: SparkSession, sf: str) -> DataFrame:
    """Exploded token rows (doc_id, pos, token, gold_tag, pred_tag)."""
    a = bio_arrays(spark, sf)
    ex = (a.select("doc_id", F.posexplode_outer(F.arrays_zip("tokens", "gold_tags", "pred_tags")).alias("pos", "z"))
          .where(F.col("pos").isNotNull()))
    return ex.select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("z.tokens").alias("token"),
                     F.col("z.gold_tags").alias("gold_tag"), F.col("z.pred_tags").alias("pred_tag"))


def boundaries(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events")
    gold = (F.col("event_type") == "signup")
    pred = ((F.col("event_type") == "signup") & (F.col("value") > 50)) | \
           ((F.col("event_type") == "error") & (F.col("value") > 100))
    return ev.select(F.col("user_id").alias("stream"), "ts", "event_id",
                     gold.cast("int").alias("gold_b"), F.coalesce(pred, F.lit(False)).cast("int").alias("pred_b"))


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    return o.select(F.col("o_custkey").alias("problem"), F.col("o_orderkey").alias("attempt"),
                    (F.col("o_orderstatus") == "F").alias("passed"))


def judgements(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events")
    score = (F.when(F.col("event_type") == "purchase", F.lit(1.0))
             .when(F.col("event_type") == "view", F.lit(0.5))
             .when(F.col("event_type") == "error", F.lit(0.0)))
    return (ev.where(F.col("event_type").isin("purchase", "view", "error"))
            .select(F.col("user_id").alias("item"), "event_id", "event_type", score.alias("score")))


def json_out(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events")
    eid = F.col("event_id")
    pred = (F.when(F.pmod(eid, F.lit(10)) == 0, F.expr("substring(props, 1, length(props) - 1)"))
            .when(F.pmod(eid, F.lit(7)) == 0,
                  F.concat(F.lit('{"k": '), F.pmod(eid, F.lit(100)).cast("string"), F.lit("}")))
            .otherwise(F.col("props")))
    return ev.select(eid.alias("example_id"), F.col("props").alias("gold"), pred.alias("pred"))


def vec_pairs(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "embeddings")
    return e.select(F.floor(F.col("vec_id") / 8).cast("long").alias("pair_id"),
                    F.when(F.pmod(F.col("vec_id"), F.lit(2)) == 0, F.lit("cand")).otherwise(F.lit("ref")).alias("side"),
                    "vec_id", "embedding")


def page_stream(spark: SparkSession, sf: str) -> DataFrame:
    d = read_table(spark, sf, "documents")
    return d.select(F.col("source").alias("stream"), F.col("doc_id").alias("page"), "lang", "text")

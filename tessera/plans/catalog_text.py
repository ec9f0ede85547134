"""Registered text-metric queries (M1-M14) and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import textmetrics as tm
from ..sources import fixtures as fx
from ..sources.tables import read_table
from . import sqlparts as q
from .catalog import R6, r6, register

PK = ["conv_id", "turn"]


def _em_sql():
    c = q.normalise("candidate")
    return f"""
WITH {q.PAIRS}
SELECT CAST(count(*) AS BIGINT) AS n,
  round(avg(CASE WHEN ({c} = {q.normalise('reference')} AND reference IS NOT NULL)
               OR ({c} = {q.normalise('reference2')} AND reference2 IS NOT NULL) THEN 1.0 ELSE 0.0 END), 6) AS exact_match
FROM pairs"""


@register("m1_exact_match", _em_sql())
def m1_exact_match(spark, sf):
    out = tm.exact_match(fx.pairs(spark, sf), "candidate", ["reference", "reference2"])
    return out.select("n", r6(F.col("exact_match")).alias("exact_match"))


def _tf1_sql():
    parts = []
    for g in ("reference", "reference2"):
        parts.append(f"""SELECT conv_id, turn, c, r,
   (SELECT CAST(count(*) AS BIGINT) FROM (SELECT 1)) AS one FROM (SELECT conv_id, turn, {q.norm_tokens('candidate')} AS c,
   {q.norm_tokens(g)} AS r FROM pairs WHERE {g} IS NOT NULL)""")
    u = " UNION ALL ".join(f"SELECT conv_id, turn, c, r FROM ({p})" for p in parts)
    return f"""
WITH {q.PAIRS}, bt AS (SELECT row_number() OVER () AS gid, * FROM ({u})),
cnt AS ({q.gram_counts('bt', ['gid'], {'c': {1: 'c'}, 'r': {1: 'r'}})}),
ov AS (SELECT gid, sum(least(c, r)) AS ov FROM cnt GROUP BY gid),
f AS (SELECT bt.conv_id, bt.turn, len(bt.c) AS nc, len(bt.r) AS nr, coalesce(ov.ov, 0) AS ov FROM bt LEFT JOIN ov USING (gid)),
f1 AS (SELECT conv_id, turn, CASE WHEN nc = 0 AND nr = 0 THEN 1.0 WHEN nc = 0 OR nr = 0 THEN 0.0
   WHEN ov = 0 THEN 0.0 ELSE 2 * (ov / nc) * (ov / nr) / ((ov / nc) + (ov / nr)) END AS f1 FROM f),
best AS (SELECT conv_id, turn, max(f1) AS f1 FROM f1 GROUP BY ALL)
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(f1), 6) AS token_f1 FROM best"""


@register("m2_token_f1", _tf1_sql())
def m2_token_f1(spark, sf):
    out = tm.token_f1(fx.pairs(spark, sf), PK, "candidate", ["reference", "reference2"])
    return out.select("n", r6(F.col("token_f1")).alias("token_f1"))


def _rouge_sql(n):
    return f"""
WITH {q.PAIRS}, {q.overlap_stats('pairs', PK, 'candidate', 'reference', [n])},
pr AS (SELECT CASE WHEN c_total = 0 THEN 0.0 ELSE overlap / c_total END AS p,
              CASE WHEN r_total = 0 THEN 0.0 ELSE overlap / r_total END AS r FROM st)
SELECT CAST(count(*) AS BIGINT) AS n_pairs,
       round(avg(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END), 6) AS rouge_{n} FROM pr"""


for _n in (1, 2):
    def _mk(n):
        def build(spark, sf):
            out = tm.rouge_n(fx.pairs(spark, sf), PK, "candidate", "reference", n)
            return out.select("n_pairs", r6(F.col(f"rouge_{n}")).alias(f"rouge_{n}"))
        return build
    register(f"m3_rouge_{_n}", _rouge_sql(_n))(_mk(_n))


def _pair_words(a="candidate", b="reference"):
    return f"SELECT {q.tokens(a, True)} AS a, {q.tokens(b, True)} AS b FROM pairs"


@register("m4_rouge_l", f"""
WITH RECURSIVE {q.PAIRS}, {q.aligned_words(_pair_words())}, {q.common_rows('lcs')},
pr2 AS (SELECT CASE WHEN len(a) = 0 THEN 0.0 ELSE d / len(a) END AS p, CASE WHEN len(b) = 0 THEN 0.0 ELSE d / len(b) END AS r FROM {q.alignment_value('lcs')})
SELECT CAST(count(*) AS BIGINT) AS n_pairs, round(avg(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END), 6) AS rouge_l FROM pr2
""")
def m4_rouge_l(spark, sf):
    out = tm.rouge_l(fx.pairs(spark, sf), "candidate", "reference")
    return out.select("n_pairs", r6(F.col("rouge_l")).alias("rouge_l"))


def _bleu_sql(src_cte, src, cand, ref, out="bleu", digits=6):
    orders = [1, 2, 3, 4]
    return f"""
WITH {src_cte}, {q.overlap_stats(src, PK, cand, ref, orders)},
po AS (SELECT n, sum(overlap) AS overlap, sum(c_total) AS c_total, sum(r_total) AS r_total FROM st GROUP BY n)
{q.bleu_select('po', 4, out=out, digits=digits)}"""


_BLEU_COLS = ["bp", "p1", "p2", "p3", "p4"]


@register("m5_bleu", _bleu_sql(q.PAIRS, "pairs", "candidate", "reference"))
def m5_bleu(spark, sf):
    out = tm.bleu(fx.pairs(spark, sf), PK, "candidate", "reference")
    return out.select(*[r6(F.col(c)).alias(c) for c in ["bleu"] + _BLEU_COLS])


def _chrf_sql():
    sides = {"c": {**{n: q.char_grams("candidate", n) for n in range(1, 7)},
                   **{100 + n: q.word_grams("ct", n) for n in (1, 2)}},
             "r": {**{n: q.char_grams("reference", n) for n in range(1, 7)},
                   **{100 + n: q.word_grams("rt", n) for n in (1, 2)}}}
    return f"""
WITH {q.PAIRS}, b AS (SELECT conv_id, turn, candidate, reference, {q.tokens('candidate', True)} AS ct,
                             {q.tokens('reference', True)} AS rt FROM pairs),
cnt AS ({q.gram_counts('b', PK, sides)}),
po AS (SELECT n, sum(least(c, r)) AS ov, sum(c) AS ct, sum(r) AS rt FROM cnt GROUP BY n),
pr AS (SELECT avg(ov / ct) AS precision, avg(ov / rt) AS recall, CAST(count(*) AS BIGINT) AS n_orders
       FROM po WHERE ct > 0 AND rt > 0)
SELECT round(precision, 6) AS precision, round(recall, 6) AS recall, n_orders,
       round(coalesce(CASE WHEN precision + recall = 0 THEN 0.0
                      ELSE 5 * precision * recall / (4 * precision + recall) END, 0.0), 6) AS chrf FROM pr"""


@register("m6_chrf_plus_plus", _chrf_sql())
def m6_chrf(spark, sf):
    out = tm.chrf(fx.pairs(spark, sf), PK, "candidate", "reference")
    return out.select(r6(F.col("precision")).alias("precision"), r6(F.col("recall")).alias("recall"), "n_orders",
                      r6(F.col("chrf")).alias("chrf"))


@register("m7_word_edit_rate", f"""
WITH RECURSIVE {q.PAIRS}, {q.aligned_words(_pair_words())}, {q.distance_rows('dist')},
s AS (SELECT CAST(sum(d) AS BIGINT) AS edits, CAST(sum(len(b)) AS BIGINT) AS ref_words FROM {q.alignment_value('dist')})
SELECT edits, ref_words, round(CASE WHEN ref_words = 0 THEN 0.0 ELSE edits / ref_words END, 6) AS word_edit_rate FROM s
""")
def m7_word_edit_rate(spark, sf):
    out = tm.word_edit_rate(fx.pairs(spark, sf), "candidate", "reference")
    return out.select("edits", "ref_words", r6(F.col("word_edit_rate")).alias("word_edit_rate"))


@register("m8_self_bleu", _bleu_sql(q.SRH, "srh", "hypothesis", "source", out="self_bleu"))
def m8_self_bleu(spark, sf):
    out = tm.self_bleu(fx.src_ref_hyp(spark, sf), PK, "hypothesis", "source")
    return out.select(*[r6(F.col(c)).alias(c) for c in ["self_bleu"] + _BLEU_COLS])


def _ibleu_sql():
    a = _bleu_sql(q.SRH, "srh", "hypothesis", "reference", digits=15).replace("WITH ", "", 1)
    b = _bleu_sql(q.SRH, "srh", "hypothesis", "source", digits=15).replace("WITH ", "", 1)
    return f"""
WITH b1 AS (FROM (WITH {a})), b2 AS (FROM (WITH {b}))
SELECT round(b1.bleu, 6) AS bleu_ref, round(b2.bleu, 6) AS bleu_src, round(0.9 * b1.bleu - 0.1 * b2.bleu, 6) AS ibleu
FROM b1, b2"""


@register("m9_ibleu", _ibleu_sql())
def m9_ibleu(spark, sf):
    out = tm.ibleu(fx.src_ref_hyp(spark, sf), PK, "hypothesis", "reference", "source", alpha=0.9)
    return out.select(r6(F.col("bleu_ref")).alias("bleu_ref"), r6(F.col("bleu_src")).alias("bleu_src"),
                      r6(F.col("ibleu")).alias("ibleu"))


def _gleu_sql():
    orders = [1, 2, 3, 4]
    sides = {"h": {n: q.word_grams("h", n) for n in orders}, "r": {n: q.word_grams("r", n) for n in orders},
             "s": {n: q.word_grams("s", n) for n in orders}}
    return f"""
WITH {q.SRH}, b AS (SELECT conv_id, turn, {q.tokens('hypothesis', True)} AS h, {q.tokens('reference', True)} AS r,
                           {q.tokens('source', True)} AS s FROM srh),
cnt AS ({q.gram_counts('b', PK, sides)}),
po0 AS (SELECT n, sum(least(h, r)) AS m_hr, sum(greatest(0, least(h, s) - least(h, r))) AS pen,
               sum(h) AS c_total, sum(r) AS r_total FROM cnt GROUP BY n),
po AS (SELECT *, greatest(0, m_hr - pen) AS num FROM po0)
{q.bleu_select('po', 4, num='num', den='c_total', out='gleu_plus')}"""


@register("m10_gleu_plus", _gleu_sql())
def m10_gleu_plus(spark, sf):
    out = tm.gleu_plus(fx.src_ref_hyp(spark, sf), PK, "hypothesis", "reference", "source")
    return out.select(*[r6(F.col(c)).alias(c) for c in ["gleu_plus"] + _BLEU_COLS])


def _sari_sql():
    orders = [1, 2, 3, 4]
    sides = {"s": {n: q.word_grams("s", n) for n in orders}, "h": {n: q.word_grams("h", n) for n in orders},
             "r": {n: q.word_grams("r", n) for n in orders}}

    def fb(a, b, c):
        p = f"(CASE WHEN {b} = 0 THEN 0.0 ELSE {a} / {b} END)"
        r = f"(CASE WHEN {c} = 0 THEN 0.0 ELSE {a} / {c} END)"
        return f"(CASE WHEN {p} + {r} = 0 THEN 0.0 ELSE 2 * {p} * {r} / ({p} + {r}) END)"
    return f"""
WITH {q.SRH}, b AS (SELECT conv_id, turn, {q.tokens('source', True)} AS s, {q.tokens('hypothesis', True)} AS h,
                           {q.tokens('reference', True)} AS r FROM srh),
cnt AS ({q.gram_counts('b', PK, sides)}),
per AS (SELECT conv_id, turn, n,
   count(*) FILTER (WHERE h > 0 AND s > 0 AND r > 0) AS keep_ok, count(*) FILTER (WHERE h > 0 AND s > 0) AS keep_h,
   count(*) FILTER (WHERE s > 0 AND r > 0) AS keep_r, count(*) FILTER (WHERE h > 0 AND s = 0 AND r > 0) AS add_ok,
   count(*) FILTER (WHERE h > 0 AND s = 0) AS add_h, count(*) FILTER (WHERE r > 0 AND s = 0) AS add_r,
   count(*) FILTER (WHERE s > 0 AND h = 0 AND r = 0) AS del_ok, count(*) FILTER (WHERE s > 0 AND h = 0) AS del_h
   FROM cnt GROUP BY ALL),
grid AS (SELECT conv_id, turn, unnest([1, 2, 3, 4]) AS n FROM srh),
g AS (SELECT grid.conv_id, grid.turn, grid.n, coalesce(keep_ok, 0) AS keep_ok, coalesce(keep_h, 0) AS keep_h,
   coalesce(keep_r, 0) AS keep_r, coalesce(add_ok, 0) AS add_ok, coalesce(add_h, 0) AS add_h, coalesce(add_r, 0) AS add_r,
   coalesce(del_ok, 0) AS del_ok, coalesce(del_h, 0) AS del_h FROM grid LEFT JOIN per USING (conv_id, turn, n)),
sn AS (SELECT conv_id, turn, ({fb('keep_ok', 'keep_h', 'keep_r')} + {fb('add_ok', 'add_h', 'add_r')}
   + (CASE WHEN del_h = 0 THEN 0.0 ELSE del_ok / del_h END)) / 3.0 AS s_n FROM g),
sr AS (SELECT conv_id, turn, avg(s_n) AS sari FROM sn GROUP BY ALL)
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(sari), 6) AS sari FROM sr"""


@register("m12_sari", _sari_sql())
def m12_sari(spark, sf):
    out = tm.sari(fx.src_ref_hyp(spark, sf), PK, "source", "hypothesis", "reference")
    return out.select("n", r6(F.col("sari")).alias("sari"))


@register("m13_gulpease", """
SELECT doc_id, CAST(length(regexp_replace(text, '[^\\p{L}]', '', 'g')) AS BIGINT) AS letters,
       CAST(len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS BIGINT) AS words,
       CAST(greatest(len(regexp_extract_all(text, '[.!?]+')), 1) AS BIGINT) AS sentences,
       round(CASE WHEN len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) > 0 THEN
         89 + (300 * greatest(len(regexp_extract_all(text, '[.!?]+')), 1) - 10 * length(regexp_replace(text, '[^\\p{L}]', '', 'g')))
              / len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) END, 6) AS gulpease
FROM documents
""")
def m13_gulpease(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    g = tm.gulpease(d)
    return g.select("doc_id", "letters", "words", "sentences", r6(F.col("gulpease")).alias("gulpease"))


@register("m14_perplexity", """
SELECT event_type, round(sum(CAST(json_extract(props, '$.k') AS INTEGER) + 1), 6) AS tokens,
       round(exp(sum((value / 100.0) * (CAST(json_extract(props, '$.k') AS INTEGER) + 1))
                 / sum(CAST(json_extract(props, '$.k') AS INTEGER) + 1)), 6) AS perplexity
FROM events GROUP BY event_type
""")
def m14_perplexity(spark, sf):
    ev = read_table(spark, sf, "events").select(
        "event_type", (F.col("value") / 100.0).alias("loss"),
        (F.get_json_object("props", "$.k").cast("int") + 1).alias("w"))
    p = tm.perplexity(ev, "loss", "w", ["event_type"])
    return p.select("event_type", r6(F.col("tokens")).alias("tokens"), r6(F.col("perplexity")).alias("perplexity"))

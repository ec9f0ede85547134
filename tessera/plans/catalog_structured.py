"""Registered extraction / judgement / segmentation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import word_tokens
from ..operators import segments as sg
from ..operators import structured as st
from ..operators.alignment import text_edits
from ..sources import fixtures as fx
from ..sources.tables import read_table
from . import sqlparts as q
from .catalog import r6, register

PRF = ["tp", "fp", "fn", "precision", "recall", "f"]


def _prf_out(df, extra=()):
    return df.select(*extra, "tp", "fp", "fn", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f")])


def _prf_sql(flags: str, by: str | None = None, beta: float = 1.0) -> str:
    """SELECT over a (keys..., g, p) relation: micro row, or per-`by` rows + micro + macro."""
    b2 = beta * beta

    def sc(src, group):
        sel = f"{group + ', ' if group else ''}CAST(sum(g * p) AS BIGINT) AS tp, CAST(sum((1 - g) * p) AS BIGINT) AS fp, " \
              f"CAST(sum(g * (1 - p)) AS BIGINT) AS fn FROM {src}{' GROUP BY ' + group if group else ''}"
        return (f"(SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision, "
                f"CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall FROM (SELECT {sel}))")

    def f(pcol="precision", rcol="recall"):
        return f"CASE WHEN {pcol} + {rcol} = 0 THEN 0.0 ELSE (1 + {b2}) * {pcol} * {rcol} / ({b2} * {pcol} + {rcol}) END"
    micro = f"SELECT 'micro' AS scope, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round({f()}, 6) AS f FROM {sc(flags, None)}"
    if not by:
        return micro
    per = f"(SELECT *, {f()} AS f FROM {sc(flags, by)})"
    return (f"SELECT 'type' AS scope, {by}, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, "
            f"round(f, 6) AS f FROM {per} UNION ALL SELECT scope, NULL, tp, fp, fn, precision, recall, f FROM ({micro}) "
            f"UNION ALL SELECT 'macro', NULL, CAST(sum(tp) AS BIGINT), CAST(sum(fp) AS BIGINT), CAST(sum(fn) AS BIGINT), "
            f"round(avg(precision), 6), round(avg(recall), 6), round(avg(f), 6) FROM {per}")


def _flags(gold: str, pred: str, keys: str) -> str:
    return (f"(SELECT {keys}, max(g) AS g, max(p) AS p FROM (SELECT {keys}, 1 AS g, 0 AS p FROM {gold} "
            f"UNION ALL SELECT {keys}, 0, 1 FROM {pred}) GROUP BY {keys})")


def _spans_sql(tagcol: str, name: str) -> str:
    et = "CASE WHEN t LIKE 'B-%' OR t LIKE 'I-%' THEN substring(t, 3) END"
    etp = "CASE WHEN pt LIKE 'B-%' OR pt LIKE 'I-%' THEN substring(pt, 3) END"
    return (f"{name}_t AS (SELECT doc_id, pos, {tagcol} AS t, lag({tagcol}) OVER (PARTITION BY doc_id ORDER BY pos) AS pt FROM bio), "
            f"{name}_s AS (SELECT doc_id, pos, t, sum(CASE WHEN t <> 'O' AND NOT coalesce(t LIKE 'I-%' AND pt IS NOT NULL "
            f"AND pt <> 'O' AND {etp} = {et}, false) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS span, {et} AS type FROM {name}_t), "
            f"{name} AS (SELECT doc_id, min(pos) AS start, max(pos) AS \"end\", arg_min(type, pos) AS type "
            f"FROM {name}_s WHERE t <> 'O' GROUP BY doc_id, span)")


# ---------------------------------------------------------------- M15-M18, M11

@register("m15_set_prf", f"""
WITH {q.bio_cte()}
{_prf_sql(_flags("(SELECT doc_id, lower(token) AS token FROM bio WHERE gold_tag <> 'O')",
                 "(SELECT doc_id, lower(token) AS token FROM bio WHERE pred_tag <> 'O')", "doc_id, token"))}
""")
def m15_set_prf(spark, sf):
    """Set P/R/F over (document, entity word) items."""
    b = fx.bio(spark, sf)
    g = b.where(F.col("gold_tag") != "O").select("doc_id", F.lower("token").alias("token"))
    p = b.where(F.col("pred_tag") != "O").select("doc_id", F.lower("token").alias("token"))
    return _prf_out(st.set_prf(g, p, ["doc_id", "token"]), ["scope"])


@register("m16_bio_to_spans", f"""
WITH {q.bio_cte()}, {_spans_sql('gold_tag', 'gs')}
SELECT doc_id, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end", type FROM gs
""")
def m16_bio_to_spans(spark, sf):
    return st.spans_from_tags(fx.bio_arrays(spark, sf), "gold_tags").select("doc_id", "start", "end", "type")


@register("m17_span_f1", f"""
WITH {q.bio_cte()}, {_spans_sql('gold_tag', 'gs')}, {_spans_sql('pred_tag', 'ps')}
{_prf_sql(_flags('gs', 'ps', 'doc_id, start, "end", type'), by='type')}
""")
def m17_span_f1(spark, sf):
    return _prf_out(st.span_f1_arrays(fx.bio_arrays(spark, sf)), ["scope", "type"])


def _triples_frame(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    head = F.concat(F.lit("order "), F.col("l_orderkey").cast("string"))
    gold = F.struct(head.alias("head"), F.lit("contains").alias("relation"),
                    F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("tail"))
    pred_tail = F.when(F.col("l_linenumber") == 3, F.concat(F.lit("part "), F.col("l_suppkey").cast("string"))) \
        .otherwise(F.concat(F.lit("part "), F.col("l_partkey").cast("string")))
    pred = F.when(F.col("l_linenumber") != 5, F.struct(head.alias("head"), F.lit("contains").alias("relation"),
                                                        pred_tail.alias("tail")))
    per = li.groupBy("l_orderkey").agg(F.to_json(F.collect_list(gold)).alias("gold_json"),
                                       F.to_json(F.collect_list(pred)).alias("pred_json"))
    return per


@register("m18_triple_f1", f"""
WITH g AS (SELECT DISTINCT l_orderkey, 'order ' || l_orderkey AS head, 'contains' AS relation, 'part ' || l_partkey AS tail FROM lineitem),
p AS (SELECT DISTINCT l_orderkey, 'order ' || l_orderkey AS head, 'contains' AS relation,
      'part ' || CASE WHEN l_linenumber = 3 THEN l_suppkey ELSE l_partkey END AS tail FROM lineitem WHERE l_linenumber <> 5)
{_prf_sql(_flags('g', 'p', 'l_orderkey, head, relation, tail'))}
""")
def m18_triple_f1(spark, sf):
    return _prf_out(st.triple_f1(_triples_frame(spark, sf), "l_orderkey", "gold_json", "pred_json"), ["scope"])


_EDITS = ("(SELECT doc_id AS example_id, pos AS start, pos + 1 AS \"end\", upper(token) AS replacement "
          "FROM bio WHERE {tag} <> 'O')")


@register("m11_edit_f05", "WITH " + q.bio_cte() + " " + _prf_sql(
    _flags(_EDITS.format(tag="gold_tag"), _EDITS.format(tag="pred_tag"), 'example_id, start, "end", replacement'),
    beta=0.5))
def m11_edit_f05(spark, sf):
    b = fx.bio(spark, sf)

    def edits(tag):
        return b.where(F.col(tag) != "O").select(F.col("doc_id").alias("example_id"), F.col("pos").alias("start"),
                                                 (F.col("pos") + 1).alias("end"), F.upper("token").alias("replacement"))
    return _prf_out(st.edit_f05(edits("gold_tag"), edits("pred_tag")), ["scope"])


@register("m11_text_edits_f05")
def m11_text_edits_f05(spark, sf):
    """F0.5 over the edits of text pairs: source to reference against source
    to hypothesis."""
    srh = fx.src_ref_hyp(spark, sf)
    keys = ["conv_id", "turn"]
    gold, pred = (text_edits(srh, keys, "source", c) for c in ("reference", "hypothesis"))
    return _prf_out(st.edit_f05(gold, pred, (*keys, "start", "end", "replacement")), ["scope"])


# ---------------------------------------------------------------- M19, M21

def _sql_pairs_frame(spark, sf):
    """Gold queries and eight kinds of predictions: the first two say the
    same as gold, the others do not (or are no query)."""
    p = read_table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    size = F.col("p_size").cast("string")
    brand = F.concat(F.lit("'"), F.col("p_brand"), F.lit("'"))

    def query(select, where_brand=brand, op=" > ", tail=F.lit(" ORDER BY p_size")):
        return F.concat(F.lit(f"SELECT {select} FROM part WHERE p_brand = "), where_brand, F.lit(f" AND p_size{op}"), size, tail)

    gold = query("p_name, p_size")
    v = F.pmod("p_partkey", F.lit(8))
    pred = (F.when(v == 0, gold)
            .when(v == 1, F.concat(F.lit("select p_size ,\n  p_name\nfrom part\nwhere p_size >"), size,
                                   F.lit("\n  and p_brand = "), brand, F.lit("\norder by\tp_size ")))
            .when(v == 2, query("p_name, p_size", op=" >= "))
            .when(v == 3, query("p_name, p_size", tail=F.lit("")))
            .when(v == 4, query("p_name, p_size", where_brand=F.lower(brand)))
            .when(v == 5, query("p_name,\n p_type"))
            .when(v == 6, query("p_name, p_size", tail=F.lit(" ORDER BY p_size LIMIT 3")))
            .otherwise(F.lit("SELECT 1")))
    return p.select("p_partkey", gold.alias("gold"), pred.alias("pred"))


@register("m19_clause_match", """
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN p_partkey % 8 IN (0, 1) THEN 1.0 ELSE 0.0 END), 6) AS exact_set_match FROM part
""")
def m19_clause_match(spark, sf):
    m = st.clause_match(_sql_pairs_frame(spark, sf), "gold", "pred")
    return m.agg(F.count(F.lit(1)).alias("n"),
                 r6(F.avg(F.col("exact_set_match").cast("double"))).alias("exact_set_match"))


_CLAUSE_ITEMS = ["p_name", "count(p_size, p_type)", "max(p_size)", "concat(p_name, ' from ', p_brand)"]


def _item_bits(bits):
    """Items whose bit is set, as an array."""
    chosen = [F.when(F.floor(bits / 2 ** i) % 2 == 1, F.lit(x)) for i, x in enumerate(_CLAUSE_ITEMS)]
    return F.array_compact(F.array(*chosen))


def _clause_sets_sql():
    def bits(b):
        return "list_filter([" + ", ".join(f"CASE WHEN ({b}) // {2 ** i} % 2 = 1 THEN {q.lit(x)} END" for i, x in enumerate(_CLAUSE_ITEMS)) + "], lambda x: x IS NOT NULL)"

    brand = "'p_brand=' || p_brand || ', from x'"
    return f"""
WITH s AS (SELECT p_partkey, list_sort({bits('p_partkey % 15 + 1')}) AS g, list_sort({bits('p_partkey * 7 % 15 + 1')}) AS p,
  list_sort([{brand}, 'p_size>' || p_size]) AS gw,
  list_sort(['p_size>' || (p_size + CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END), {brand}]) AS pw FROM part)
SELECT p_partkey, g = p AND gw = pw AS exact_set_match FROM s"""


@register("m19_clause_sets", _clause_sets_sql())
def m19_clause_sets(spark, sf):
    """Queries whose item sets follow from the keys, with function calls and
    literals that hold commas and clause words; items in another order and
    spacing on the predicted side."""
    p = read_table(spark, sf, "part")
    brand = F.concat(F.lit("p_brand = '"), F.col("p_brand"), F.lit(", from x'"))
    size = lambda more: F.concat(F.lit("p_size > "), (F.col("p_size") + more).cast("string"))
    gold = F.concat(F.lit("SELECT "), F.array_join(_item_bits(F.col("p_partkey") % 15 + 1), ", "), F.lit(" FROM part WHERE "), brand, F.lit(" AND "), size(F.lit(0)))
    changed = F.when(F.col("p_partkey") % 4 == 0, 1).otherwise(0)
    pred = F.concat(F.lit("select\n "), F.array_join(F.reverse(_item_bits(F.col("p_partkey") * 7 % 15 + 1)), " ,"), F.lit("\nfrom part where  "), size(changed), F.lit(" and "), brand)
    return st.clause_match(p.select("p_partkey", gold.alias("gold"), pred.alias("pred")), "gold", "pred").select("p_partkey", "exact_set_match")


_PASS_SQL = """
WITH per AS (SELECT o_custkey, count(*) AS n, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS c FROM orders GROUP BY o_custkey),
ks AS (SELECT unnest([1, 10]) AS k)
SELECT k, CAST(count(*) FILTER (WHERE n >= k) AS BIGINT) AS n_scored, CAST(count(*) FILTER (WHERE n < k) AS BIGINT) AS n_skipped,
  round(avg(CASE WHEN n < k THEN NULL WHEN n - c < k THEN 1.0
       ELSE 1 - exp(lgamma(n - c + 1) - lgamma(n - c - k + 1) - lgamma(n + 1) + lgamma(n - k + 1)) END), 6) AS pass_at_k
FROM per, ks GROUP BY k
"""


@register("m21_pass_at_k", _PASS_SQL)
def m21_pass_at_k(spark, sf):
    r = st.pass_at_k(fx.attempts(spark, sf), [1, 10])
    return r.select(F.col("k").cast("int").alias("k"), "n_scored", "n_skipped", r6(F.col("pass_at_k")).alias("pass_at_k"))


# ---------------------------------------------------------------- M22-M25

_JSON_PRED = ("CASE WHEN event_id % 10 = 0 THEN substring(props, 1, length(props) - 1) "
              "WHEN event_id % 7 = 0 THEN '{\"k\": ' || (event_id % 100) || '}' ELSE props END")


@register("m22_json_validity", f"""
WITH j AS (SELECT {_JSON_PRED} AS pred FROM events)
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN json_valid(pred) THEN 1.0 ELSE 0.0 END), 6) AS parse_rate,
  round(avg(CASE WHEN json_valid(pred) AND json_type(pred) = 'OBJECT'
     AND coalesce(json_type(pred, '$.k') IN ('BIGINT', 'UBIGINT'), false) THEN 1.0 ELSE 0.0 END), 6) AS validity_rate FROM j
""")
def m22_json_validity(spark, sf):
    v = st.json_validity(fx.json_out(spark, sf), "pred", {"k": "integer"})
    return v.agg(F.count(F.lit(1)).alias("n"), r6(F.avg(F.col("parses").cast("double"))).alias("parse_rate"),
                 r6(F.avg(F.col("valid").cast("double"))).alias("validity_rate"))


@register("m23_field_prf", f"""
WITH j AS (SELECT event_id, props, {_JSON_PRED} AS pred FROM events),
g AS (SELECT event_id AS example_id, unnest(json_keys(props)) AS field, NULL AS value FROM j),
g2 AS (SELECT example_id, field, json_extract_string(j.props, '$.' || field) AS value FROM g JOIN j ON j.event_id = g.example_id),
p AS (SELECT event_id AS example_id, unnest(json_keys(pred)) AS field FROM j WHERE json_valid(pred)),
p2 AS (SELECT example_id, field, json_extract_string(j.pred, '$.' || field) AS value FROM p JOIN j ON j.event_id = p.example_id)
{_prf_sql(_flags('g2', 'p2', 'example_id, field, value'), by='field')}
""")
def m23_field_prf(spark, sf):
    r = st.field_prf(fx.json_out(spark, sf), "example_id", "gold", "pred")
    return _prf_out(r, ["scope", "field"])


# non-ASCII letters of the fixtures mapped to unused control bytes so that
# DuckDB's byte-wise levenshtein equals a code-point distance
_NON_ASCII = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü"
_CTRL = "".join(chr(c) for c in [1, 2, 3, 4, 5, 6, 7, 8, 11, 12, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24])


def _anls_sql():
    def norm(x):
        return f"translate({q.strip(f'lower(coalesce({x}, {q.lit(chr(0))}))')}, {q.lit(_NON_ASCII)}, {q.lit(_CTRL)})"
    p = norm("candidate")
    sims = []
    for g in ("reference", "reference2"):
        gg = norm(g)
        mx = f"greatest(length({p}), length({gg}))"
        nl = f"(CASE WHEN {mx} = 0 THEN 0.0 ELSE levenshtein({p}, {gg}) / {mx} END)"
        sims.append(f"(CASE WHEN {g} IS NULL THEN 0.0 WHEN {nl} < 0.5 THEN 1 - {nl} ELSE 0.0 END)")
    hits = " + ".join(f"(CASE WHEN {g} IS NOT NULL AND {q.normalise('candidate')} = {q.normalise(g)} THEN 1 ELSE 0 END)"
                      for g in ("reference", "reference2"))
    return f"""WITH {q.PAIRS}
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(greatest({sims[0]}, {sims[1]})), 6) AS anls,
       round(avg(least(({hits}) / 3.0, 1.0)), 6) AS vqa_accuracy FROM pairs"""


@register("m24_anls_vqa", _anls_sql())
def m24_anls_vqa(spark, sf):
    r = st.anls(fx.pairs(spark, sf), ["conv_id", "turn"], "candidate", ["reference", "reference2"])
    return r.select("n", r6(F.col("anls")).alias("anls"), r6(F.col("vqa_accuracy")).alias("vqa_accuracy"))


@register("m25_fever_score", """
WITH c AS (SELECT o_orderkey AS claim_id, o_orderstatus AS y_true,
                  CASE WHEN o_totalprice > 150000 THEN 'F' ELSE 'O' END AS y_pred FROM orders),
ge AS (SELECT l_orderkey AS claim_id, l_linenumber % 2 AS set_id, l_partkey AS item FROM lineitem WHERE l_orderkey % 7 <> 0),
pe AS (SELECT DISTINCT l_orderkey AS claim_id, l_partkey AS item FROM lineitem WHERE l_quantity > 10),
ps AS (SELECT ge.claim_id, ge.set_id, min(CASE WHEN pe.item IS NULL THEN 0 ELSE 1 END) AS is_full
       FROM ge LEFT JOIN pe ON ge.claim_id = pe.claim_id AND ge.item = pe.item GROUP BY ALL),
r AS (SELECT claim_id, max(is_full) AS retrieved FROM ps GROUP BY claim_id UNION ALL
      SELECT claim_id, 1 FROM c WHERE claim_id NOT IN (SELECT claim_id FROM ge))
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END), 6) AS label_accuracy,
       round(avg(CASE WHEN y_true = y_pred AND coalesce(retrieved, 0) = 1 THEN 1.0 ELSE 0.0 END), 6) AS fever_score
FROM c LEFT JOIN r USING (claim_id)
""")
def m25_fever_score(spark, sf):
    o = read_table(spark, sf, "orders")
    li = read_table(spark, sf, "lineitem")
    claims = o.select(F.col("o_orderkey").alias("claim_id"), F.col("o_orderstatus").alias("y_true"),
                      F.when(F.col("o_totalprice") > 150000, "F").otherwise("O").alias("y_pred"))
    # every seventh claim has no gold evidence
    ge = li.where(F.pmod("l_orderkey", F.lit(7)) != 0).select(F.col("l_orderkey").alias("claim_id"), F.pmod("l_linenumber", F.lit(2)).alias("set_id"),
                   F.col("l_partkey").alias("item"))
    pe = li.where(F.col("l_quantity") > 10).select(F.col("l_orderkey").alias("claim_id"), F.col("l_partkey").alias("item"))
    r = st.fever_score(claims, ge, pe)
    return r.select("n", r6(F.col("label_accuracy")).alias("label_accuracy"), r6(F.col("fever_score")).alias("fever_score"))


# ---------------------------------------------------------------- M26-M31

@register("m26_page_pairs", """
WITH pp0 AS (SELECT source AS stream, doc_id AS page, lang, text,
        lag(text) OVER (PARTITION BY source ORDER BY doc_id) AS prev_text,
        lag(lang) OVER (PARTITION BY source ORDER BY doc_id) AS prev_lang,
        row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM documents)
SELECT stream, page, CAST(pos AS BIGINT) AS pos,
       md5('Pagina corrente: ' || coalesce(text, '') || chr(10) || 'Pagina precedente: ' || coalesce(prev_text, '')) AS pair_md5,
       CASE WHEN prev_lang IS NULL OR prev_lang <> lang THEN 1 ELSE 0 END AS label FROM pp0
""")
def m26_page_pairs(spark, sf):
    from ..operators.segments import page_pairs
    pages = fx.page_stream(spark, sf)
    p = page_pairs(pages)
    return p.select("stream", "page", "pos", F.md5("pair_text").alias("pair_md5"),
                    F.col("label").cast("int").alias("label"))


@register("m27_boundaries_to_segments", f"""
WITH {q.BOUNDARIES}
SELECT stream, CAST(cum_gold_b AS BIGINT) AS segment, CAST(min(pos) AS BIGINT) AS start, CAST(max(pos) AS BIGINT) AS "end",
       CAST(count(*) AS BIGINT) AS n FROM bpos GROUP BY stream, cum_gold_b
""")
def m27_boundaries_to_segments(spark, sf):
    n = sg.number_events(fx.boundaries(spark, sf))
    return sg.boundaries_to_segments(n)


@register("m28_boundary_f1", """
WITH b AS (SELECT CAST(event_type = 'signup' AS INTEGER) AS g,
  CAST(coalesce((event_type = 'signup' AND value > 50) OR (event_type = 'error' AND value > 100), false) AS INTEGER) AS p FROM events),
t AS (SELECT CAST(sum(g * p) AS BIGINT) AS tp, CAST(sum((1 - g) * p) AS BIGINT) AS fp, CAST(sum(g * (1 - p)) AS BIGINT) AS fn FROM b),
s AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS pr, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS rc FROM t)
SELECT tp, fp, fn, round(pr, 6) AS precision, round(rc, 6) AS recall,
       round(CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END, 6) AS f1 FROM s
""")
def m28_boundary_f1(spark, sf):
    r = sg.boundary_prf(fx.boundaries(spark, sf))
    return r.select("tp", "fp", "fn", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


def _window_sql(wrong: str, name: str, k: str | None = None) -> str:
    return f"""
WITH {q.BOUNDARIES},
ks AS (SELECT stream, {k or "greatest(2, CAST(round(count(*) / (max(cum_gold_b) - min(cum_gold_b) + 1) / 2.0) AS BIGINT))"} AS k
       FROM bpos GROUP BY stream),
x AS (SELECT bpos.*, k FROM bpos JOIN ks USING (stream)),
w AS (SELECT a.cum_gold_b AS g0, a.cum_pred_b AS p0, b.cum_gold_b AS gk, b.cum_pred_b AS pk
      FROM x a JOIN x b ON a.stream = b.stream AND b.pos = a.pos + a.k)
SELECT CAST(count(*) AS BIGINT) AS n_windows, round(avg(CASE WHEN {wrong} THEN 1.0 ELSE 0.0 END), 6) AS {name} FROM w
"""


_WD, _PK = "(gk - g0) <> (pk - p0)", "(gk = g0) <> (pk = p0)"


@register("m29_window_diff", _window_sql(_WD, "window_diff"))
def m29_window_diff(spark, sf):
    w = sg.window_diff(sg.number_events(fx.boundaries(spark, sf)))
    return w.select("n_windows", r6(F.col("window_diff")).alias("window_diff"))


@register("m29_window_diff_k", _window_sql(_WD, "window_diff", "7"))
def m29_window_diff_k(spark, sf):
    w = sg.window_diff(sg.number_events(fx.boundaries(spark, sf)), k=7)
    return w.select("n_windows", r6(F.col("window_diff")).alias("window_diff"))


@register("m30_pk", _window_sql(_PK, "pk"))
def m30_pk(spark, sf):
    return sg.pk_metric(sg.number_events(fx.boundaries(spark, sf))).select("n_windows", r6(F.col("pk")).alias("pk"))


@register("m27_segments_to_labels", f"""
WITH {q.BOUNDARIES}
SELECT stream, CAST(pos AS BIGINT) AS pos,
       CASE WHEN pos = min(pos) OVER (PARTITION BY stream, cum_gold_b) THEN 'B-DOC' ELSE 'I-DOC' END AS label FROM bpos
""")
def m27_segments_to_labels(spark, sf):
    return sg.segments_to_labels(sg.boundaries_to_segments(sg.number_events(fx.boundaries(spark, sf))))


@register("m31_panoptic_quality", f"""
WITH {q.BOUNDARIES},
inter AS (SELECT stream, cum_gold_b, cum_pred_b, count(*) AS inter FROM bpos GROUP BY ALL),
gs AS (SELECT stream, cum_gold_b, count(*) AS ng FROM bpos GROUP BY ALL),
ps AS (SELECT stream, cum_pred_b, count(*) AS np FROM bpos GROUP BY ALL),
m AS (SELECT inter / (ng + np - inter) AS iou FROM inter JOIN gs USING (stream, cum_gold_b) JOIN ps USING (stream, cum_pred_b)),
t AS (SELECT (SELECT count(*) FROM m WHERE iou > 0.5) AS tp, (SELECT sum(iou) FROM m WHERE iou > 0.5) AS s,
             (SELECT count(*) FROM gs) AS n_gold, (SELECT count(*) FROM ps) AS n_pred)
SELECT CAST(tp AS BIGINT) AS tp, CAST(n_pred - tp AS BIGINT) AS fp, CAST(n_gold - tp AS BIGINT) AS fn,
       round(CASE WHEN tp + (n_pred - tp) / 2.0 + (n_gold - tp) / 2.0 = 0 THEN 0.0
             ELSE coalesce(s, 0.0) / (tp + (n_pred - tp) / 2.0 + (n_gold - tp) / 2.0) END, 6) AS pq FROM t
""")
def m31_panoptic_quality(spark, sf):
    n = sg.number_events(fx.boundaries(spark, sf))
    r = sg.panoptic_quality(n)
    return r.select(F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
                    F.col("fn").cast("long").alias("fn"), r6(F.col("pq")).alias("pq"))


# ---------------------------------------------------------------- M32-M35

@register("m32_win_rate", """
WITH j AS (SELECT user_id AS item, CASE event_type WHEN 'purchase' THEN 1.0 WHEN 'view' THEN 0.5 ELSE 0.0 END AS score
           FROM events WHERE event_type IN ('purchase', 'view', 'error'))
SELECT coalesce(item, -1) AS item, CAST(grouping(item) AS INTEGER) AS is_total, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(CASE WHEN score = 1.0 THEN 1 ELSE 0 END) AS BIGINT) AS wins,
       CAST(sum(CASE WHEN score = 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS ties, round(avg(score), 6) AS win_rate
FROM j GROUP BY ROLLUP (item)
""")
def m32_win_rate(spark, sf):
    r = st.win_rate(fx.judgements(spark, sf))
    return r.select(F.coalesce(F.col("item"), F.lit(-1)).cast("long").alias("item"), "is_total", "n", F.col("wins").cast("long").alias("wins"),
                    F.col("ties").cast("long").alias("ties"), r6(F.col("win_rate")).alias("win_rate"))


def _rules_col():
    c = F.col("conv_id")

    def rule(cond, name, arg):
        return F.when(cond, F.struct(F.lit(name).alias("rule"), F.lit(arg).alias("arg")))
    arr = F.array(rule(F.pmod(c, F.lit(2)) == 0, "max_words", "50"),
                  rule(F.pmod(c, F.lit(3)) == 0, "must_contain", "the"),
                  rule(F.lit(True), "ends_with", "."),
                  rule(F.pmod(c, F.lit(5)) == 0, "lower_case", ""),
                  rule(F.pmod(c, F.lit(7)) == 0, "valid_json", ""))
    return F.filter(arr, lambda x: x.isNotNull())


@register("m33_constraint_pass_rates", f"""
WITH r AS (SELECT struct_pack(c := conv_id, t := turn) AS prompt_id, coalesce(text, '') AS t, conv_id FROM conversations WHERE role = 'assistant'),
ch AS (
  SELECT prompt_id, 'max_words' AS rule, len({q.tokens('t')}) <= 50 AS passed FROM r WHERE conv_id % 2 = 0
  UNION ALL SELECT prompt_id, 'must_contain', contains(lower(t), 'the') FROM r WHERE conv_id % 3 = 0
  UNION ALL SELECT prompt_id, 'ends_with', suffix({q.strip('t')}, '.') FROM r
  UNION ALL SELECT prompt_id, 'lower_case', t = lower(t) FROM r WHERE conv_id % 5 = 0
  UNION ALL SELECT prompt_id, 'valid_json', json_valid(t) FROM r WHERE conv_id % 7 = 0)
SELECT rule, CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END), 6) AS pass_rate FROM ch GROUP BY rule
UNION ALL SELECT '__prompt__', CAST(count(*) AS BIGINT), round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 6)
FROM (SELECT prompt_id, bool_and(passed) AS ok FROM ch GROUP BY prompt_id)
""")
def m33_constraint_pass_rates(spark, sf):
    conv = read_table(spark, sf, "conversations").where(F.col("role") == "assistant")
    resp = conv.select(F.struct("conv_id", "turn").alias("prompt_id"), "text", "conv_id")
    checks = st.constraint_checks(resp.withColumn("rules", _rules_col()), "prompt_id", "text", F.col("rules"))
    r = st.constraint_pass_rates(checks, "prompt_id")
    return r.select("rule", "n", r6(F.col("pass_rate")).alias("pass_rate"))


@register("m34_grounding_overlap", f"""
WITH {q.PAIRS}, t AS (SELECT list_distinct({q.tokens('candidate', True)}) AS a, list_distinct({q.tokens('reference', True)}) AS c FROM pairs)
SELECT CAST(count(*) AS BIGINT) AS n,
       round(avg(CASE WHEN len(a) = 0 THEN 0.0 ELSE len(list_intersect(a, c)) / len(a) END), 6) AS grounding FROM t
""")
def m34_grounding_overlap(spark, sf):
    r = st.grounding_overlap(fx.pairs(spark, sf), "candidate", "reference")
    return r.select("n", r6(F.col("grounding")).alias("grounding"))


@register("m35_soft_match", """
WITH v AS (SELECT vec_id // 8 AS pair_id, CASE WHEN vec_id % 2 = 0 THEN 'cand' ELSE 'ref' END AS side, vec_id,
                  CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT c.pair_id, c.vec_id AS cid, r.vec_id AS rid,
        CASE WHEN sqrt(list_dot_product(c.v, c.v) * list_dot_product(r.v, r.v)) = 0 THEN 0.0
             ELSE list_dot_product(c.v, r.v) / sqrt(list_dot_product(c.v, c.v) * list_dot_product(r.v, r.v)) END AS s
      FROM v c JOIN v r ON c.pair_id = r.pair_id AND c.side = 'cand' AND r.side = 'ref'),
pr AS (SELECT pair_id, avg(b) AS precision FROM (SELECT pair_id, cid, max(s) AS b FROM s GROUP BY ALL) GROUP BY pair_id),
rc AS (SELECT pair_id, avg(b) AS recall FROM (SELECT pair_id, rid, max(s) AS b FROM s GROUP BY ALL) GROUP BY pair_id),
j AS (SELECT * FROM pr JOIN rc USING (pair_id))
SELECT CAST(count(*) AS BIGINT) AS n_pairs, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
       round(avg(CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END), 6) AS f1 FROM j
""")
def m35_soft_match(spark, sf):
    r = st.soft_match(fx.vec_pairs(spark, sf))
    return r.select("n_pairs", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])

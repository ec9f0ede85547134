"""Extraction, judgement and ranking metrics.

The shared kernel is ``set_prf``: gold and predicted items are unioned with a
side flag and grouped by (example, item) — one aggregation with map-side
combine instead of a full outer join, so a hot example or item type only
makes a bigger partial aggregate, never a fan-out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import let, normalise_answer, null_to_empty, strip, word_tokens
from .classes import f_beta, safe_div
from .sequence import number_within


# ------------------------------------------------------------------ M15

def item_flags(gold: DataFrame, pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., g, p): one row per distinct item, g/p = present on each side."""
    keys = list(keys)
    u = (gold.select(*keys, F.lit(1).alias("g"), F.lit(0).alias("p"))
         .unionByName(pred.select(*keys, F.lit(0).alias("g"), F.lit(1).alias("p"))))
    return u.groupBy(*keys).agg(F.max("g").alias("g"), F.max("p").alias("p"))


def set_prf(gold: DataFrame, pred: DataFrame, keys: Sequence[str], by: Sequence[str] = (),
            beta: float = 1.0) -> DataFrame:
    """Micro precision/recall/F-β over keyed items (``by`` columns must
    be part of ``keys``); with ``by``, one row per group plus the macro mean
    of the group scores in a row whose group columns are null."""
    return prf_from_flags(item_flags(gold, pred, keys), by, beta)


def prf_from_flags(flags: DataFrame, by: Sequence[str] = (), beta: float = 1.0) -> DataFrame:
    """Scores from (item..., g, p) flags."""
    agg = [F.sum(F.col("g") * F.col("p")).cast("long").alias("tp"),
           F.sum((1 - F.col("g")) * F.col("p")).cast("long").alias("fp"),
           F.sum(F.col("g") * (1 - F.col("p"))).cast("long").alias("fn")]

    def scores(df):
        p = safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
        r = safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
        return df.withColumn("precision", p).withColumn("recall", r) \
            .withColumn("f", f_beta(F.col("precision"), F.col("recall"), beta))

    if not by:
        return scores(flags.agg(*agg)).withColumn("scope", F.lit("micro"))
    # every item has one group value, so micro counts are sums of the group
    # counts: all three outputs derive from the small per-group table and
    # the item-level data is aggregated once
    counts = flags.groupBy(*by).agg(*agg)
    per = scores(counts).withColumn("scope", F.lit("type"))
    micro = scores(counts.agg(F.sum("tp").cast("long").alias("tp"), F.sum("fp").cast("long").alias("fp"),
                              F.sum("fn").cast("long").alias("fn"))).withColumn("scope", F.lit("micro"))
    macro = per.agg(F.sum("tp").cast("long").alias("tp"), F.sum("fp").cast("long").alias("fp"),
                    F.sum("fn").cast("long").alias("fn"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f").alias("f")).withColumn("scope", F.lit("macro"))
    return per.unionByName(micro, allowMissingColumns=True).unionByName(macro, allowMissingColumns=True)


# ------------------------------------------------------------- M16, M17

def _etype(tag: Column) -> Column:
    return F.when(tag.startswith("B-") | tag.startswith("I-"), F.substring(tag, 3, F.length(tag)))


def bio_to_spans(tokens: DataFrame, tag: str, doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    """BIO tags to spans (doc, start, end, type). B- opens; I- after O,
    after nothing or after another type opens; I- of the same type continues.

    The window is per document; callers hash-partition documents before
    exploding tokens (see ``fixtures.bio``) so it reuses that partitioning."""
    w = Window.partitionBy(doc).orderBy(pos)
    t = F.col(tag)
    prev = F.lag(t).over(w)
    cont = t.startswith("I-") & prev.isNotNull() & (prev != "O") & (_etype(prev) == _etype(t))
    ent = tokens.select(doc, pos, t.alias("_t"), F.when(t != "O", F.when(cont, 0).otherwise(1)).alias("_start"))
    ent = ent.withColumn("_span", F.sum(F.coalesce(F.col("_start"), F.lit(0))).over(
        Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)))
    spans = (ent.where(F.col("_t") != "O").groupBy(doc, "_span")
             .agg(F.min(pos).alias("start"), F.max(pos).alias("end"),
                  F.min_by(_etype(F.col("_t")), F.col(pos)).alias("type")))
    return spans.drop("_span")


def span_array(tags: Column) -> Column:
    """M16 inside a row: array<struct<start, end, type>> of the spans of a
    BIO tag array. Spans never overlap, so the k-th span start pairs with the
    k-th span end; both come from one pass over the indices (no explode of
    tokens, no shuffle, no window). Pass a column reference: the lambdas
    index into it."""
    t = tags
    n = F.size(t)
    idx = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def tag(i):
        return F.get(t, i)

    def cont(i):
        cur, prev = tag(i), tag(i - 1)
        return F.coalesce(cur.startswith("I-") & prev.isNotNull() & (prev != "O") & (_etype(prev) == _etype(cur)),
                          F.lit(False))

    def ent(i):
        return F.coalesce(tag(i) != "O", F.lit(False))

    starts = F.filter(idx, lambda i: ent(i) & ~cont(i))
    ends = F.filter(idx, lambda i: ent(i) & ~cont(i + 1))
    return F.zip_with(starts, ends, lambda s_, e_: F.struct(s_.cast("long").alias("start"), e_.cast("long").alias("end"),
                                                            _etype(F.get(t, s_)).alias("type")))


def spans_from_tags(df: DataFrame, tags: str, doc: str = "doc_id") -> DataFrame:
    """M16 as rows: (doc, start, end, type), 0-based inclusive positions."""
    z = df.select(doc, span_array(F.col(tags)).alias("_sp"))
    return (z.select(doc, F.explode_outer("_sp").alias("x")).where(F.col("x").isNotNull())
            .select(doc, "x.start", "x.end", "x.type"))


def span_f1_arrays(df: DataFrame, gold_tags: str = "gold_tags", pred_tags: str = "pred_tags",
                   doc: str = "doc_id") -> DataFrame:
    """M17 from per-document tag arrays: spans are decoded inside the rows
    (``span_array``); only spans reach the shuffle of the set kernel."""
    g = spans_from_tags(df, gold_tags, doc)
    p = spans_from_tags(df, pred_tags, doc)
    return set_prf(g, p, [doc, "start", "end", "type"], by=["type"])


# ------------------------------------------------------------------ M18

TRIPLE_SCHEMA = "array<struct<head:string,relation:string,tail:string>>"


def triples(df: DataFrame, example: str, json_col: str) -> DataFrame:
    """Parse a JSON list of {head, relation, tail} into one row per triple
    (unparseable text yields no triples)."""
    parsed = df.select(example, F.from_json(F.col(json_col), TRIPLE_SCHEMA).alias("_t"))
    return parsed.select(example, F.explode_outer("_t").alias("t")).where(F.col("t").isNotNull()) \
        .select(example, "t.head", "t.relation", "t.tail")


def triple_f1(df: DataFrame, example: str, gold_json: str, pred_json: str) -> DataFrame:
    """Micro P/R/F1 over {head, relation, tail} triples."""
    keys = [example, "head", "relation", "tail"]
    return set_prf(triples(df, example, gold_json), triples(df, example, pred_json), keys)


# ------------------------------------------------------------------ M11

def edit_f05(gold_edits: DataFrame, pred_edits: DataFrame,
             keys: Sequence[str] = ("example_id", "start", "end", "replacement")) -> DataFrame:
    """precision/recall/F0.5 over edit rows."""
    return set_prf(gold_edits, pred_edits, list(keys), beta=0.5)


# ------------------------------------------------------------------ M19

# clauses in the order in which they follow each other, and what ends one
_CLAUSES = ["select", "from", "where", "group by", "having", "order by", "limit"]
_SPLITTERS = {"where": r"\s+and\s+", "having": r"\s+and\s+"}


#: Marks that stand for a comma, a blank and brackets where they do not split.
_PLAIN, _HIDDEN = ", ()", "\ue000\ue001\ue002\ue003"


def _outside(pieces: Column, change) -> Column:
    """Pieces cut at quotes, joined again, with the ones outside literals changed."""
    return F.array_join(F.transform(pieces, lambda x, i: F.when(i % 2 == 0, change(x)).otherwise(F.translate(x, _PLAIN, _HIDDEN))), "'")


def _folded(q: Column) -> Column:
    """The query with white space collapsed and, outside single-quoted
    literals, in lower case without blanks beside operators and inside
    brackets; commas and blanks inside literals and brackets are hidden, so
    that they end no item and start no clause."""
    def tidy(x: Column) -> Column:
        x = F.regexp_replace(F.lower(x), r"\s*([<>=!,]+)\s*", "$1")
        return F.regexp_replace(F.regexp_replace(x, r"\(\s+", "("), r"\s+\)", ")")

    text = _outside(F.split(strip(F.regexp_replace(null_to_empty(q), r"\s+", " ")), "'", -1), tidy)
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("out"))

    def step(a: Column, x: Column) -> Column:
        depth = a["depth"] + F.when(x == "(", 1).when((x == ")") & (a["depth"] > 0), -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.concat(a["out"], F.when(depth > 0, F.translate(x, _PLAIN[:2], _HIDDEN[:2])).otherwise(x)).alias("out"))

    return F.aggregate(F.regexp_extract_all(text, F.lit(r"[^()]+|[()]"), 0), start, step, lambda a: a["out"])


def clause_items(folded: Column, clause: str) -> Column:
    """Sorted distinct items of one clause of a folded query (empty when absent)."""
    later = "|".join(c for c in _CLAUSES[_CLAUSES.index(clause) + 1:])
    end = rf"(?: (?:{later}) |$)" if later else "$"
    first = "^select " if clause == "select" else f" {clause} "
    body = F.regexp_extract(folded, rf"{first}(.*?){end}", 1)
    items = F.transform(F.split(body, _SPLITTERS.get(clause, ",")), strip)
    return F.array_sort(F.array_distinct(F.filter(items, lambda x: x != "")))


def clause_match(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """Exact set match — every clause has the same item set. Items are cut
    at depth 0 outside literals; what stands in brackets (also a subquery) is
    compared as text. A gold or predicted text that is not SELECT .. FROM .. is
    not parsed and matches nothing."""
    return df.withColumn("exact_set_match", let(F.struct(_folded(F.col(gold)).alias("g"), _folded(F.col(pred)).alias("p")), _same_clauses))


def _same_clauses(x: Column) -> Column:
    g, p = x["g"], x["p"]
    same = F.lit(True)
    for q in (g, p):
        same = same & (F.size(clause_items(q, "select")) > 0) & (F.size(clause_items(q, "from")) > 0)
    for c in _CLAUSES:
        same = same & (clause_items(g, c) == clause_items(p, c))
    return same


# ------------------------------------------------------------------ M21

def _pass_at_k_value(n: Column, c: Column, k: int) -> Column:
    """1 - C(n-c, k) / C(n, k), the ratio as a product of k factors."""
    miss = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), F.lit(1.0), lambda a, j: a * (n - c - j) / (n - j))
    return F.when(n - c < k, F.lit(1.0)).otherwise(1.0 - miss)


def pass_at_k(attempts: DataFrame, ks: Sequence[int] = (1, 10), problem: str = "problem",
              passed: str = "passed") -> DataFrame:
    """Unbiased pass@k per problem, mean over problems with n ≥ k; the
    problems with fewer attempts are counted, not scored. Attempts are first
    reduced to (n, c) per problem (partial aggregation), so the per-problem
    formula sees one row per problem."""
    per = attempts.groupBy(problem).agg(F.count(F.lit(1)).alias("n"),
                                        F.sum(F.col(passed).cast("int")).cast("long").alias("c"))
    parts = []
    for k in ks:
        scored = F.col("n") >= k
        parts += [F.count_if(scored).alias(f"s{k}"), F.count_if(~scored).alias(f"u{k}"),
                  F.avg(F.when(scored, _pass_at_k_value(F.col("n"), F.col("c"), k))).alias(f"v{k}")]
    rows = [F.struct(F.lit(k).alias("k"), F.col(f"s{k}").alias("n_scored"), F.col(f"u{k}").alias("n_skipped"),
                     F.col(f"v{k}").alias("pass_at_k")) for k in ks]
    return per.agg(*parts).select(F.inline(F.array(*rows)))


# ------------------------------------------------------------------ M22, M23

#: JSON type names of ``json_validity`` and the variant types they take.
_JSON_TYPES = {"integer": r"^(BIGINT|INT|SMALLINT|TINYINT)$", "number": r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$",
               "string": "^STRING$", "boolean": "^BOOLEAN$", "array": "^ARRAY", "object": "^OBJECT", "null": "^VOID$", "any": "."}


def json_validity(df: DataFrame, col: str, required: Mapping[str, str]) -> DataFrame:
    """M22 per row: parses as a JSON object and every required key (name to
    JSON type) is there with a value of its type."""
    v = F.try_parse_json(F.col(col))
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    ok = is_obj
    for key, kind in required.items():
        t = F.schema_of_variant(F.variant_get(v, f"$['{key}']", "variant"))
        ok = ok & F.coalesce(t.rlike(_JSON_TYPES[kind]), F.lit(False))
    return df.select("*", v.isNotNull().alias("parses"), F.coalesce(ok, F.lit(False)).alias("valid"))


def json_fields(df: DataFrame, example: str, col: str) -> DataFrame:
    """Top-level fields of a JSON object as (example, field, value) rows
    (unparseable text yields none)."""
    m = F.from_json(F.col(col), "map<string,string>")
    return (df.select(example, F.explode_outer(m).alias("field", "value"))
            .where(F.col("field").isNotNull()))


def field_prf(df: DataFrame, example: str, gold: str, pred: str) -> DataFrame:
    """Field-level precision/recall/F1, micro and per field."""
    g = json_fields(df, example, gold)
    p = json_fields(df, example, pred)
    return set_prf(g, p, [example, "field", "value"], by=["field"])


# ------------------------------------------------------------------ M24

def anls(df: DataFrame, keys: Sequence[str], pred: str, golds: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """ANLS — per gold 1 − lev/max(len) when the normalised distance is
    below the threshold, else 0; best gold; mean. Strings are lower-cased and
    stripped first. Also VQA accuracy: min(#exact golds / 3, 1)."""
    p = strip(F.lower(null_to_empty(F.col(pred))))
    sims, hits = [], []
    for g in golds:
        gs = strip(F.lower(null_to_empty(F.col(g))))
        mx = F.greatest(F.length(p), F.length(gs))
        # only distances below threshold·max_len matter: the banded form stops
        # early and returns -1 beyond the band
        band = (F.ceil(F.lit(threshold) * mx) - 1).cast("int")
        d = F.when(band >= 0, F.call_function("levenshtein", p, gs, band))
        s = (F.when(F.col(g).isNull(), F.lit(0.0))
             .when(mx == 0, F.lit(1.0))
             .when(d.isNull() | (d < 0), F.lit(0.0))
             .otherwise(1 - d.cast("double") / mx))
        sims.append(s)
        hits.append(F.when(F.col(g).isNotNull() & (normalise_answer(F.col(pred)) == normalise_answer(F.col(g))), 1)
                    .otherwise(0))
    best = F.greatest(*sims) if len(sims) > 1 else sims[0]
    matches = sum(hits[1:], hits[0])
    vqa = F.least(matches / 3.0, F.lit(1.0))
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(best).alias("anls"), F.avg(vqa).alias("vqa_accuracy"))


# ------------------------------------------------------------------ M25

def fever_score(claims: DataFrame, gold_evidence: DataFrame, pred_evidence: DataFrame,
                claim: str = "claim_id") -> DataFrame:
    """Label accuracy and FEVER score (label right and at least one gold
    evidence set fully inside the predicted evidence; a claim without gold
    evidence needs none). Set containment is a left join of gold items to
    predicted items and a count per set."""
    ge = gold_evidence.alias("g")
    pe = pred_evidence.select(claim, "item", F.lit(1).alias("_hit")).distinct()
    j = ge.join(pe, [claim, "item"], "left")
    per_set = j.groupBy(claim, "set_id").agg(F.min(F.coalesce(F.col("_hit"), F.lit(0))).alias("full"))
    any_full = per_set.groupBy(claim).agg(F.max("full").alias("retrieved"))
    c = claims.join(any_full, claim, "left")
    label_ok = (F.col("y_true") == F.col("y_pred"))
    return c.agg(F.count(F.lit(1)).alias("n"),
                 F.avg(F.when(label_ok, 1.0).otherwise(0.0)).alias("label_accuracy"),
                 F.avg(F.when(label_ok & (F.coalesce(F.col("retrieved"), F.lit(1)) == 1), 1.0).otherwise(0.0))
                 .alias("fever_score"))


# ------------------------------------------------------------------ M32

def win_rate(judgements: DataFrame, score: str = "score", by: Sequence[str] = ("item",)) -> DataFrame:
    """Wins + ties/2 over judgements, per group plus a total row
    (``is_total`` = 1, group columns null)."""
    return (judgements.rollup(*by).agg(F.grouping_id().alias("is_total"), F.count(F.lit(1)).alias("n"),
                                       F.sum(F.when(F.col(score) == 1.0, 1).otherwise(0)).alias("wins"),
                                       F.sum(F.when(F.col(score) == 0.5, 1).otherwise(0)).alias("ties"),
                                       F.avg(score).alias("win_rate"))
            .withColumn("is_total", (F.col("is_total") > 0).cast("int")))


# ------------------------------------------------------------------ M33

def constraint_checks(df: DataFrame, prompt: str, response: str, rules: Column) -> DataFrame:
    """M33 input: ``rules`` is an array<struct<rule:string, arg:string>> per
    prompt (the prompt's own instructions). One row per (prompt, rule) with
    its pass flag; no join with a rule table is needed."""
    r = null_to_empty(F.col(response))
    ex = (df.select(prompt, r.alias("_r"), F.explode_outer(rules).alias("x")).where(F.col("x").isNotNull())
          .select(prompt, "_r", "x.rule", "x.arg"))
    n_words = F.size(word_tokens(F.col("_r")))
    ok = (F.when(F.col("rule") == "max_words", n_words <= F.col("arg").cast("int"))
          .when(F.col("rule") == "min_words", n_words >= F.col("arg").cast("int"))
          .when(F.col("rule") == "must_contain", F.lower(F.col("_r")).contains(F.lower(F.col("arg"))))
          .when(F.col("rule") == "must_not_contain", ~F.lower(F.col("_r")).contains(F.lower(F.col("arg"))))
          .when(F.col("rule") == "lower_case", F.col("_r") == F.lower(F.col("_r")))
          .when(F.col("rule") == "ends_with", strip(F.col("_r")).endswith(F.col("arg")))
          .when(F.col("rule") == "valid_json", F.try_parse_json(F.col("_r")).isNotNull())
          .otherwise(F.lit(False)))
    return ex.select(prompt, "rule", F.coalesce(ok, F.lit(False)).alias("passed"))


def constraint_pass_rates(checks: DataFrame, prompt: str) -> DataFrame:
    """Per-rule pass rate plus the prompt-level rate (all rules passed)."""
    per_rule = checks.groupBy("rule").agg(F.count(F.lit(1)).alias("n"),
                                          F.avg(F.col("passed").cast("double")).alias("pass_rate"))
    per_prompt = checks.groupBy(prompt).agg(F.bool_and("passed").alias("all_passed"))
    prompt_level = per_prompt.agg(F.lit("__prompt__").alias("rule"), F.count(F.lit(1)).alias("n"),
                                  F.avg(F.col("all_passed").cast("double")).alias("pass_rate"))
    return per_rule.unionByName(prompt_level)


# ------------------------------------------------------------------ M34

def grounding_overlap(df: DataFrame, answer: str, context: str) -> DataFrame:
    """Share of distinct answer tokens found in the context, mean."""
    a = F.array_distinct(word_tokens(answer, lower=True))
    c = F.array_distinct(word_tokens(context, lower=True))
    share = F.when(F.size(a) == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, c)) / F.size(a))
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(share).alias("grounding"))


# ------------------------------------------------------------------ M35

#: Vectors of one side in a block; two blocks meet in one matrix product.
VECTOR_BLOCK = 512


def _unit(v: Column) -> Column:
    """The vector divided by its length; one of zeros stays as it is."""
    n = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(F.array(n), lambda d: F.transform(v, lambda x: F.when(d > 0, x / d).otherwise(F.lit(0.0))))[0]


def best_matches(vectors: DataFrame, pair: str = "pair_id", side: str = "side", vid: str = "vec_id",
                 vec: str = "embedding") -> DataFrame:
    """(pair, side, vid, best): every vector's greatest cosine to a vector of the other side.

    Vectors are normalised once and dealt to blocks of ``VECTOR_BLOCK`` by their
    place in the pair; a block of candidates and one of references give a
    matrix product and one row per vector (its maximum there), never a row per
    cell. So a task holds two blocks, however large the pair. A vector of zeros
    has cosine 0; null vectors, nulls in a vector and vectors without a partner
    give no row; vectors of one pair must be equally long."""
    v = vectors.select(F.col(pair).alias("pair"), F.col(side).alias("side"), F.col(vid).alias("vid"),
                       F.col(vec).cast("array<double>").alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", F.isnull))
    v = number_within(v.select("pair", "side", "vid", _unit(F.col("v")).alias("v")), ["vid"], ["pair", "side"])
    blocks = (v.groupBy("pair", "side", F.floor(F.col("pos") / VECTOR_BLOCK).alias("block"))
              .agg(F.collect_list(F.struct("vid", "v")).alias("rows")))

    def of(name: str) -> DataFrame:
        return blocks.where(F.col("side") == name).select("pair", F.col("rows.vid").alias(f"{name}_vid"), F.col("rows.v").alias(f"{name}_v"))

    both = of("cand").join(of("ref"), "pair")
    schema = T.StructType([both.schema["pair"], T.StructField("side", T.StringType()),
                           T.StructField("vid", v.schema["vid"].dataType), T.StructField("best", T.DoubleType())])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                c, r = (np.reshape(v.flatten().to_numpy(), (len(v), -1)) for v in (one.column(f"{s}_v").flatten() for s in ("cand", "ref")))
                cells = c @ r.T
                for s, best in (("cand", cells.max(axis=1)), ("ref", cells.max(axis=0))):
                    n = len(best)
                    yield pa.RecordBatch.from_arrays(
                        [one.column("pair").take(pa.array([0] * n)), pa.array([s] * n), one.column(f"{s}_vid").flatten(), pa.array(best)],
                        names=["pair", "side", "vid", "best"])

    return (both.mapInArrow(run, schema).groupBy("pair", "side", "vid").agg(F.max("best").alias("best"))
            .select(F.col("pair").alias(pair), F.col("side").alias(side), F.col("vid").alias(vid), "best"))


def soft_match(vectors: DataFrame, pair: str = "pair_id", side: str = "side", vid: str = "vec_id",
               vec: str = "embedding") -> DataFrame:
    """Greedy soft matching over supplied vectors inside each pair:
    precision = mean over candidate vectors of the best cosine to a
    reference vector, recall the other way, F1 per pair, mean over pairs that
    have both sides (``best_matches``)."""
    per = best_matches(vectors, pair, side, vid, vec).groupBy(pair).agg(
        F.avg(F.when(F.col(side) == "cand", F.col("best"))).alias("precision"),
        F.avg(F.when(F.col(side) == "ref", F.col("best"))).alias("recall"))
    f1 = f_beta(F.col("precision"), F.col("recall"))
    return per.agg(F.count(F.lit(1)).alias("n_pairs"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg(f1).alias("f1"))


"""Text metrics over pair tables.

Shape of every job: the pair rows (key, candidate, reference[, source]) are
hash-partitioned on the pair key once and grouped by it; the n-grams of a pair
are then sorted and counted inside its row, per order, so that no row per gram
is built, shuffled or spilled. Corpus scores are one more aggregate over
per-order sums (a handful of rows). chrF++, whose grams are as many as its
characters times six, counts them in Arrow batches.

Contracts (the reference names these metrics without code):
- tokens: lower-cased word/punctuation pre-tokens; ROUGE/BLEU/GLEU/SARI/chrF
  word orders use them; chrF characters are case-sensitive, white space removed.
- EM / token F1: lower case, punctuation removed, white space collapsed.
- BLEU: exp(mean ln p_n) · min(1, exp(1 − R/C)); p_n are corpus sums; 0 if any
  p_n is 0; no smoothing.
- zero denominators give 0.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalise_answer, null_to_empty, word_tokens
from .alignment import common_length, word_distance
from .classes import f_beta, safe_div
from .gramsets import gram_overlaps, word_ids

def _empty():
    return F.array().cast("array<string>")


def word_grams(toks: Column, n: int) -> Column:
    """Word n-grams (tokens joined by a space) of a token array.

    Tokens never contain white space, so the grams are read off the
    space-joined text with one lookahead regex per order: every token start
    yields the n tokens that follow. One JVM regex pass per row and order —
    several times faster than building them with array lambdas."""
    joined = F.array_join(toks, " ")
    pattern = r"(?:^|(?<= ))(?=(" + r"(?:\S+ ){%d}\S+" % (n - 1) + "))"
    return F.when(F.size(toks) >= n, F.regexp_extract_all(joined, F.lit(pattern), 1)).otherwise(_empty())


def squeeze(s: Column) -> Column:
    """Text with all white space removed (input of character n-grams)."""
    return F.regexp_replace(null_to_empty(s), r"\s", "")


def _tagger(si: int):
    return lambda g: F.struct(g.alias("g"), F.lit(si).alias("s"))


def _gram_sums(lists: dict[str, Column], n: int, sums: dict[str, Callable[..., Column]]) -> Column:
    """Struct of ``sums`` over the distinct n-grams of one pair; ``lists`` has
    a list of token arrays per side. The grams of all sides are sorted in one
    array, and one fold sees the counts of each gram by side."""
    names = list(lists)
    tagged = [F.transform(F.flatten(F.transform(lists[name], lambda t: t if n == 1 else word_grams(t, n))), _tagger(si))
              for si, name in enumerate(names)]
    zero = F.lit(0).cast("long")
    init = F.struct(F.lit(None).cast("string").alias("g"), *[zero.alias(f"c_{x}") for x in names], *[zero.alias(f"m_{x}") for x in sums])

    def total(acc, k):
        return acc[f"m_{k}"] + sums[k](*[acc[f"c_{x}"] for x in names]).cast("long")

    def step(acc, x):
        one = [(x["s"] == si).cast("long") for si in range(len(names))]
        same = F.struct(acc["g"].alias("g"), *[(acc[f"c_{name}"] + i).alias(f"c_{name}") for name, i in zip(names, one)],
                        *[acc[f"m_{k}"].alias(f"m_{k}") for k in sums])
        other = F.struct(x["g"].alias("g"), *[i.alias(f"c_{name}") for name, i in zip(names, one)],
                         *[total(acc, k).alias(f"m_{k}") for k in sums])
        return F.when(acc["g"] == x["g"], same).otherwise(other)

    return F.aggregate(F.sort_array(F.concat(*tagged)), init, step,
                       lambda acc: F.struct(F.lit(n).alias("n"), *[total(acc, k).alias(k) for k in sums]))


def gram_sums(df: DataFrame, keys: Sequence[str], sides: dict[str, Column], orders: Sequence[int],
              sums: dict[str, Callable[..., Column]]) -> DataFrame:
    """Sums over the n-grams of each pair: one row (keys, n, sums) per pair and
    order, with zeros where it has no grams.

    ``sides`` maps a side name to its token array. Each of ``sums`` gets the
    counts of one gram by side, in the order of ``sides``, and is summed over
    the pair's distinct grams (all counts zero must give 0). Rows that repeat a
    key count as one pair. Grams are counted inside the row that holds the
    pair: no row per gram is built, sorted or shuffled."""
    keys = list(keys)
    rows = df.select(*keys, F.struct(*[c.alias(name) for name, c in sides.items()]).alias("_t"))
    pair = rows.groupBy(*keys).agg(F.collect_list("_t").alias("_rows"))
    lists = {name: F.col("_rows")[name] for name in sides}
    return pair.select(*keys, F.inline(F.array(*[_gram_sums(lists, n, sums) for n in orders])))


def overlaps(df: DataFrame, keys: Sequence[str], cand: Column, ref: Column, orders: Sequence[int]) -> DataFrame:
    """Word-gram sums (overlap, c_total, r_total) of every pair and order."""
    return gram_sums(df, keys, {"c": word_tokens(cand, lower=True), "r": word_tokens(ref, lower=True)}, orders,
                     {"overlap": F.least, "c_total": lambda c, r: c, "r_total": lambda c, r: r})


def _per_order(rows: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Corpus sums per order."""
    return rows.groupBy("n").agg(*[F.sum(x).alias(x) for x in sums])


# ------------------------------------------------------------------ M1, M2

def _norm_tokens(c: Column) -> Column:
    s = normalise_answer(c)
    return F.when(s == "", _empty()).otherwise(F.split(s, " "))


def exact_match(df: DataFrame, cand: str, golds: Sequence[str]) -> DataFrame:
    """M1: share of rows whose normalised candidate equals some gold."""
    c = normalise_answer(cand)
    hits = [F.coalesce(c == normalise_answer(g), F.lit(False)) & F.col(g).isNotNull() for g in golds]
    any_hit = hits[0]
    for h in hits[1:]:
        any_hit = any_hit | h
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(any_hit, 1.0).otherwise(0.0)).alias("exact_match"))


def token_f1(df: DataFrame, keys: Sequence[str], cand: str, golds: Sequence[str]) -> DataFrame:
    """M2: SQuAD-style token F1, best over the golds, mean over rows.
    Both sides empty → 1, one side empty → 0; a null gold is skipped (a row
    whose golds are all null scores 0). All golds are counted in one fold."""
    keys = list(keys)
    names = [f"r{i}" for i in range(len(golds))]
    there = dict(zip(names, (F.col(g).isNotNull() for g in golds)))
    sides = {"c": _norm_tokens(F.col(cand)), **{n: F.when(there[n], _norm_tokens(F.col(g))).otherwise(_empty()) for g, n in zip(golds, names)},
             # one gram says that this gold is there
             **{f"has_{n}": F.when(there[n], F.array(F.lit("."))).otherwise(_empty()) for n in names}}
    at = {x: i for i, x in enumerate(sides)}
    sums = {"nc": lambda *c: c[0]}
    for n in names:
        sums |= {f"n_{n}": lambda *c, n=n: c[at[n]], f"ov_{n}": lambda *c, n=n: F.least(c[0], c[at[n]]),
                 f"has_{n}": lambda *c, n=n: c[at[f"has_{n}"]]}
    per = gram_sums(df, keys, sides, [1], sums)
    nc = F.col("nc")
    f1s = []
    for n in names:
        nr = F.col(f"n_{n}")
        p = safe_div(F.col(f"ov_{n}"), nc)
        r = safe_div(F.col(f"ov_{n}"), nr)
        f1 = (F.when(F.col(f"has_{n}") == 0, F.lit(None).cast("double"))
              .when((nc == 0) & (nr == 0), F.lit(1.0))
              .when((nc == 0) | (nr == 0), F.lit(0.0))
              .otherwise(f_beta(p, r)))
        f1s.append(f1)
    best = F.greatest(*f1s) if len(f1s) > 1 else f1s[0]
    return per.agg(F.count(F.lit(1)).alias("n"), F.avg(F.coalesce(best, F.lit(0.0))).alias("token_f1"))


# ------------------------------------------------------------------ M3, M4

def rouge_n(df: DataFrame, keys: Sequence[str], cand: str, ref: str, n: int) -> DataFrame:
    """M3: mean over pairs of the F1 of clipped n-gram overlap."""
    st = overlaps(df, keys, F.col(cand), F.col(ref), [n])
    p = safe_div(F.col("overlap"), F.col("c_total"))
    r = safe_div(F.col("overlap"), F.col("r_total"))
    return st.agg(F.count(F.lit(1)).alias("n_pairs"), F.avg(f_beta(p, r)).alias(f"rouge_{n}"))


def rouge_l(df: DataFrame, cand: str, ref: str) -> DataFrame:
    """M4: mean over pairs of the F1 of LCS length (a column expression, see ``alignment``)."""
    c = word_tokens(cand, lower=True)
    r = word_tokens(ref, lower=True)
    per = df.select(F.size(c).alias("nc"), F.size(r).alias("nr"), common_length(c, r).alias("lcs"))
    p = safe_div(F.col("lcs"), F.col("nc"))
    rr = safe_div(F.col("lcs"), F.col("nr"))
    return per.agg(F.count(F.lit(1)).alias("n_pairs"), F.avg(f_beta(p, rr)).alias("rouge_l"))


# -------------------------------------------------------- M5, M8, M9, M10

def _bleu_from_orders(per_order: DataFrame, max_n: int, num: str = "overlap", den: str = "c_total",
                      c_len: str = "c_total", r_len: str = "r_total", by: Sequence[str] = ()) -> DataFrame:
    """Final BLEU row (one per ``by``) from a per-order table of corpus sums (at
    most max_n rows each). Corpus lengths are the unigram totals (order 1)."""
    t = per_order.withColumn("p", safe_div(F.col(num), F.col(den)))
    agg = t.groupBy(*by).agg(F.min("p").alias("min_p"), F.avg(F.log(F.when(F.col("p") > 0, F.col("p")))).alias("mean_log"),
                             F.max(F.when(F.col("n") == 1, F.col(c_len))).alias("C"),
                             F.max(F.when(F.col("n") == 1, F.col(r_len))).alias("R"),
                             *[F.max(F.when(F.col("n") == k, F.col("p"))).alias(f"p{k}") for k in range(1, max_n + 1)])
    bp = F.when(F.coalesce(F.col("C"), F.lit(0)) == 0, F.lit(0.0)) \
        .otherwise(F.least(F.lit(1.0), F.exp(1 - F.col("R") / F.col("C"))))
    score = F.when(F.coalesce(F.col("min_p"), F.lit(0.0)) <= 0, F.lit(0.0)).otherwise(bp * F.exp(F.col("mean_log")))
    return agg.select(*by, score.alias("bleu"), bp.alias("bp"), *[f"p{k}" for k in range(1, max_n + 1)])


def bleu(df: DataFrame, keys: Sequence[str], cand: str, ref: str, max_n: int = 4) -> DataFrame:
    """M5: corpus BLEU (n = 1..max_n, brevity penalty, no smoothing)."""
    orders = list(range(1, max_n + 1))
    per_order = _per_order(overlaps(df, keys, F.col(cand), F.col(ref), orders), ["overlap", "c_total", "r_total"])
    return _bleu_from_orders(per_order, max_n)


def self_bleu(df: DataFrame, keys: Sequence[str], cand: str, source: str, max_n: int = 4) -> DataFrame:
    """M8: BLEU of the candidate against its own source."""
    return bleu(df, keys, cand, source, max_n).withColumnRenamed("bleu", "self_bleu")


def ibleu(df: DataFrame, keys: Sequence[str], hyp: str, ref: str, source: str, alpha: float = 0.9,
          max_n: int = 4) -> DataFrame:
    """M9: α·BLEU(hyp, ref) − (1 − α)·BLEU(hyp, source). Both BLEUs come from
    one three-sided n-gram count. An order without any gram does not count."""
    orders = list(range(1, max_n + 1))
    tok = lambda c: word_tokens(c, lower=True)
    rows = gram_sums(df, keys, {"h": tok(F.col(hyp)), "r": tok(F.col(ref)), "s": tok(F.col(source))}, orders,
                     {"ov_r": lambda h, r, s: F.least(h, r), "ov_s": lambda h, r, s: F.least(h, s),
                      "c_total": lambda h, r, s: h, "r_total": lambda h, r, s: r, "s_total": lambda h, r, s: s})
    per = _per_order(rows, ["ov_r", "ov_s", "c_total", "r_total", "s_total"]).where("c_total + r_total + s_total > 0")
    scores = _bleu_from_orders(per.select("n", F.inline(F.array(
        F.struct(F.lit("ref").alias("k"), F.col("ov_r").alias("overlap"), "c_total", "r_total"),
        F.struct(F.lit("src").alias("k"), F.col("ov_s").alias("overlap"), "c_total", F.col("s_total").alias("r_total"))))), max_n, by=["k"])
    out = scores.agg(F.max(F.when(F.col("k") == "ref", F.col("bleu"))).alias("bleu_ref"),
                     F.max(F.when(F.col("k") == "src", F.col("bleu"))).alias("bleu_src"))
    # without any gram both scores are 0
    out = out.select(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("bleu_ref", "bleu_src")])
    return out.withColumn("ibleu", F.lit(alpha) * F.col("bleu_ref") - F.lit(1 - alpha) * F.col("bleu_src"))


def gleu_plus(df: DataFrame, keys: Sequence[str], hyp: str, ref: str, source: str, max_n: int = 4) -> DataFrame:
    """GLEU+ — n-gram precision that penalises n-grams kept from the
    source but absent from the reference, then as BLEU. An order without any
    gram does not count."""
    orders = list(range(1, max_n + 1))
    tok = lambda c: word_tokens(c, lower=True)
    rows = gram_sums(df, keys, {"h": tok(F.col(hyp)), "r": tok(F.col(ref)), "s": tok(F.col(source))}, orders,
                     {"m_hr": lambda h, r, s: F.least(h, r),
                      "pen": lambda h, r, s: F.greatest(F.lit(0), F.least(h, s) - F.least(h, r)),
                      "c_total": lambda h, r, s: h, "r_total": lambda h, r, s: r, "s_total": lambda h, r, s: s})
    per = _per_order(rows, ["m_hr", "pen", "c_total", "r_total", "s_total"]).where("c_total + r_total + s_total > 0")
    per = per.withColumn("num", F.greatest(F.lit(0), F.col("m_hr") - F.col("pen")))
    out = _bleu_from_orders(per, max_n, num="num", den="c_total")
    return out.withColumnRenamed("bleu", "gleu_plus")


# ---------------------------------------------------------------------- M6

def chrf(df: DataFrame, keys: Sequence[str], cand: str, ref: str, char_n: int = 6, word_n: int = 2,
         beta: float = 2.0) -> DataFrame:
    """M6: chrF++ — corpus precision/recall per order (characters 1..char_n,
    words 1..word_n), averaged over orders with n-grams on both sides, F-β.

    Pairs are counted where they lie, in Arrow batches (``gram_overlaps``): no
    row per gram and no shuffle but the sums per order. A null text counts as
    an empty one; repeated rows count as often as they occur; a table without
    any gram gives 0. ``keys`` is not needed any more and kept for callers."""
    base = df.select(squeeze(F.col(cand)).alias("c_text"), squeeze(F.col(ref)).alias("r_text"),
                     word_ids(cand).alias("c_words"), word_ids(ref).alias("r_words"))
    per = (base.mapInArrow(gram_overlaps(char_n, word_n), "n int, ov long, ct long, rt long")
           .groupBy("n").agg(F.sum("ov").alias("ov"), F.sum("ct").alias("ct"), F.sum("rt").alias("rt")))
    valid = per.where((F.col("ct") > 0) & (F.col("rt") > 0))
    pr = valid.agg(F.avg(F.col("ov") / F.col("ct")).alias("precision"), F.avg(F.col("ov") / F.col("rt")).alias("recall"),
                   F.count(F.lit(1)).alias("n_orders"))
    return pr.select("precision", "recall", "n_orders",
                     F.coalesce(f_beta(F.col("precision"), F.col("recall"), beta), F.lit(0.0)).alias("chrf"))


# ---------------------------------------------------------------------- M7

def word_edit_rate(df: DataFrame, cand: str, ref: str) -> DataFrame:
    """M7: Σ word edit distance / Σ reference words (TER without shifts)."""
    c = word_tokens(cand, lower=True)
    r = word_tokens(ref, lower=True)
    per = df.select(word_distance(c, r).alias("edits"), F.size(r).alias("ref_words"))
    return per.agg(F.sum("edits").alias("edits"), F.sum("ref_words").alias("ref_words"),
                   safe_div(F.sum("edits"), F.sum("ref_words")).alias("word_edit_rate"))


# --------------------------------------------------------------------- M12

def sari(df: DataFrame, keys: Sequence[str], source: str, hyp: str, ref: str, max_n: int = 4) -> DataFrame:
    """SARI with one reference over n-gram sets: per n the mean of
    F_keep, F_add and P_delete; mean over n = 1..max_n; mean over rows."""
    keys = list(keys)
    orders = list(range(1, max_n + 1))
    tok = lambda c: word_tokens(c, lower=True)
    kinds = {"keep_ok": "shr", "keep_h": "sh", "keep_r": "sr", "add_ok": "hrS", "add_h": "hS", "add_r": "rS",
             "del_ok": "sHR", "del_h": "sH"}  # sides that have the gram, in capitals those that lack it

    def holds(sides):
        def is_so(s, h, r):
            has = {"s": s > 0, "h": h > 0, "r": r > 0, "S": s == 0, "H": h == 0, "R": r == 0}
            return reduce(Column.__and__, [has[x] for x in sides])
        return is_so
    per = gram_sums(df, keys, {"s": tok(F.col(source)), "h": tok(F.col(hyp)), "r": tok(F.col(ref))}, orders,
                    {k: holds(sides) for k, sides in kinds.items()})
    f_keep = f_beta(safe_div(F.col("keep_ok"), F.col("keep_h")), safe_div(F.col("keep_ok"), F.col("keep_r")))
    f_add = f_beta(safe_div(F.col("add_ok"), F.col("add_h")), safe_div(F.col("add_ok"), F.col("add_r")))
    p_del = safe_div(F.col("del_ok"), F.col("del_h"))
    per_n = per.select(*keys, ((f_keep + f_add + p_del) / 3.0).alias("s_n"))
    per_row = per_n.groupBy(*keys).agg(F.avg("s_n").alias("sari"))
    return per_row.agg(F.count(F.lit(1)).alias("n"), F.avg("sari").alias("sari"))


# --------------------------------------------------------------------- M13

def gulpease(df: DataFrame, text: str = "text") -> DataFrame:
    """Gulpease index per row: 89 + (300·sentences − 10·letters)/words;
    null without words. Sentences = runs of . ! ? (at least one when there
    are words)."""
    t = null_to_empty(F.col(text))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]", ""))
    words = F.regexp_count(t, F.lit(r"[\p{L}\p{N}_]+"))
    sentences = F.greatest(F.regexp_count(t, F.lit(r"[.!?]+")), F.lit(1))
    score = F.when(words > 0, 89 + (300 * sentences - 10 * letters) / words)
    return df.select("*", letters.cast("long").alias("letters"), words.cast("long").alias("words"),
                     sentences.cast("long").alias("sentences"), score.alias("gulpease"))


# --------------------------------------------------------------------- M14

def perplexity(df: DataFrame, loss: str, weight: str, by: Sequence[str] = ()) -> DataFrame:
    """Exp of the token-weighted mean loss."""
    w = F.col(weight).cast("double")
    return df.groupBy(*by).agg(F.sum(w).alias("tokens"),
                               F.exp(safe_div(F.sum(F.col(loss) * w), F.sum(w))).alias("perplexity"))

"""Quality rules as weak supervision.

Every rule looks at a few counts of the whole text and votes good (1), bad
(-1) or abstains (0). No rule decides alone: expectation-maximisation over all
documents that the base does not fail estimates how often each rule's votes are right on good and on bad
documents, and a document's posterior probability of being good replaces the
usual demand that it passes every rule.

DataFrame functions only. Counts are made inside the row (no window of words
leaves it); the votes of all documents are grouped into vote patterns, of
which there are 3^8 at most, and the estimation runs over those.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, UPPER, let, saved, text_or_empty, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more."""

    def sorted_pairs(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        starts = F.array_sort(F.transform(twice, lambda x: x["at"]))
        first = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(starts, first, lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n")), lambda a: a["n"])

    def exact(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(pairs, sorted_pairs))

    return let(hashes, exact)


def _windows(w: Column) -> Column:
    """64-bit hash of every window of five words, in order."""
    at = F.sequence(F.lit(0), F.size(w) - WINDOW)
    return F.when(F.size(w) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])))


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the counts of every whole text (null: no words)."""
    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("w", words(F.col("text")))
    t = F.col("text")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    chars = lambda allowed: (F.length(t) - F.length(F.translate(t, allowed, ""))).cast("long")
    return rows.select(
        "doc_id", F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace(t, SPACE + "+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, r"[^\p{L}\p{N}]+", "")).cast("long").alias("n_letters"),
        chars(SYMBOLS).alias("n_symbols"), chars(UPPER).alias("n_upper"), chars(".!?").alias("n_stops"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d"))).alias("l"),
        let(F.col("w"), lambda w: _covered(_windows(w))).cast("long").alias("n_repeat_words"),
    ).select("doc_id", "n_words", "word_chars", "n_letters", "n_symbols", "n_upper", "n_stops", F.col("l.n").alias("n_lines"),
             (F.col("l.n") - F.col("l.d")).alias("n_dup_lines"), "n_repeat_words")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules, over the columns of ``counts``."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    symbols, upper, stops = F.col("n_symbols") / n, F.col("n_upper") / chars, F.col("n_stops") / n
    repeated, lines, length = F.col("n_repeat_words") / n, F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), F.col("word_chars") / n
    return {
        "v_symbols": _vote(symbols <= 0.05, symbols > 0.3),
        "v_letters": _vote(F.col("n_letters") / chars >= 0.93, F.col("n_letters") / chars < 0.9),
        "v_upper": _vote(upper <= 0.15, upper > 0.4),
        "v_stops": _vote((stops >= 0.02) & (stops <= 0.35), (stops < 0.004) | (stops > 0.7)),
        "v_repeat": _vote(repeated <= 0.05, repeated > 0.2),
        "v_lines": _vote(lines == 0, (F.col("n_lines") >= 6) & (lines > 0.3)),
        "v_word_length": _vote((length >= 3) & (length <= 10), (length < 2) | (length > 14)),
        "v_length": _vote(F.col("n_words") >= 50, F.col("n_words") < 10),
    }


#: What a rule is taken to be like before any document is seen: the share of
#: good votes on good and on bad documents, and the weight of that belief as a
#: share of all documents. A bad vote on a good document is taken to be rare,
#: a good vote on a bad one is not: most rules look at one kind of fault.
BELIEF = (0.99, 0.7)
BELIEF_WEIGHT = 0.02


def estimate(patterns: list[tuple[tuple[int, ...], int]], rules: int, rounds: int = 200) -> tuple[float, list[tuple[float, float]]]:
    """Prior probability of good, and per rule the probability of a good vote,
    given that it votes, on good and on bad documents.

    Expectation-maximisation over (votes, documents) patterns, which start as
    good unless a rule votes bad. Each rule is kept no worse than a coin (a good vote is at least as
    likely on a good document), which fixes which class is which. Without
    documents the beliefs above are returned, with prior one half.
    """
    right = [BELIEF] * rules
    prior, total = 0.5, sum(n for _, n in patterns)
    if not total:
        return prior, right
    extra = BELIEF_WEIGHT * total + 1
    belief = [0.1 if min(v) < 0 else 0.9 for v, _ in patterns]
    for _ in range(rounds):
        good = sum(b * n for b, (_, n) in zip(belief, patterns))
        new_prior = (good + 1) / (total + 2)
        new_right = []
        for j in range(rules):
            up_good, on_good = extra * BELIEF[0], extra
            up_bad, on_bad = extra * BELIEF[1], extra
            for b, (v, n) in zip(belief, patterns):
                if v[j]:
                    on_good, on_bad = on_good + b * n, on_bad + (1 - b) * n
                    if v[j] > 0:
                        up_good, up_bad = up_good + b * n, up_bad + (1 - b) * n
            p_good, p_bad = up_good / on_good, up_bad / on_bad
            middle = (up_good + up_bad) / (on_good + on_bad)
            new_right.append((p_good, p_bad) if p_good >= p_bad else (middle, middle))
        moved = abs(new_prior - prior) + sum(abs(a - c) + abs(b - d) for (a, b), (c, d) in zip(new_right, right))
        prior, right = new_prior, new_right
        belief = [1 / (1 + math.exp(-_log_odds(v, prior, right))) for v, _ in patterns]
        if moved < 1e-10:
            break
    return prior, right


def _log_odds(v: tuple[int, ...], prior: float, right: list[tuple[float, float]]) -> float:
    out = math.log(prior / (1 - prior))
    for x, (good, bad) in zip(v, right):
        if x:
            out += math.log(good / bad) if x > 0 else math.log((1 - good) / (1 - bad))
    return max(-500.0, min(500.0, out))


def judge(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, p_good``.

    base_failed: fewer than 10 words, or over 20% of the words in repeated
    windows of five. kept: not base_failed and the posterior reaches
    ``threshold``. A null or empty text has no words and so fails. Repeated
    rows count as often as they occur. An empty table gives no rows; other
    columns are not read.
    """
    rules = votes()
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    seen = saved(counts(docs, id_col, text_col).withColumns({**rules, "base_failed": failed}), "rule_votes")
    # a document that the base fails is decided; 3^rules rows at most
    grouped = seen.where("not base_failed").groupBy(*rules).agg(F.count(F.lit(1)).alias("n")).collect()
    prior, right = estimate(sorted((tuple(int(r[c]) for c in rules), int(r["n"])) for r in grouped), len(rules))
    odds = F.lit(math.log(prior / (1 - prior)))
    for c, (good, bad) in zip(rules, right):
        odds = odds + F.when(F.col(c) > 0, math.log(good / bad)).when(F.col(c) < 0, math.log((1 - good) / (1 - bad))).otherwise(0.0)
    p = 1 / (1 + F.exp(-odds))
    return seen.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       (~F.col("base_failed") & (p >= threshold)).alias("kept"), p.alias("p_good"))

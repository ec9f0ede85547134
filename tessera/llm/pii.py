"""Personal data: base patterns, and boosted trees over candidate spans.

The base patterns (email, ip, card, phone) give spans with their checks. Next
to them generators of high recall propose overlapping spans of the same kinds:
anything with an at sign, spelled-out addresses, digit groups of any shape. A
candidate that lies in a base span of its kind counts as a positive example,
any other as a negative one; its features are its format and its context, not
the marks by which the base pattern found it. Gradient-boosted trees learn
from them, thresholds are calibrated on documents held out from the fit, and a
candidate outside the base spans that reaches its kind's threshold is added.

DataFrame functions only. Features are small whole numbers, so the trees are
fitted on the table of distinct feature patterns with their counts, whose size
is bounded by the product of the features' ranges, and become a column
expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, saved, text_or_empty

KINDS = ["email", "ip", "card", "phone"]

_LOCAL = r"[A-Za-z0-9._%+-]"
#: Base patterns. Possessive, and begun only where a run begins or the last
#: match ended, which gives the same leftmost matches in linear time.
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?=[0-9][ -]?[0-9])[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without a match of this has none of the kind.
QUICK = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?+[0-9]){15}", "phone": r"\+[0-9]"}
#: Candidate generators: (kind, quick test, pattern).
GENERATORS = [
    ("email", "@", r"[^\s@<>()\[\],;]++@[^\s@<>()\[\],;]++"),
    ("email", r"(?i)[ (\[]at[ )\]]", r"(?i)[A-Za-z0-9._%+-]++(?: at | ?\[at\] ?| ?\(at\) ?)[A-Za-z0-9-]++(?:(?: dot | ?\[dot\] ?| ?\(dot\) ?|\.)[A-Za-z0-9-]++)++"),
    ("ip", QUICK["ip"], r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9])"),
    ("card", r"[0-9](?:[ .-]?+[0-9]){12}", r"(?<![0-9])[0-9]++(?:[ .-][0-9]++)*+"),
    ("phone", r"[0-9](?:[ ().-]{0,3}+[0-9]){6}", r"[+(]?+[0-9]++(?:[ ().-]{1,2}+[0-9]++)*+"),
    ("phone", r"[0-9]{3}[)]?+[ .-]", r"\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
]
#: Words before a span that speak of such data.
CONTEXT = r"(?i)\b(e-?mail|mail|contact|tel|phone|call|fax|mobile|card|visa|credit|ip|host|server|address)\b"
#: Matches whose places are summed up at once.
BLOCK = 256


def _found(text: Column, quick: str, pattern: str) -> Column:
    """Every match with its place in code points and what stands around it."""
    none = F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")

    def places(x: Column) -> Column:
        """Lengths to places: running sums inside blocks, blocks after blocks."""
        n = F.size(x["m"])
        blocks = F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))
        width = lambda i: F.length(F.get(x["g"], i)) + F.length(F.get(x["m"], i))
        inside = lambda b: F.sequence(b * BLOCK, F.least((b + 1) * BLOCK, n) - 1)
        sums = F.transform(blocks, lambda b: F.aggregate(inside(b), F.lit(0), lambda a, i: a + width(i)))

        def block(b: Column, before: Column) -> Column:
            start = F.struct(before.alias("at"), none.alias("out"))

            def step(a: Column, i: Column) -> Column:
                begin = a["at"] + F.length(F.get(x["g"], i))
                value = F.get(x["m"], i)
                span = F.struct(begin.alias("start"), (begin + F.length(value)).alias("end"), value.alias("value"),
                                F.right(F.get(x["g"], i), F.lit(24)).alias("before"), F.left(F.get(x["g"], i + 1), F.lit(2)).alias("after"))
                return F.struct((a["at"] + width(i)).alias("at"), F.concat(a["out"], F.array(span)).alias("out"))

            return F.aggregate(inside(b), start, step, lambda a: a["out"])

        return let(sums, lambda s: F.flatten(F.transform(blocks, lambda b: block(b, F.aggregate(F.slice(s, F.lit(1), b), F.lit(0), lambda a, y: a + y)))))

    split = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))
    some = let(split, lambda x: F.when(F.size(x["m"]) > 0, places(x)).otherwise(none))
    return F.when(text.contains(quick) if quick == "@" else text.rlike(quick), some).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The digit string passes the Luhn check."""
    at = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(at, F.lit(0), add) % 10 == 0


def _octets(value: Column) -> Column:
    small = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(F.split(value, r"\."), lambda p: (F.length(small(p)) <= 3) & (F.coalesce(F.left(small(p), F.lit(3)).cast("int"), F.lit(999)) <= 255))


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return _octets(value)
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _span(kind: str, s: Column) -> Column:
    return F.struct(F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))


def base_spans(text: Column) -> Column:
    """array<struct<kind:int,start:int,end:int>> of the base patterns, by kind and start."""
    def own(kind: str) -> Column:
        found = _found(text, QUICK[kind], BASE[kind])
        return F.transform(F.filter(found, lambda s: _passes(kind, s["value"])), lambda s: _span(kind, s))

    return F.concat(*[own(k) for k in KINDS])


# features of a candidate: whole numbers, and their largest value
FEATURES = {"generator": len(GENERATORS) - 1, "digits": 9, "separators": 4, "brackets": 1, "dashes": 1, "blanks": 1, "dots": 1,
            "luhn": 1, "octets": 1, "domain": 3, "left": 3, "right": 3, "context": 1}


def _class(c: Column) -> Column:
    """0 none, 1 white space, 2 letter or digit, 3 other."""
    return F.when(c == "", 0).when(c.rlike(r"^\s"), 1).when(c.rlike(r"^[\p{L}\p{N}]"), 2).otherwise(3)


def candidates(text: Column) -> Column:
    """array of candidate spans with their features."""
    def proposed(g: int, kind: str, quick: str, pattern: str) -> Column:
        def described(s: Column) -> Column:
            v = s["value"]
            separators = F.length(F.regexp_replace(v, "[^ ().-]", ""))

            def features(d: Column) -> Column:
                n = F.length(d)
                bins = F.when(n < 4, 0).when(n < 7, 1).when(n == 7, 2).when(n < 10, 3).when(n == 10, 4).when(n == 11, 5).when(n < 13, 6).when(n < 16, 7).when(n < 20, 8).otherwise(9)
                return F.struct(
                    F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(g).alias("generator"),
                    bins.alias("digits"), F.least(F.lit(4), separators).alias("separators"), v.contains("(").cast("int").alias("brackets"),
                    v.contains("-").cast("int").alias("dashes"), v.contains(" ").cast("int").alias("blanks"), v.contains(".").cast("int").alias("dots"),
                    F.when(n.between(13, 19), _luhn(d)).otherwise(F.lit(False)).cast("int").alias("luhn"),
                    F.when(v.rlike(r"^[0-9]+(\.[0-9]+){3}$"), _octets(v)).otherwise(F.lit(False)).cast("int").alias("octets"),
                    F.when(F.lit(kind != "email"), 0).when(v.rlike(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"), 3).when(v.rlike("(?i)(dot|\\.)[ )\\]]*[a-z]{2,6}$"), 2).otherwise(1).alias("domain"),
                    _class(F.right(s["before"], F.lit(1))).alias("left"), _class(F.left(s["after"], F.lit(1))).alias("right"),
                    s["before"].rlike(CONTEXT).cast("int").alias("context"))

            return let(_digits(v), features)

        return F.transform(_found(text, quick, pattern), described)

    return F.concat(*[proposed(g, *x) for g, x in enumerate(GENERATORS)])


# boosted trees over feature patterns

def _leaf(rows: list, extra: float = 1.0) -> float:
    g, h = sum(r[2] for r in rows), sum(r[3] for r in rows)
    return g / (h + extra)


def _tree(rows: list, depth: int):
    """rows: (features, ..., gradient, curvature). A split is (feature, bound,
    low side, high side), a leaf its value."""
    def score(x):
        return sum(r[2] for r in x) ** 2 / (sum(r[3] for r in x) + 1.0)

    best = (1e-6, None)
    if depth:
        whole = score(rows)
        for j in range(len(FEATURES)):
            for bound in sorted({r[0][j] for r in rows})[:-1]:
                low, high = [r for r in rows if r[0][j] <= bound], [r for r in rows if r[0][j] > bound]
                gain = score(low) + score(high) - whole
                if gain > best[0] + 1e-12:
                    best = (gain, (j, bound, low, high))
    if best[1] is None:
        return _leaf(rows)
    j, bound, low, high = best[1]
    return j, bound, _tree(low, depth - 1), _tree(high, depth - 1)


def _value(tree, x: tuple) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def boost(patterns: list[tuple[tuple[int, ...], int, int]], rounds: int = 20, depth: int = 3, rate: float = 0.5) -> tuple[float, list]:
    """Start value and trees for the log-odds of a positive; ``patterns`` are
    (features, positives, negatives)."""
    pos, neg = sum(p for _, p, _ in patterns), sum(n for *_, n in patterns)
    start = math.log((pos + 1) / (neg + 1))
    odds, trees = [start] * len(patterns), []
    for _ in range(rounds if patterns else 0):
        rows = []
        for (x, p, n), o in zip(patterns, odds):
            q = 1 / (1 + math.exp(-o))
            rows.append((x, None, p - (p + n) * q, (p + n) * q * (1 - q)))
        tree = _tree(rows, depth)
        trees.append(tree)
        odds = [max(-30.0, min(30.0, o + rate * _value(tree, x))) for o, (x, *_) in zip(odds, patterns)]
    return start, [(rate, t) for t in trees]


def predict(model: tuple[float, list], x: tuple) -> float:
    return model[0] + sum(rate * _value(t, x) for rate, t in model[1])


def _expression(model: tuple[float, list]) -> Column:
    names = list(FEATURES)

    def column(t) -> Column:
        return F.when(F.col(names[t[0]]) <= t[1], column(t[2])).otherwise(column(t[3])) if isinstance(t, tuple) else F.lit(float(t))

    out = F.lit(float(model[0]))
    for rate, t in model[1]:
        out = out + rate * column(t)
    return out


def calibrated(model: tuple[float, list], patterns: list[tuple[int, tuple, int, int]], precision: float) -> dict[int, float]:
    """Per kind the lowest log-odds at which held-out candidates of that score
    or above are positive with ``precision`` (one more negative counted)."""
    out = {}
    for kind in range(len(KINDS)):
        rows = sorted(((predict(model, x), p, n) for k, x, p, n in patterns if k == kind), reverse=True)
        good = bad = 0
        for i, (score, p, n) in enumerate(rows):
            good, bad = good + p, bad + n
            if i + 1 < len(rows) and rows[i + 1][0] == score:
                continue
            if good >= precision * (good + bad + 1):
                out[kind] = score
    return out


def _inside(c: Column, spans: Column) -> Column:
    """The candidate shares most of its characters with a base span of its kind."""
    return F.exists(spans, lambda s: (s["kind"] == c["kind"]) & (10 * (F.least(s["end"], c["end"]) - F.greatest(s["start"], c["start"])) >= 8 * (c["end"] - c["start"])))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, precision: float = 0.98, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, n_added, span_list``.

    The four counts and base_sha256 are those of the base spans; spans lists
    base and added spans as kind:start:end (code points, end exclusive), by
    kind as in ``KINDS``, then start; span_list holds them as structs. A null
    or empty text has none. Repeated rows count as often as they occur in the
    fit. Without candidates nothing is added. An empty table gives no rows;
    other columns are not read.
    """
    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    seen = rows.select("doc_id", F.xxhash64("text").alias("version"), base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("cand"))
    some = let(F.struct("base", "cand"), lambda x: F.transform(x["cand"], lambda c: F.struct(
        c.alias("c"), _inside(c, x["base"]).alias("positive"),
        F.exists(x["base"], lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"])).alias("known"))))
    seen = saved(seen.select("doc_id", "version", "base", some.alias("cand")), "pii_spans")

    flat = seen.select(F.pmod(F.xxhash64("doc_id", "version"), F.lit(4)).alias("fold"), F.explode_outer("cand").alias("x")).where("x is not null") \
        .select((F.col("fold") == 0).alias("held"), "x.positive", "x.c.*")
    # bounded by the product of the ranges of FEATURES
    table = flat.groupBy("held", "kind", *FEATURES).agg(F.sum(F.col("positive").cast("long")).alias("p"), F.count(F.lit(1)).alias("n")).collect()
    patterns = sorted((r["held"], r["kind"], tuple(r[f] for f in FEATURES), int(r["p"]), int(r["n"] - r["p"])) for r in table)
    model = boost([(x, p, n) for held, _, x, p, n in patterns if not held])
    bounds = calibrated(model, [(k, x, p, n) for held, k, x, p, n in patterns if held], precision)

    added = F.lit(None).cast("array<struct<kind:int,start:int,end:int>>")
    if bounds:
        scored = seen.select("doc_id", "version", F.explode_outer("cand").alias("x")).where("x is not null and not x.known").select("doc_id", "version", "x.c.*").distinct()
        reach = F.lit(False)
        for kind, bound in bounds.items():
            reach = reach | ((F.col("kind") == kind) & (F.col("odds") >= bound))
        new = scored.withColumn("odds", _expression(model)).where(reach).groupBy("doc_id", "version").agg(
            F.collect_set(F.struct("kind", "start", "end")).alias("new"))  # spans of one text
        new = new.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), "new")
        seen = seen.join(new, seen["doc_id"].eqNullSafe(new["_id"]) & (seen["version"] == new["_version"]), "left")
        added = F.col("new")
    # of overlapping additions the longest stays
    longest = F.array_sort(F.transform(F.coalesce(added, F.array().cast("array<struct<kind:int,start:int,end:int>>")),
                                       lambda s: F.struct((s["start"] - s["end"]).alias("l"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    apart = F.aggregate(longest, F.array().cast("array<struct<kind:int,start:int,end:int>>"), lambda a, s: F.when(
        F.exists(a, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"])), a).otherwise(
        F.concat(a, F.array(F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))))
    done = seen.select("doc_id", "base", apart.alias("added")).withColumn("span_list", F.array_sort(F.concat("base", "added")))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return done.select("doc_id", *[count(k) for k in KINDS], F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                       _written(F.col("span_list")).alias("spans"), F.size("added").cast("long").alias("n_added"), "span_list")


def redact(text: Column, span_list: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of
    overlapping spans the first one's start and the last one's end count."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    by_place = F.array_sort(F.transform(span_list, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        return F.when(s["start"] >= a["at"], F.struct(F.concat(a["out"], gap, F.get(names, s["kind"])).alias("out"), s["end"].alias("at"))).otherwise(
            F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at")))

    return F.aggregate(by_place, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))

"""Benchmark decontamination by template windows.

A text becomes a template: numbers, names and units are replaced by typed
placeholders, the rest is lower case without punctuation. Windows of eight
template words are hashed and joined with those of the benchmark, so a
question whose numbers or names were changed still matches. Matches on
neighbouring alignments of document and item are added up, so that a word put
in or left out breaks nothing, and the slots of the matched windows are
compared: unless most of them are as they were, each value of the item must
stand for one value in the document and the other way round, but for two
values that became equal. Loosely similar text fails that; a
re-parameterised question passes.

Beside the template, the plain lower-case words are hashed: they agree where
the template does not, as capitals in a copy say nothing about names there.
Newlines, colons and quotes may end a sentence or not, so both readings count.

DataFrame functions only. Windows of a document never leave its row unless
they match: the benchmark side is broadcast while its counted size is below
``BROADCAST_ROWS``, beyond that both sides are shuffled by the hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few, let, saved, text_or_empty

WINDOW = 8
#: Width of further windows for items of so many words that one edit may leave under half of the others.
NARROW, NARROW_WORDS = 5, 3 * WINDOW - 2
#: Words of an item in a row that are a leak whatever their share.
QUOTE = 13
#: Shifts that are added up: any two less than half of it apart.
SHIFTS = 16
#: Rows of the benchmark's window table (two numbers each and an id) that are broadcast.
BROADCAST_ROWS = 500_000
#: Ids of documents that are broadcast to fetch their texts.
BROADCAST_IDS = 1_000_000

NUMBER, NAME, UNIT = "§d", "§n", "§u"
#: What may end a sentence beside its mark.
BREAKS = r"\n\r:\"“”„«»"
#: A word in capitals, and one in a run of three or more.
CAPITALS = r"\p{Lu}[\p{Lu}\p{N}]*+(?!\p{L})"
_BEFORE = r"(?<![\p{L}\p{N}])\p{Lu}[\p{Lu}\p{N}]{0,30} "
IN_RUN = rf"(?={CAPITALS})(?:{CAPITALS} {CAPITALS} {CAPITALS}|(?<={_BEFORE}){CAPITALS} {CAPITALS}|(?<={_BEFORE}\p{{Lu}}[\p{{Lu}}\p{{N}}]{{0,30}} ))"
#: Units: fixed values.
UNITS = ["mm", "cm", "m", "km", "inch", "inches", "ft", "feet", "foot", "yard", "yards", "mile", "miles", "mg", "g", "kg", "gram", "grams",
         "ton", "tons", "lb", "lbs", "oz", "ml", "l", "liter", "liters", "litre", "litres", "s", "sec", "second", "seconds", "min", "minute",
         "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "percent", "dollar", "dollars",
         "euro", "euros", "cent", "cents", "degree", "degrees", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "kilogram",
         "kilograms", "v", "w", "kw", "mph", "kmh", "hz"]


def _plain(text: Column) -> Column:
    """Words of letters and digits; sentence marks stay for the moment."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}.!?]+", " ")


def _split(text: Column) -> Column:
    """Lower-case words; marks go, but for the points inside numbers."""
    bare = F.regexp_replace(F.lower(text), r"(?<!\p{N})\.|\.(?!\p{N})|[!?]", " ")
    return F.array_remove(F.split(bare, " "), "")


def raw_words(text: Column) -> Column:
    """Word i is the value behind template word i."""
    return _split(_plain(text))


def template_words(text: Column, breaks: bool = False) -> Column:
    """The template: a capitalised word inside a sentence is a name, a number
    (with points) a number, a unit right after a number a unit. Words of a run
    in capitals are no names. With ``breaks``, newlines, colons and quotes end
    a sentence."""
    return _template(_plain(_with_breaks(text) if breaks else text))


def _with_breaks(text: Column) -> Column:
    return F.regexp_replace(text, rf"[{BREAKS}]+", ". ")


def _template(plain: Column) -> Column:
    """Each pattern first looks at one character, which fails at most places."""
    t = F.regexp_replace(plain, rf"(?=\p{{Lu}})(?<=[\p{{L}}\p{{N}}] )(?!{IN_RUN})\p{{Lu}}[\p{{L}}\p{{N}}]*+(?!\.\p{{N}})", NAME)
    t = F.regexp_replace(t, r"(?=\p{N})(?<![\p{L}\p{N}.])\p{N}++(?:\.\p{N}++)*+(?![\p{L}\p{N}])", NUMBER)
    t = F.regexp_replace(t, rf"({NUMBER} )(?i:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\p{{L}}\p{{N}}])", f"$1{UNIT}")
    return _split(t)


def _readings(rows: DataFrame) -> DataFrame:
    """``rows`` with three readings of ``text``, all of as many words: ``p``,
    the plain words; ``t``, the template, null where it holds no placeholder
    and so says the same; ``b``, the template with sentence breaks, null where
    they make no difference. One column a step, so that each is computed once."""
    between = rf"[\p{{L}}\p{{N}}][^\p{{L}}\p{{N}}.!?{BREAKS}]*+[{BREAKS}][^\p{{L}}\p{{N}}.!?]*+\p{{Lu}}"
    broken = F.when(F.col("text").rlike(f"[{BREAKS}]") & F.col("text").rlike(between), _template(_plain(_with_breaks(F.col("text")))))
    slots = F.col("plain").rlike(r"\p{N}|(?=\p{Lu})(?<=[\p{L}\p{N}] )\p{Lu}")
    return rows.withColumn("plain", _plain(F.col("text"))) \
        .withColumns({"p": _split(F.col("plain")), "t": F.when(slots, _template(F.col("plain"))), "b": broken}).drop("plain")


def _literal(words: Column) -> Column:
    return F.size(F.filter(words, lambda w: ~w.startswith("§")))


def _hashed(words: Column) -> Column:
    """Hash of each word; windows are hashed from these."""
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(words: Column, widths: list[int]) -> Column:
    """For every width an array with the hash of the window at each position.

    Hashes of two neighbouring stretches are hashed to that of both: 2, 4 and
    8 words from the halves, other widths from those parts. Windows that the
    end cuts short have values too, which match none that is whole."""
    def after(x, k):
        return F.slice(x, k + 1, F.greatest(F.size(x) - k, F.lit(0)))

    def joined(x, y, k):
        return F.zip_with(x, after(y, k), lambda a, b: F.xxhash64(a, b))

    def window(parts, width):
        sizes = [k for k in sorted(parts, reverse=True) if width & k]
        got, covered = parts[sizes[0]], sizes[0]
        for k in sizes[1:]:
            got, covered = joined(got, parts[k], covered), covered + k
        return got

    def doubled(parts):
        last = max(parts)
        if last * 2 > max(widths):
            return F.array(*[window(parts, n) for n in widths])
        return let(joined(parts[last], parts[last], last), lambda x: doubled({**parts, last * 2: x}))

    return let(words, lambda x: doubled({1: x}))


def benchmark_windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """``hash, item_id, version, item_pos, width, kind, n_windows`` of the items'
    windows. Kind ``template``: windows in which over half of the words are
    literal, under the hash of each reading and of the plain words; kind
    ``plain``: every window of the plain words. An item of fewer words than
    ``width`` is one window of its own width; one of up to ``NARROW_WORDS``
    has windows of ``NARROW`` words beside the others. Repeated items count
    once; texts of one id count by version."""
    text = text_or_empty(F.col("text"))
    read = _readings(items.select("item_id", text.alias("text")).distinct())
    template = F.coalesce("t", "p")
    words = read.select("item_id", F.xxhash64("text").alias("version"), template.alias("w"), F.coalesce("b", template).alias("b"), "p").where(F.size("p") > 0)
    own = F.least(F.lit(width), F.size("w"))
    words = words.withColumn("width", F.explode(F.when((F.size("w") > width) & (F.size("w") <= NARROW_WORDS), F.array(own, F.lit(NARROW))).otherwise(F.array(own))))
    every = words.withColumn("item_pos", F.explode_outer(F.sequence(F.lit(0), F.size("w") - F.col("width"))))
    part = lambda c: F.slice(c, F.col("item_pos") + 1, F.col("width"))

    def hashed(c):
        whole = _windows(_hashed(part(c)), list(range(1, width + 1)))
        return F.get(F.get(whole, F.col("width") - 1), F.lit(0))

    useful = lambda c: _literal(part(c)) * 2 > F.col("width")
    none = F.array().cast("array<bigint>")
    by_template = F.concat(F.when(useful("w"), F.array(hashed("w"), hashed("p"))).otherwise(none),
                           F.when(useful("b"), F.array(hashed("b"), hashed("p"))).otherwise(none))
    kinds = F.array(F.struct(F.lit("template").alias("kind"), F.array_distinct(by_template).alias("h")),
                    F.struct(F.lit("plain").alias("kind"), F.array(hashed("p")).alias("h")))
    rows = every.select("item_id", "version", "item_pos", "width", F.explode(kinds).alias("k")) \
        .select("item_id", "version", "item_pos", "width", "k.kind", F.explode("k.h").alias("hash"))
    counted = rows.groupBy(F.col("item_id").alias("_id"), F.col("version").alias("_version"), F.col("kind").alias("_kind"), F.col("width").alias("_width")) \
        .agg(F.countDistinct("item_pos").alias("n_windows"))
    same = F.col("item_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version")) & (F.col("kind") == F.col("_kind")) & \
        (F.col("width") == F.col("_width"))
    return rows.join(counted, same).select("hash", "item_id", "version", "item_pos", "width", "kind", "n_windows")


def leaks(docs: DataFrame, items: DataFrame, least_share: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and item that it leaks: ``doc_id, item_id,
    n_windows, matched, share, n_slots, n_changed``.

    matched counts the item's windows on the best alignment and those next to
    it, by template or plain words; share is matched / n_windows and reaches
    ``least_share``, unless ``QUOTE`` words in a row agree. One edit anywhere
    leaves enough of an item of 14 words or more; shorter ones may be lost by
    an edit in their middle. n_slots counts the placeholders of the matched
    windows, n_changed those with another value (0: verbatim). Null or empty texts and items leak
    nothing; documents of one id count as one. An empty table on either side
    gives no rows; other columns are not read.
    """
    share = F.col("matched") / F.col("n_windows")
    top = leaking_texts(docs, items, least_share, id_col, text_col).groupBy("doc_id", "item_id").agg(
        F.max(F.struct(share.alias("share"), "width", "matched", "n_windows", (-F.col("n_changed")).alias("c"), "n_slots")).alias("b"))
    return top.select("doc_id", "item_id", "b.n_windows", "b.matched", "b.share", "b.n_slots", (-F.col("b.c")).alias("n_changed"))


def leaking_texts(docs: DataFrame, items: DataFrame, least_share: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``leaks`` is made of, for every id and text (``version``: its hash)."""
    windows = saved(benchmark_windows(items.select("item_id", "text")).withColumnRenamed("version", "item_version"), "benchmark_windows")
    side = few(windows, BROADCAST_ROWS)
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())  # WINDOW values at most
    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    forms = _readings(rows).select("doc_id", F.xxhash64("text").alias("version"), *[_hashed(F.col(c)).alias(c) for c in "ptb"])
    every = forms.select("doc_id", "version", F.size("p").alias("n"), *[F.when(F.col(c).isNotNull(), _windows(F.col(c), widths or [WINDOW])).alias(c) for c in "ptb"])

    def others(c):
        """Null where the window reads as the plain words do."""
        differs = lambda x, y: F.zip_with(x, y, lambda a, b: F.when(a != b, a))
        return F.coalesce(F.zip_with(c, "p", differs), F.array().cast("array<array<bigint>>"))

    hashes = F.flatten(F.concat("p", others("t"), others("b")))
    # outer: a plain explode would have the hashes computed twice, for a filter on their number
    flat = every.select("doc_id", "version", "n", F.posexplode_outer(hashes).alias("at", "hash")).where("hash is not null") \
        .select("doc_id", "version", (F.col("at") % F.col("n")).alias("pos"), "hash")
    found = flat.join(side, "hash").select(
        "doc_id", "version", "item_id", "item_version", "kind", "width", "n_windows", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"))
    # every shift is in two overlapping groups of shifts
    group = F.array(F.floor(F.col("shift") / SHIFTS) * 2, F.floor((F.col("shift") + SHIFTS // 2) / SHIFTS) * 2 + 1)
    alignment = ["doc_id", "version", "item_id", "item_version", "kind", "width", "n_windows"]
    once = found.groupBy(*alignment, "shift", "item_pos").agg(F.lit(1).alias("one")).withColumn("group", F.explode(group))
    aligned = once.groupBy(*alignment, "group").agg(F.countDistinct("item_pos").alias("matched"), F.sort_array(F.collect_set(F.struct("shift", "item_pos"))).alias("at"))
    more = QUOTE - F.col("width")  # windows that follow the first of a quote
    quoted = let(F.col("at"), lambda at: F.exists(F.sequence(F.lit(0), F.size(at) - 1), lambda i: F.coalesce(
        (F.get(at, i)["shift"] == F.get(at, i + more)["shift"]) & (F.get(at, i)["item_pos"] + more == F.get(at, i + more)["item_pos"]), F.lit(False))))
    best = aligned.where((F.col("matched") >= least_share * F.col("n_windows")) | ((F.col("matched") > more) & quoted))
    best = saved(best, "leak_candidates")

    ids = best.select(F.col("doc_id").alias("_id")).distinct()
    texts = rows.join(few(ids, BROADCAST_IDS), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    said = texts.withColumn("version", F.xxhash64("text")).dropDuplicates(["doc_id", "version"]).select(
        F.col("doc_id").alias("_id"), F.col("version").alias("_version"), raw_words(F.col("text")).alias("dw"), template_words(F.col("text")).alias("dt"))
    asked = items.select(F.col("item_id").alias("_item"), text_or_empty(F.col("text")).alias("q")).distinct().select(
        "_item", F.xxhash64("q").alias("_item_version"), raw_words(F.col("q")).alias("iw"), template_words(F.col("q")).alias("it"))
    both = best.join(said, best["doc_id"].eqNullSafe(said["_id"]) & (best["version"] == said["_version"])).join(
        asked, best["item_id"].eqNullSafe(asked["_item"]) & (best["item_version"] == asked["_item_version"]))
    # the words of the matched windows, each with its place in the document
    words = F.array_distinct(F.flatten(F.transform("at", lambda x: F.transform(
        F.sequence(F.lit(0), F.col("width") - 1), lambda n: F.struct((x["item_pos"] + n).alias("i"), (x["item_pos"] + n + x["shift"]).alias("j"))))))
    slots = F.filter(
        F.transform("words", lambda x: F.struct(F.get("iw", x["i"]).alias("i"), F.get("dw", x["j"]).alias("d"), F.get("it", x["i"]).alias("k"),
                                                F.get("dt", x["j"]).alias("l"))),
        lambda s: s["k"].startswith("§") & (s["k"] == s["l"]))
    pairs = both.withColumn("words", words).withColumn("slots", slots)
    kinds = lambda f: F.size(F.array_distinct(F.transform("slots", f)))
    n_pairs = kinds(lambda s: F.struct(s["k"], s["i"], s["d"]))
    # one value for each of the item's; two of them may have become equal
    consistent = (n_pairs == kinds(lambda s: F.struct(s["k"], s["i"]))) & (n_pairs <= kinds(lambda s: F.struct(s["k"], s["d"])) + 1)
    changed = F.size(F.filter("slots", lambda s: s["i"] != s["d"]))
    return pairs.where((changed * 2 < F.size("slots")) | consistent).select("doc_id", "version", "item_id", "width", "n_windows", "matched", F.size("slots").alias("n_slots"), changed.alias("n_changed"))


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text leaks no item, with their columns as
    they are. Rows that share an id (or have none) are decided text by text;
    null and empty texts stay; repeated rows stay or go together; an empty
    table gives no rows, without items every row stays."""
    found = leaking_texts(docs, items, id_col=id_col, text_col=text_col, **options)
    bad = saved(found.select(F.col("doc_id").alias("_leak_id"), F.col("version").alias("_leak_version")).distinct(), "leak_ids")
    same = docs[id_col].eqNullSafe(F.col("_leak_id")) & (F.xxhash64(text_or_empty(docs[text_col])) == F.col("_leak_version"))
    return docs.join(few(bad, BROADCAST_IDS), same, "left_anti")

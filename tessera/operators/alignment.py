"""Word alignment of two token arrays: edit distance and common subsequence as
column expressions, and the edits that turn one text into the other.

Distance (M7): each distinct word of a pair becomes one code point, and the
built-in ``levenshtein`` compares the two strings. Common subsequence (M4): a
bit vector in 62-bit digits with carries, one step for each word that both
sides hold. Edits (M11) need the way back through the alignment: a small
bit-parallel helper in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import let, word_tokens

#: First code point that stands for a word; a pair may hold a million of them.
FIRST_POINT = 0x10000
#: Bits of a digit: two of them and a carry still fit a long.
DIGIT = 62
_FULL = (1 << DIGIT) - 1


def word_distance(a: Column, b: Column) -> Column:
    """Insertions, deletions and replacements of words between two token
    arrays (no nulls inside); null if an array is null."""
    def pair(x: Column) -> Column:
        points = lambda t: F.array_join(F.transform(t, lambda w: F.lpad(F.hex(F.array_position(x["words"], w) + (FIRST_POINT - 1)), 8, "0")), "")
        text = lambda t: F.decode(F.unhex(points(t)), "UTF-32")
        return F.levenshtein(text(x["a"]), text(x["b"])).cast("long")

    return let(F.struct(a.alias("a"), b.alias("b"), F.array_distinct(F.concat(a, b)).alias("words")), pair)


def _bit(on: Column, place: Column) -> Column:
    return F.call_function("shiftleft", on.cast("long"), place)


def _one_digit(n: Column, masks: Column, common: Column, b: Column) -> Column:
    """Common length where the first array has at most ``DIGIT`` words."""
    def step(v: Column, w: Column) -> Column:
        return let(F.get(masks, F.array_position(common, w).cast("int") - 1)[0], lambda m: (
            ((v + v.bitwiseAND(m)).bitwiseAND(F.lit(_FULL))).bitwiseOR(v.bitwiseAND(F.bitwise_not(m)))))

    return F.aggregate(b, F.lit(_FULL), step, lambda v: F.lit(DIGIT) - F.bit_count(v))


def _more_digits(digits: Column, masks: Column, common: Column, b: Column) -> Column:
    places = F.sequence(F.lit(0), digits - 1)

    def step(v: Column, w: Column) -> Column:
        def added(mask: Column) -> Column:
            start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<long>").alias("out"))

            def digit(acc: Column, k: Column) -> Column:
                x, m = F.get(v, k), F.get(mask, k)
                total = x + x.bitwiseAND(m) + acc["carry"]
                low = total.bitwiseAND(F.lit(_FULL)).bitwiseOR(x.bitwiseAND(F.bitwise_not(m)))
                return F.struct(F.shiftright(total, DIGIT).alias("carry"), F.concat(acc["out"], F.array(low)).alias("out"))

            return F.aggregate(places, start, digit, lambda acc: acc["out"])

        return let(F.get(masks, F.array_position(common, w).cast("int") - 1), added)

    zeros = lambda v: F.aggregate(v, F.lit(0), lambda t, x: t + F.lit(DIGIT) - F.bit_count(x))
    return F.aggregate(b, F.transform(places, lambda _: F.lit(_FULL)), step, zeros)


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two token arrays (no nulls
    inside); null if an array is null.

    Bit i of the vector is 0 where word i of ``a`` ends a longer match; a word
    of ``b`` adds, with carries, the bits of its places in ``a``. Words that
    one side lacks change nothing and are skipped."""
    def pair(x: Column) -> Column:
        n = F.size(x["a"])
        digits = F.ceil(n / DIGIT).cast("int")

        def mask(w: Column) -> Column:
            def digit(k: Column) -> Column:
                inside = F.sequence(k * DIGIT, F.least(k * DIGIT + DIGIT, n) - 1)
                return F.aggregate(inside, F.lit(0).cast("long"), lambda m, i: m.bitwiseOR(_bit(F.get(x["a"], i) == w, i - k * DIGIT)))

            return F.transform(F.sequence(F.lit(0), digits - 1), digit)

        def steps(y: Column) -> Column:
            b = F.filter(x["b"], lambda w: F.array_contains(x["common"], w))
            one = _one_digit(n, y, x["common"], b)
            return F.when(F.size(x["common"]) == 0, F.lit(0)).when(n <= DIGIT, one).otherwise(_more_digits(digits, y, x["common"], b))

        return let(F.when(n > 0, F.transform(x["common"], mask)).otherwise(F.array().cast("array<array<long>>")), steps).cast("long")

    none = F.lit(None).cast("long")
    return F.when(a.isNull() | b.isNull(), none).otherwise(
        let(F.struct(a.alias("a"), b.alias("b"), F.array_intersect(a, b).alias("common")), pair))


def _columns(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Per word of ``b`` (and before the first) the rises and falls of the edit
    distance from one word of ``a`` to the next, as bits."""
    full = (1 << len(a)) - 1
    places: dict[str, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    rise, fall = full, 0
    out = [(rise, fall)]
    for w in b:
        eq = places.get(w, 0)
        x = eq | fall
        h = ((((eq & rise) + rise) ^ rise) | eq) & full
        up = (fall | ~(h | rise)) & full
        down = rise & h
        up = (up << 1 | 1) & full
        down = (down << 1) & full
        rise = (down | ~(x | up)) & full
        fall = up & x
        out.append((rise, fall))
    return out


def word_edits(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int, list[str]]]:
    """(start, end, replacement) of the places of ``a`` that change, in order,
    so that ``b`` results; end is exclusive.

    Of all shortest alignments the one that, read from the end, keeps or
    replaces a word where it can, else deletes, else inserts. Neighbouring
    changes are one edit."""
    columns = _columns(a, b)

    def distance(i: int, j: int) -> int:
        mask = (1 << i) - 1
        rise, fall = columns[j]
        return j + (rise & mask).bit_count() - (fall & mask).bit_count()

    i, j = len(a), len(b)
    here = distance(i, j)
    steps = []  # (kept, start, end, word of b or none), from the end
    while i or j:
        diagonal = distance(i - 1, j - 1) if i and j else -1
        if i and j and here == diagonal + (a[i - 1] != b[j - 1]):
            i, j, here = i - 1, j - 1, diagonal
            steps.append((a[i] == b[j], i, i + 1, b[j]))
        elif i and here == distance(i - 1, j) + 1:
            i, here = i - 1, here - 1
            steps.append((False, i, i + 1, None))
        else:
            j, here = j - 1, here - 1
            steps.append((False, i, i, b[j]))
    edits: list[tuple[int, int, list[str]]] = []
    open_edit = False
    for kept, start, end, word in reversed(steps):
        if kept:
            open_edit = False
            continue
        words = [] if word is None else [word]
        if open_edit:
            before = edits[-1]
            edits[-1] = (before[0], end, before[2] + words)
        else:
            edits.append((start, end, words))
        open_edit = True
    return edits


def text_edits(df: DataFrame, keys: Sequence[str], source: str, target: str) -> DataFrame:
    """Edits from text pairs: (keys, start, end, replacement), one row per
    edit that turns the tokens of ``source`` into those of ``target``
    (replacement: tokens joined by a blank, empty for a deletion).

    A null text counts as an empty one; equal texts give no rows; an empty
    table gives none. Rows are aligned where they lie (no shuffle); time grows
    with the product of the two lengths over the bits of a machine word."""
    keys = list(keys)
    base = df.select(*keys, word_tokens(source).alias("_source"), word_tokens(target).alias("_target"))

    def run(batches):
        for batch in batches:
            found = [word_edits(a, b) for a, b in zip(batch.column("_source").to_pylist(), batch.column("_target").to_pylist())]
            of = pa.array([i for i, e in enumerate(found) for _ in e], type=pa.int64())
            flat = [x for e in found for x in e]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c).take(of) for c in keys), pa.array([x[0] for x in flat], type=pa.int64()),
                pa.array([x[1] for x in flat], type=pa.int64()), pa.array([" ".join(x[2]) for x in flat], type=pa.string())],
                names=[*keys, "start", "end", "replacement"])

    fields = [f for f in base.schema.fields if f.name in keys] + [
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("replacement", T.StringType())]
    return base.mapInArrow(run, T.StructType(fields))


def apply_edits(tokens: Column, edits: Column) -> Column:
    """The tokens with every edit applied; ``edits`` is an array of (start,
    end, replacement) by start, replacement as in ``text_edits``."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, e: Column) -> Column:
        kept = F.slice(tokens, (acc["at"] + 1).cast("int"), (e["start"] - acc["at"]).cast("int"))
        new = F.when(e["replacement"] == "", F.array().cast("array<string>")).otherwise(F.split(e["replacement"], " "))
        return F.struct(F.concat(acc["out"], kept, new).alias("out"), e["end"].alias("at"))

    return F.aggregate(edits, start, step, lambda acc: F.concat(acc["out"], F.slice(tokens, (acc["at"] + 1).cast("int"), F.greatest(F.size(tokens), F.lit(1)))))

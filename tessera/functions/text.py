"""Column-level text functions (all JVM-side, codegen friendly).

Every function takes and returns ``Column`` objects so that it composes inside
``select``/``withColumn`` and reaches whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word / punctuation-run pre-tokeniser: a run of letters, digits or underscore,
# or a run of anything that is neither those nor white space. Written with
# Unicode classes so that Spark (Java regex), DuckDB (RE2) and Python agree.
WORD_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"
PUNCT_PATTERN = r"[^\p{L}\p{N}_\s]"
CAPITALISED_PATTERN = r"^\p{Lu}"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, also where the
    body names it several times or inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column | str) -> Column:
    """Remove all leading/trailing white space (``trim`` removes blanks only).

    White space inside the text is tried once a run, from its first character
    and without a way back: a long run takes no longer than its length."""
    return F.regexp_replace(_c(c), r"^\s++|\s(?<!\s\s)\s*+$", "")


def null_to_empty(c: Column | str) -> Column:
    """Null text becomes the empty string (never the word ``None``)."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def first_nonempty(*cols: Column | str) -> Column:
    """First value that is non-empty after strip; empty string when none is."""
    parts = [F.nullif(strip(_c(c).cast("string")), F.lit("")) for c in cols]
    return F.coalesce(*parts, F.lit(""))


def first_present(columns: Sequence[str], candidates: Sequence[str], default) -> Column:
    """Field fallback by absence: the first candidate column that exists in
    ``columns`` (decided once, at analysis time), else the literal default."""
    for name in candidates:
        if name in columns:
            return F.col(name)
    return F.lit(default)


def decode_label(c: Column | str, mapping: Mapping, default: str | None = None) -> Column:
    """Integer/str code to word via an in-plan map literal, unknown codes to
    ``default`` (or the raw value as text when default is None)."""
    if not mapping:
        return null_to_empty(c) if default is None else F.coalesce(_c(c).cast("string"), F.lit(default))
    keys_are_int = all(isinstance(k, int) for k in mapping)
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    key = _c(c).try_cast("int") if keys_are_int else _c(c).cast("string")
    fallback = F.lit(default) if default is not None else _c(c).cast("string")
    return F.coalesce(F.element_at(m, key), fallback)


def decode_passthrough(c: Column | str, mapping: Mapping[str, str], as_written: bool = False) -> Column:
    """Mapped when the value is all digits and known, else the raw value as
    text (digit guard first, so "-1" is passed through untouched).

    ``as_written=True`` reproduces the recipes' lookup as written: the maps
    have string keys but are probed with an integer, so nothing is ever found
    and every label stays its raw code ("0", not "World")."""
    raw = null_to_empty(c)
    if not mapping or as_written:
        return raw
    m = F.create_map(*chain.from_iterable((F.lit(str(k)), F.lit(v)) for k, v in mapping.items()))
    return F.when(raw.rlike(r"^[0-9]+$"),
                  F.coalesce(F.element_at(m, raw.try_cast("int").cast("string")), raw)).otherwise(raw)


def stars_to_class(c: Column | str, zero_based: bool = True) -> Column:
    """Rating to sentiment word: 1-2 negativo, 3 neutro, 4-5 positivo."""
    stars = _c(c).cast("int") + (1 if zero_based else 0)
    return (F.when(stars.isin(1, 2), F.lit("negativo"))
            .when(stars == 3, F.lit("neutro"))
            .when(stars.isin(4, 5), F.lit("positivo"))
            .otherwise(F.lit("neutro")))


def shorten(c: Column | str, n: int) -> Column:
    """First n characters plus an ellipsis when longer than n."""
    s = null_to_empty(c)
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit("..."))).otherwise(s)


def normalise_prediction(c: Column | str) -> Column:
    """Answer to class by substring priority: 'pos' -> positivo,
    'neg' -> negativo, anything else neutro."""
    s = F.lower(null_to_empty(c))
    return (F.when(s.contains("pos"), F.lit("positivo"))
            .when(s.contains("neg"), F.lit("negativo"))
            .otherwise(F.lit("neutro")))


def normalise_answer(c: Column | str) -> Column:
    """Lower case, punctuation removed, white space collapsed, stripped."""
    s = F.lower(null_to_empty(c))
    s = F.regexp_replace(s, PUNCT_PATTERN, "")
    s = F.regexp_replace(s, r"\s+", " ")
    return strip(s)


def word_tokens(c: Column | str, lower: bool = False) -> Column:
    """Word/punctuation pre-tokens as ``array<string>``."""
    s = null_to_empty(c)
    if lower:
        s = F.lower(s)
    return F.regexp_extract_all(s, F.lit(WORD_PATTERN), 0)

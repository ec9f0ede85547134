"""Secrets in texts: all rules in one automaton, one pass over the bytes.

The base kinds (assign, access, hex) come first in ``RULES``; the others are
added forms that stand by themselves. The automaton is compiled once on the
driver; tasks get its arrays.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .automaton import Rule, Scanner, compiled
from .common import text_or_empty

_HEAD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
_VALUE = r"[A-Za-z0-9+/_.=-]"
_BODY = "[A-Za-z0-9_-]"
#: Kinds in the order of the results. A run of hex digits counts from 24 on and
#: is looked at from 8 on (none begins inside a shorter one). Lengths are checked
#: on found matches where they are rare, which keeps the automaton small.
RULES = (
    Rule("assign", _HEAD + _VALUE + "{6,}", _HEAD + _VALUE + "{1,5}"),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    Rule("hex", "[0-9a-f]{8,}", least=24),
    Rule("private_key", r"-----BEGIN\x20([A-Z]+\x20)?PRIVATE\x20KEY-----"),
    Rule("github", "gh[oprsu]_[A-Za-z0-9]+", least=40),
    Rule("google", f"AIza{_BODY}+", least=39),
    Rule("web_token", rf"eyJ{_BODY}+\.{_BODY}+\.{_BODY}+", least=40),
)
BASE = ("assign", "access", "hex")


def _in_code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if data.isascii() or not spans:
        return spans
    places, at, chars = {}, 0, 0
    for p in sorted({x for s, e, _ in spans for x in (s, e)}):
        chars += len(data[at:p].decode("utf-8", "surrogatepass"))
        at = places[p] = p
        places[p] = chars
    return [(places[s], places[e], r) for s, e, r in spans]


def _scan(automaton):
    def run(batches):
        scanner = Scanner(automaton)
        kinds = [r.kind for r in automaton.rules]
        for batch in batches:
            out = []
            for data in batch.column("text").cast(pa.binary()).to_pylist():
                out.append([{"kind": kinds[r], "start": s, "end": e} for s, e, r in _in_code_points(data, scanner.spans(data))])
            spans = pa.array(out, type=pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), spans], names=["doc_id", "spans"])

    return run


def find_secrets(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, spans``, an array of (kind, start, end)
    by start, then kind as listed (code points, end exclusive).

    Per kind the leftmost longest matches that do not overlap; spans of
    different kinds may. A null, empty or blank text has none; null ids and
    repeated rows are rows like others; time is linear in the text, however
    long. An empty table gives no rows; other columns are not read. No shuffle.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    return rows.mapInArrow(_scan(compiled(rules)), "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def masked(text: Column, spans: Column) -> Column:
    """The text with a blank mark ``[secret]`` in place of every span; spans
    that overlap share one mark. ``spans`` is that of ``find_secrets``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        more = F.struct(F.concat(a["out"], gap, F.lit("[secret]")).alias("out"), s["end"].alias("at"))
        return F.when(s["start"] >= a["at"], more).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at")))

    return F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))


def secret_digests(docs: DataFrame) -> DataFrame:
    """Counts and digests of the base spans, and all spans, of every document."""
    written = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return find_secrets(docs).select("doc_id", *[count(k) for k in BASE], F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))

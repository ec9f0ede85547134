"""Periodic runs of words, found on a Re-Pair grammar of each text.

A run is a stretch of consecutive words with smallest period q that is at
least ``EXPONENT`` periods and ``LEAST`` words long and that no neighbouring
word extends. Every pair of neighbouring words inside a run occurs three times
or more in the text, so a text is first cut at all rarer pairs; stretches that
are long enough are compressed together by Re-Pair: in rounds, the most
frequent pairs of symbols become nonterminals (pairs of one round never
overlap), until no pair occurs twice. The symbols left over are joined two by
two, so that every boundary between words belongs to one node.

A run lies whole in the lowest node that contains it, and crosses that node's
boundary. So for each nonterminal the repetitions that cross its boundary are
computed once, and stand at every place where the nonterminal is derived; a
repetition that ends at the edge of its nonterminal may go on outside, where
an ancestor finds more of it. Intervals of one period that share a period or
more are parts of one run and are merged.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_or_empty, words

EXPONENT, LEAST = 4, 6
#: Bytes of text that a task works on at once (a longer text by itself).
CHUNK = 4_000_000
#: Pairs of words are counted in so many cells; two pairs in one cell only keep
#: a stretch that would have been cut.
CELLS = 1 << 22

_U = np.uint64


def _same_until(x: np.ndarray, y: np.ndarray) -> int:
    differ = x != y
    at = int(differ.argmax()) if len(differ) else 0
    return at if len(differ) and differ[at] else len(differ)


def _mostly_right(w: np.ndarray, b: int) -> list[tuple[int, int, int]]:
    """Repetitions (start, end, period) of ``w`` that hold word b - 1 and two
    periods or more from word b on."""
    right, n = w[b:], len(w)
    most = min(len(right) // 2, n // EXPONENT)
    if b < 1 or most < 1:
        return []
    out: list[tuple[int, int, int]] = []
    for q in (np.flatnonzero((right[1:most + 1] == right[0]) & (right[:most] == w[b - 1])) + 1).tolist():
        # by the periodicity lemma q would be a multiple of a period found before
        if any(q + p <= e - b or (q % p == 0 and q <= e - b) for _, e, p in out):
            continue
        if not np.array_equal(right[:q], right[q:2 * q]):
            continue
        end = b + q + _same_until(right[:len(right) - q], right[q:])
        start = b - _same_until(w[:b][::-1], w[q:b + q][::-1])
        if end - start >= max(LEAST, EXPONENT * q):
            out.append((start, end, q))
    return out


def crossing(w: np.ndarray, b: int) -> set[tuple[int, int, int]]:
    """(start, end, period) of every repetition in ``w`` that is long enough
    and has words on both sides of boundary ``b``; it has two periods on one."""
    n = len(w)
    if n < LEAST:
        return set()
    mirrored = _mostly_right(w[::-1], n - b)
    return set(_mostly_right(w, b)) | {(n - e, n - s, q) for s, e, q in mirrored}


def _chosen(seq: list[int], fresh: int) -> dict[tuple[int, int], int]:
    """Pairs that become nonterminals in this round, the most frequent first.
    No symbol is the left part of one and the right part of another, so their
    occurrences do not overlap (those of a symbol with itself are taken from
    the left)."""
    often = [(c, p) for p, c in Counter(zip(seq, seq[1:])).items() if c > 1]
    often.sort(key=lambda x: -x[0])
    lefts: set[int] = set()
    rights: set[int] = set()
    pick: dict[tuple[int, int], int] = {}
    for _, (a, b) in often:
        if a in rights or b in lefts or (a == b and (a in lefts or b in rights)):
            continue
        lefts.add(a)
        rights.add(b)
        pick[a, b] = fresh + len(pick)
    return pick


def _replaced(seq: list[int], at: list[int], pick: dict) -> tuple[list[int], list[int], dict[int, list[tuple[int, int]]]]:
    """The sequence with chosen pairs replaced, the places of its symbols, and
    for each nonterminal (start, start of its right part) of its occurrences."""
    new, places, derived = [], [], {x: [] for x in pick.values()}
    i, n = 0, len(seq)
    while i < n:
        x = pick.get((seq[i], seq[i + 1])) if i + 1 < n else None
        places.append(at[i])
        if x is None:
            new.append(seq[i])
            i += 1
        else:
            new.append(x)
            derived[x].append((at[i], at[i + 1]))
            i += 2
    return new, places, derived


def _intervals(ids: np.ndarray, stretches: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(period, start, end) found at all nodes of the grammar of the stretches."""
    seq: list[int] = []
    at: list[int] = []
    for k, (lo, hi) in enumerate(stretches):  # a mark that occurs once stands between stretches
        seq += [*ids[lo:hi].tolist(), -1 - k]
        at += range(lo, hi + 1)
    fresh, length, out = int(ids.max()) + 1, {}, []
    while pick := _chosen(seq, fresh):
        for (a, b), x in pick.items():
            length[x] = length.get(a, 1) + length.get(b, 1)
        seq, at, derived = _replaced(seq, at, pick)
        fresh += len(pick)
        for x, places in derived.items():
            if places and length[x] >= LEAST:
                start, middle = places[0]
                for s, e, q in crossing(ids[start:start + length[x]], middle - start):
                    out += [(q, p + s, p + e) for p, _ in places]
    # what is left of each stretch, joined two by two
    ends = [i for i, s in enumerate(seq) if s < 0]
    for lo, hi in zip([-1, *ends], ends):
        bounds = [*at[lo + 1:hi], at[hi]]
        while len(bounds) > 2:
            for i in range(0, len(bounds) - 2, 2):
                start, middle, end = bounds[i:i + 3]
                out += [(q, start + s, start + e) for s, e, q in crossing(ids[start:end], middle - start)]
            bounds = bounds[::2] if len(bounds) % 2 else [*bounds[::2], bounds[-1]]
    return out


def word_runs(ids: np.ndarray, stretches: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in the stretches, by start, then period."""
    runs: list[list[int]] = []
    for q, s, e in sorted(_intervals(ids, stretches)):
        if runs and runs[-1][0] == q and s <= runs[-1][2] - q:
            runs[-1][2] = max(runs[-1][2], e)
        else:
            runs.append([q, s, e])
    return sorted((s, e - s, q) for q, s, e in runs)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    return x ^ (x >> _U(33))


def text_runs(split: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as its words."""
    known: dict[bytes, int] = {}
    n = np.array([len(w) for w in split], dtype=np.int64)
    flat = np.fromiter((known.setdefault(w, len(known)) for ws in split for w in ws), dtype=np.int64, count=int(n.sum()))
    out: list[list[tuple[int, int, int]]] = [[] for _ in split]
    if len(flat) < LEAST:
        return out
    doc = np.repeat(np.arange(len(split)), n)
    cell = _mix(_mix(flat[:-1].astype(_U) + _U(1)) + _mix(flat[1:].astype(_U) * _U(0x9E3779B97F4A7C15)) + doc[:-1].astype(_U) * _U(0xC2B2AE3D27D4EB4F))
    cell = (cell >> _U(42)).astype(np.int64)
    inside = (np.bincount(cell, minlength=CELLS)[cell] > 2) & (doc[:-1] == doc[1:])
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
    lo, hi = edge[::2], edge[1::2] + 1
    long_enough = hi - lo >= LEAST
    first = np.concatenate([[0], np.cumsum(n)])
    stretches: dict[int, list[tuple[int, int]]] = {}
    for a, b in zip(lo[long_enough].tolist(), hi[long_enough].tolist()):
        d = int(doc[a])
        stretches.setdefault(d, []).append((a - int(first[d]), b - int(first[d])))
    for d, parts in stretches.items():
        out[d] = word_runs(flat[first[d]:first[d + 1]], parts)
    return out


def _collapsed(w: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(w)
    gone = np.zeros(len(w) + 1, dtype=np.int64)
    for s, length, q in runs:
        gone[s + q] += 1
        gone[s + length] -= 1
    return b" ".join([x for x, g in zip(w, np.cumsum(gone).tolist()) if not g])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _chunks(texts: list[bytes]):
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield lo, texts[lo:i + 1]
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, texts[lo:]


def _found(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lo, part in _chunks(texts):
            split = [t.split() for t in part]  # bytes split at space and \t to \r only
            runs = text_runs(split)
            ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            flat = np.array([x for r in runs for x in r], dtype=np.int64).reshape(-1, 3)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(lo, len(part)), pa.array([len(w) for w in split], type=pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), structs),
                pa.array([_collapsed(w, r) for w, r in zip(split, runs)], type=pa.binary()).cast(pa.string()),
            ], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, runs, collapsed``.

    ``runs`` has (start, length, period) of every run in words, by start, then
    period; ``collapsed`` is the text's words joined by one space without those
    that any run holds after its first period. Words are runs of anything but
    space and \\t to \\r. A null, empty or blank text has no words, no runs and
    an empty collapsed text; null ids and repeated rows are rows like others;
    a very long text is one task's work in memory that grows with its words.
    An empty table gives no rows; other columns are not read. No shuffle.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    return rows.mapInArrow(_found, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def tiled_text(doc_id: Column, text: Column) -> Column:
    """The text, of every tenth document (h % 10 = 0 for h = crc32 of the id,
    g = h div 10) with its words from a = g % n on replaced by repetitions of
    the first p = 1 + (n - a) div (3 + g % 8) of them. Null ids: as it is."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def placed(x: Column) -> Column:
        w, a, p = x["w"], x["a"], x["p"]
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, at(i))), " ")

    def parts(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        return F.when(n > 0, let(F.struct(w.alias("w"), a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p")), placed)).otherwise(text_or_empty(text))

    return F.when(h % 10 == 0, let(words(text), parts)).otherwise(text_or_empty(text))


def run_digests(docs: DataFrame) -> DataFrame:
    """The digest columns of the runs of tiled documents; cases as in
    ``periodic_runs``."""
    rows = docs.select("doc_id", tiled_text(F.col("doc_id"), F.col("text")).alias("text"))
    runs = F.col("runs")
    lines = F.array_join(F.transform(runs, lambda r: F.concat(*[F.concat(r[c].cast("string"), F.lit(e)) for c, e in (("start", ","), ("length", ","), ("period", "\n"))])), "")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    found = periodic_runs(rows).select("doc_id", F.size(runs).cast("long").alias("n_runs"), longest.alias("top"),
                                       F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("top.length"), -F.col("top.p")
    return found.select("doc_id", "n_runs", (-F.col("top.s")).alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(1000 * length / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")

"""Overlap of the n-grams of two texts, counted in Arrow batches (M6).

A batch of pairs is one array of symbols per side (code points, or 64-bit word
hashes). The keys of the grams of one order are made from those of the order
before; a pair's place in the batch is mixed into them, so that one sort of the
keys of both sides puts equal grams of a pair side by side. The overlap is the
sum of the smaller counts. Keys have 63 bits: among m of them, two different
grams meet with a chance of at most m * m / 2**64 (3e-7 for ``SYMBOLS``), and
one such case changes the sum of its order by no more than its counts.

Memory: pairs are taken until they hold ``SYMBOLS`` symbols; one longer pair is
taken alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import word_tokens

#: Symbols of both sides that are counted at a time.
SYMBOLS = 2_000_000
#: Character orders are numbered from 1, word orders from here + 1.
WORD_ORDERS = 100


def word_ids(c: str) -> Column:
    """The lower-cased word tokens of a column as 64-bit hashes."""
    return F.transform(word_tokens(c, lower=True), lambda t: F.xxhash64(t))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Two rounds of multiply and shift, so that all bits of a key depend on all of ``x``."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _gram_keys(symbols: np.ndarray, lengths: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Keys of the grams of order 1, 2, ..., ``most``; a gram lies in one text."""
    symbols = _mixed(symbols + np.uint64(1))
    start = np.arange(len(symbols))
    left = np.repeat(np.cumsum(lengths), lengths) - start
    keys = _mixed(np.repeat(np.arange(1, len(lengths) + 1, dtype=np.uint64), lengths))
    for n in range(1, most + 1):
        fits = left >= n
        start, left = start[fits], left[fits]
        keys = _mixed(keys[fits] * np.uint64(0xA24BAED4963EE407) + symbols[start + (n - 1)])
        yield keys


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two bags of keys."""
    keys = np.concatenate([a & ~np.uint64(1), b | np.uint64(1)])
    if not len(keys):
        return 0
    keys.sort()
    side = (keys & np.uint64(1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (keys[1:] >> np.uint64(1)) != (keys[:-1] >> np.uint64(1))]))
    of_b = np.add.reduceat(side, first)
    of_both = np.diff(np.append(first, len(keys)))
    return int(np.minimum(of_b, of_both - of_b).sum())


def _code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and how many each text has."""
    plain = [t or "" for t in texts.to_pylist()]
    flat = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    return flat, np.fromiter(map(len, plain), dtype=np.int64, count=len(plain))


def _hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and how many each text has."""
    flat = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return flat, words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _pieces(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of rows of at most ``SYMBOLS`` symbols, one row at least."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > SYMBOLS:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def gram_overlaps(char_n: int, word_n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function: pairs (c_text, r_text, c_words, r_words) to
    sums per order (n, ov, ct, rt): shared grams, and those of either side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        for batch in batches:
            for read, of, offset, most in ((_code_points, "text", 0, char_n), (_hashes, "words", WORD_ORDERS, word_n)):
                c, c_len = read(batch.column(f"c_{of}"))
                r, r_len = read(batch.column(f"r_{of}"))
                c_at, r_at = np.append(0, np.cumsum(c_len)), np.append(0, np.cumsum(r_len))
                for i, j in _pieces(c_len + r_len):
                    pairs = zip(_gram_keys(c[c_at[i]:c_at[j]], c_len[i:j], most),
                                _gram_keys(r[r_at[i]:r_at[j]], r_len[i:j], most))
                    for n, (a, b) in enumerate(pairs, offset + 1):
                        row = sums.setdefault(n, [0, 0, 0])
                        row[0], row[1], row[2] = row[0] + _shared(a, b), row[1] + len(a), row[2] + len(b)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums, type=pa.int32()), *(pa.array([v[k] for v in sums.values()], type=pa.int64()) for k in range(3))],
                names=["n", "ov", "ct", "rt"])

    return run

"""Token-ID files: ORC stripes sorted by document id.

Documents are dealt to files by ranges of their id, sorted, encoded, and
written as ORC. Token ids are an integer column, which ORC stores with its
run-length encoding; row indexes (minimum and maximum of every ``stride``
rows) and Bloom filters on the document id let a reader skip stripes and row
groups, and stripes are read in parallel. Every row also holds the number of
ids before it in its file, so the position of a document in the whole stream
is that number plus the ids of the earlier files (one row per file).
"""

from __future__ import annotations

import json
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_or_empty

#: Columns of the files.
SCHEMA = "doc_id long, tie long, start_in_file long, n_tokens long, ids array<int>"
#: Words that a worker remembers with their ids (two generations of half of it).
REMEMBER = 400_000
#: Longer words are encoded each time.
LONG_WORD = 48
#: Words encoded by parts: printable ASCII but "<", with which added tokens start, and the letters of Latin-1, each
#: of which is one letter after the steps before the merges, whatever stands beside it.
TAKEN = re.compile("[!-;=-~À-ÖØ-öø-ÿ]+")
#: The parts of such a word in lower case: ``SPLITS`` for these characters.
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
#: Marks before which a word may end: bytes of the marks, of A-Z and "\n" folded, of letters and digits, and of the
#: second half of a letter of ``TAKEN`` whose first half is 0xC3.
MARK_BYTES = bytes(c in b".,;:!?#$%&*|" for c in range(256))
FOLD_BYTES = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 10 else c for c in range(256))
ALNUM = np.array([c < 128 and chr(c).isalnum() for c in range(256)])
HALF = np.array([0x80 <= c <= 0xBF and c not in (0x97, 0xB7) for c in range(256)])
#: Steps before the merges for which words are encoded by parts and in lower case, as the library writes them: fixed values.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITS = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def worker_state(name: str) -> dict:
    """A dict that lives as long as the Python worker and so is shared by the
    tasks that it runs one after the other."""
    return sys.modules.setdefault("_tessera_worker_" + name, types.ModuleType(name)).__dict__


class _Words(dict):
    """Ids of words, and of the generation before."""

    def __init__(self, old: dict | None = None):
        super().__init__()
        self.old = old or {}


class WordEncoder:
    """Encodes texts with the tokenizers library, word by word from memory.

    Valid for tokenizers that remove white space before their merges, so that
    no token crosses a blank or a line end: then the ids of a text are those
    of its words. Some texts at a time are split and their distinct words
    numbered by Arrow; a distinct word is looked up once for these texts, and
    goes through the library once while it is remembered. Memory is bounded by
    ``REMEMBER`` words.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Words()
        self.starts = {t.content[0] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.parts = self._takes_parts() and self.starts <= {"<"}
        spelt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = [(c, spelt(c)[0][0]) for c in map(chr, range(0xDF, 0x100))]

    def _whole(self, words: list[str], into: dict[str, bytes]) -> None:
        """Encode ``words`` as texts of some words and cut the ids by their offsets."""
        for lo in range(0, len(words), 128):
            part = words[lo:lo + 128]
            got = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.asarray(got.ids, dtype="<u4")
            at = np.fromiter((o[0] for o in got.offsets), dtype=np.int64, count=len(ids))
            cut = np.searchsorted(at, np.cumsum([len(w) + 1 for w in part]))
            raw, lo_id = ids.tobytes(), 0
            for w, hi_id in zip(part, cut.tolist()):
                into[w] = raw[4 * lo_id:4 * hi_id]
                lo_id = hi_id

    def _learn(self, words: list[str], into: dict[str, bytes]) -> None:
        """Ids of words, by their parts: each part is a token run of its own
        and is encoded once, in lower case, as it reaches the library's merges
        after the steps before them. Words with other characters go through
        all steps of the library."""
        if not self.parts:
            return self._whole(words, into)
        known, old, taken, split = self.words.get, self.words.old.get, TAKEN.fullmatch, PARTS.findall
        alone, mixed, rest = [], [], []
        for w in words:
            if w.isalpha() and w.isascii() and w.islower():
                alone.append(w)
            elif taken(w):
                parts = split(w.lower())
                if parts[0] == w:
                    alone.append(w)
                else:
                    mixed.append((w, parts))
            else:
                rest.append(w)
        fresh = dict.fromkeys(alone)
        for _, parts in mixed:
            for part in parts:
                if part not in fresh and part not in into:
                    ids = known(part) or old(part)
                    if ids:
                        into[part] = ids
                    else:
                        fresh[part] = None
        self._merge(list(fresh), into)
        into.update((w, b"".join([into[part] for part in parts])) for w, parts in mixed)
        self._whole(rest, into)

    def _merge(self, parts: list[str], into: dict[str, bytes]) -> None:
        """Ids of parts of words by the library's merges alone."""
        spelt = "\n".join(parts)
        if not spelt.isascii():
            for letter, as_bytes in self.spelling:
                spelt = spelt.replace(letter, as_bytes)
        merge, ids, ends = self.tokenizer.model.tokenize, [], [0]
        for part in spelt.split("\n") if parts else []:
            ids += [t.id for t in merge(part)]
            ends.append(4 * len(ids))
        raw = np.array(ids, dtype="<u4").tobytes()
        into.update((part, raw[lo:hi]) for part, lo, hi in zip(parts, ends, ends[1:]))

    def _takes_parts(self) -> bool:
        """The steps before the merges are those that ``_learn`` and
        ``_spaced`` rely on; any other tokenizer encodes whole words."""
        steps = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        # their pickled state is JSON; that of the whole tokenizer would hold its vocabulary too
        return None not in steps and [json.loads(s.__getstate__()) for s in steps] == [
            {"type": "Sequence", "normalizers": NORMALIZERS}, {"type": "Sequence", "pretokenizers": [SPLITS, BYTES]}]

    def _spaced(self, texts: list[str]) -> pa.Array:
        """``texts`` with line ends as blanks, A-Z as a-z and a blank before
        the marks that follow a letter or digit, so that a word is remembered
        in one form: the library folds letters and ends a token run there too.
        A text stays as it is, but for line ends, if it has a mark that joins
        the character before it (U+0300 to U+036F; some join only the small
        letter), or a character with which a token starts that is looked for
        in the text as given."""
        raw, plain = [], []
        for t in texts:
            b = t.encode()
            plain.append(self.parts and b"\xcc" not in b and b"\xcd" not in b and not any(c in t for c in self.starts))
            raw.append(b.translate(FOLD_BYTES) if plain[-1] else b.replace(b"\n", b" "))
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ends = np.concatenate([[0], np.cumsum([len(b) for b in raw], dtype=np.int64)])
        at = np.flatnonzero(np.frombuffer(data.tobytes().translate(MARK_BYTES), dtype=bool))
        at = at[at > 1]
        at = at[ALNUM[data[at - 1]] | (HALF[data[at - 1]] & (data[at - 2] == 0xC3))]
        at = at[np.array(plain, dtype=bool)[np.searchsorted(ends, at, side="right") - 1]]
        data = np.insert(data, at, 32)
        return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends + np.searchsorted(at, ends)), pa.py_buffer(data))

    def _look_up(self, distinct: list[str]) -> list[bytes]:
        """Ids of distinct words; those not remembered are learnt."""
        words, learnt = self.words, {}
        cells = list(map(words.get, distinct))
        missing = [i for i, ids in enumerate(cells) if ids is None]
        if missing:
            new = [distinct[i] for i in missing]
            before = list(map(words.old.get, new))
            learnt.update((w, ids) for w, ids in zip(new, before) if ids is not None)
            self._learn([w for w, ids in zip(new, before) if ids is None], learnt)
            for i, w in zip(missing, new):
                cells[i] = learnt[w]
            words.update(learnt)
            for w in [w for w in learnt if len(w) > LONG_WORD]:
                del words[w]
            if len(words) > REMEMBER // 2:
                words.old = {}
                self.words = _Words(words)
        return cells

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        split = pc.split_pattern(self._spaced(texts), " ")
        found = split.flatten().dictionary_encode()
        cells = self._look_up(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, cells), dtype=np.int64, count=len(cells)) // 4
        pool = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]), np.frombuffer(b"".join(cells), dtype="<i4"))
        before = np.concatenate([[0], np.cumsum(size[found.indices.to_numpy()])])
        return pool.take(found.indices).flatten().to_numpy(), np.diff(before[split.offsets.to_numpy()])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        ids, n = self.encode_flat(texts)
        return [part.tobytes() for part in np.split(ids, np.cumsum(n)[:-1])] if texts else []


def _encoder(path: str) -> WordEncoder:
    state = worker_state("word_encoders")
    if path not in state:
        state[path] = WordEncoder(path)
    return state[path]


def _batches(texts: list[str], most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` characters each."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _encode(path: str, end_id: int):
    def run(batches):
        encoder, before = _encoder(path), 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in _batches(texts):
                ids, n = encoder.encode_flat(texts[lo:hi])
                ids = pa.array(np.insert(ids, np.cumsum(n), end_id))
                n = n + 1
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo), batch.column("tie").slice(lo, hi - lo),
                    pa.array(before + ends - n), pa.array(n),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), ids),
                ], names=["doc_id", "tie", "start_in_file", "n_tokens", "ids"])
                before += int(ends[-1])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 stride: int = 1000, stripe_bytes: int = 64 << 20) -> None:
    """Encode every whole text (null: empty), append ``end_id`` and write the
    ids in ascending order of document id (null first) as ORC under ``path``.

    Rows of one id lie side by side, ordered by a hash of the text; they may
    lie in two neighbouring files. An empty table writes no rows; other
    columns are not read. Texts, not ids, are shuffled: they are smaller.
    """
    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    (ordered.mapInArrow(_encode(tokenizer_path, end_id), SCHEMA).write
     .option("compression", "zstd").option("orc.create.index", "true").option("orc.row.index.stride", stride)
     .option("orc.stripe.size", stripe_bytes).option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files with ``start``: all ids before the document.

    File order and file totals come from the narrow columns; the offsets
    (one row per file) are the only broadcast.
    """
    rows = spark.read.schema(SCHEMA).orc(path).withColumn("_file", F.col("_metadata.file_path"))
    files = rows.groupBy("_file").agg(F.min(F.struct("doc_id", "tie", "start_in_file")).alias("_first"),
                                      F.max(F.col("start_in_file") + F.col("n_tokens")).alias("_ids"))
    before = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("_file", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))
    return (rows.join(F.broadcast(offsets), "_file")
            .select("doc_id", (F.col("_before") + F.col("start_in_file")).alias("start"), "ids"))


def documents_by_id(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """Rows of some documents: the predicate reaches the ORC reader, which
    skips stripes and row groups by index and Bloom filter."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(ids)).select("doc_id", "ids")


def _digest(batches):
    for batch in batches:
        lists = batch.column("ids")
        flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        raw = memoryview(flat.tobytes())
        crc = [zlib.crc32(raw[4 * lo:4 * hi]) for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends).astype(np.int64)),
                                          pa.array(crc, type=pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    return read_tokens(spark, path).mapInArrow(_digest, "doc_id long, start long, n_tokens long, ids_crc32 long")

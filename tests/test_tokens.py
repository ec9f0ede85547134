"""Tokens, BPE and packing."""

import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from tessera.functions.text import word_tokens
from tessera.operators import tokens as tk


def test_merge_pair(spark):
    df = spark.createDataFrame([(["a", "a", "a", "b"],), (["a", "b", "a", "b"],)], "s array<string>")
    got = [r[0] for r in df.select(tk.merge_pair(F.col("s"), "a", "a")).collect()]
    assert got == [["aa", "a", "b"], ["a", "b", "a", "b"]]


def test_batched_bpe_equals_one_at_a_time(spark):
    texts = ["the cat and the hat", "then there were three", "banana bandana", "aaaa aa a"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    words = tk.word_counts(df)
    fast = tk.train_bpe(words, vocab_size=60)
    slow = tk.train_bpe_reference(words, vocab_size=60)
    assert fast == slow


def test_encode_roundtrip(spark):
    df = spark.createDataFrame([(1, "the cat"), (2, "zz")], "id int, text string")
    vocab, merges = tk.train_bpe(tk.word_counts(df), vocab_size=20)
    enc = {r.id: r.ids for r in tk.bpe_encode(df, "text", vocab, merges).collect()}
    assert "".join(vocab[i] for i in enc[1]) == "thecat"


def test_pack_keeps_tokens(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet").select(F.col("doc_id").alias("id"),
                                                                 F.size(word_tokens("text")).alias("n"))
    blocks = tk.pack(d, "n", 512, ["id"])
    total = d.agg(F.sum(F.col("n") + 1)).first()[0]
    assert blocks.agg(F.sum("n_tokens")).first()[0] == total
    assert blocks.where(F.col("n_tokens") > 512).count() == 0
    assert blocks.where(F.col("n_tokens") < 512).count() == 1


def _encode_plain(word, ranks):
    """Lowest-rank pair first, all its occurrences, by copying the symbols."""
    syms = list(word)
    while True:
        best = min((ranks[p] for p in zip(syms, syms[1:]) if p in ranks), default=None)
        if best is None:
            return syms
        syms = tk._merged(syms, *next(p for p, r in ranks.items() if r == best))


_PIECES = st.sampled_from(["a", "b", "c", "ab", "bc", "abc", "aa", "cab"])


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=40), st.lists(st.tuples(_PIECES, _PIECES), max_size=12, unique=True))
def test_heap_merges_equal_plain_merges(word, merges):
    ranks = {m: i for i, m in enumerate(merges)}
    assert tk.merge_word(word, ranks) == _encode_plain(word, ranks)


def test_a_very_long_token_is_encoded_fast():
    ranks = {("a", "b"): 0, ("ab", "ab"): 1, ("abab", "ab"): 2, ("b", "a"): 3}
    start = time.time()
    assert "".join(tk.merge_word("ab" * 20000, ranks)) == "ab" * 20000
    assert time.time() - start < 1


@pytest.mark.parametrize("texts", [
    ["aaaa aaa aaaaaaa", "ab abab ababab bab", "abcabc abc bcabc xabc xabcd"],  # the same symbol made in two ways
    ["a b c", "é è 日本 日本語 本語", "don't don't, end."], [], ["x"], [None, ""]])
def test_differences_equal_recounting(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts] * 2, "text string")
    words = tk.word_counts(df)
    want = tk.train_bpe_reference(words, vocab_size=34)
    assert tk.train_bpe(words, vocab_size=34) == want
    assert tk.train_bpe(words, vocab_size=34, known_pairs=2) == want


def test_training_on_documents_equals_recounting(spark):
    words = tk.word_counts(spark.read.parquet(f"{SF001}/documents.parquet").select(F.substring("text", 1, 2000).alias("text"))).where("freq > 30")
    words = words.where(~F.col("word").rlike("[^a-z]"))
    vocab, merges = tk.train_bpe(words, vocab_size=60)
    assert (vocab, merges) == tk.train_bpe_reference(words, vocab_size=60) and len(merges) > 20


def test_packed_blocks_join_to_the_stream(spark):
    rows = [(i, None if i == 3 else [i * 100 + k for k in range((i * 7) % 23)]) for i in range(1, 60)]
    df = spark.createDataFrame(rows, "id long, ids array<int>").withColumn("tokens", F.lit("clash")).withColumn("block_id", F.lit(1))
    blocks = sorted(tk.pack_blocks(df, "ids", 16, ["id"], -1).collect())
    stream = [x for _, t in rows for x in [*(t or []), -1]]
    assert [b.block_id for b in blocks] == list(range(-(-len(stream) // 16)))
    assert [x for b in blocks for x in b.tokens] == stream and all(len(b.tokens) == 16 for b in blocks[:-1])
    again = {}
    for b in blocks:
        assert [e.start for e in b.examples] == [0] + [e.stop for e in b.examples][:-1] and b.examples[-1].stop == len(b.tokens)
        for e in b.examples:
            again.setdefault(e.id, []).extend(b.tokens[e.start:e.stop])
    assert again == {i: [*(t or []), -1] for i, t in rows}
    assert tk.pack_blocks(df.where("id < 0"), "ids", 16, ["id"], -1).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=12), st.integers(1, 5)), max_size=8), st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=1, max_size=3))
def test_merges_of_a_batch_equal_merges_of_words(words, pairs):
    tried = [(a, b, 3 + k) for k, (a, b) in enumerate(pairs)]
    flat = np.concatenate([[0], *[[*w, 0] for w, _ in words]]).astype("<i2")
    batch = tk._packed(np.array([x for w, _ in words for x in w], dtype=np.int64), np.array([len(w) for w, _ in words], dtype=np.int64),
                       np.array([f for _, f in words], dtype=np.int64), "<i2")
    assert len(np.frombuffer(batch.column("symbols")[0].as_py(), "<i2")) == len(flat)
    got = {(r["step"], r["left"], r["right"]): r["count"] for b in tk._changes_of([], tried, "<i2")([batch]) for r in b.to_pylist()}
    want = Counter()
    for w, f in words:
        symbols = [chr(97 + x) for x in w]
        for k, (a, b, new) in enumerate(tried):
            merged, i = [], 0
            while i < len(symbols):
                hit = symbols[i:i + 2] == [chr(97 + a), chr(97 + b)]
                merged.append(chr(97 + new) if hit else symbols[i])
                i += 1 + hit
            for p, sign in ((symbols, -f), (merged, f)):
                for x, y in zip(p, p[1:]):
                    want[k, ord(x) - 97, ord(y) - 97] += sign
            symbols = merged
    assert got == {k: c for k, c in want.items() if c}


def test_words_written_anew_give_the_same_merges(spark, monkeypatch):
    words = tk.word_counts(spark.createDataFrame([("the cat and the hat then there were three banana bandana aaaa aa a",)], "text string"))
    want = tk.train_bpe_reference(words, vocab_size=45)
    monkeypatch.setattr(tk, "WRITE_EVERY", 3)
    assert tk.train_bpe(words, vocab_size=45) == want


def test_texts_in_pieces_give_the_ids_of_their_words(spark, monkeypatch):
    texts = ["the cat and the hat", None, "", "zz the", "a" * 70 + " a", "the " * 40, "banana bandana \U0001d11e", "  "]
    df = spark.createDataFrame([(i, texts[i % 8]) for i in range(40)], "id int, text string")
    vocab, merges = tk.train_bpe(tk.word_counts(df.where("id not in (3, 6)")), vocab_size=30)
    ranks, ids = {m: i for i, m in enumerate(merges)}, {t: i for i, t in enumerate(vocab)}
    want = {r.id: [ids.get(s, 0) for w in r.w for s in tk.merge_word(w, ranks)] for r in df.select("id", word_tokens("text").alias("w")).collect()}
    for most in (3, 500_000):
        monkeypatch.setattr(tk, "WORDS_AT_A_TIME", most)
        assert {r.id: r.ids for r in tk.bpe_encode(df.coalesce(1), "text", vocab, merges).collect()} == want

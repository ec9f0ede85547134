import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import AWKWARD, make_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.tokenfiles import WordEncoder, documents_by_id, token_digest, write_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
FAST = WordEncoder(PATH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.sampled_from(["<|startoftext|>", "it's", "Ñ\ń", "a\tb  c", "É é", "x" * 60, "ABC,", "H\u0331 J\u030c", "h\u0331", "\u212a", "İI", "<|ENDOFTEXT|>"])), max_size=6))
def test_words_give_the_ids_of_the_text(parts):
    texts = [" ".join(parts), "".join(parts), "\n".join(parts)]
    want = [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in FAST.encode(texts)] == want


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet="aszTLDRéßàíÿÀÖ×÷ªµ²\u212b'.,-_=@(|<\u0338\u0301 \n\t19\xa0\x85…šŠİŉ", max_size=25), max_size=5))
def test_marks_and_letters_give_the_ids_of_the_text(texts):
    want = [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in FAST.encode(texts)] == want
    ids, n = FAST.encode_flat(texts)
    assert ids.tolist() == [i for w in want for i in w] and n.tolist() == [len(w) for w in want]


def test_letters_are_letters_of_the_library():
    for c in map(chr, range(0x21, 0x100)):
        for t in (f"a{c}", f"{c}a", f"a{c}.", f"'{c}s", f"A{c}é,"):
            assert np.frombuffer(WordEncoder.encode(FAST, [t])[0], "<u4").tolist() == PLAIN.encode(t, add_special_tokens=False).ids


def test_only_words_with_other_characters_take_all_steps(monkeypatch):
    e, seen = WordEncoder(PATH), []
    monkeypatch.setattr(e, "_whole", lambda words, into: (seen.extend(words), WordEncoder._whole(e, words, into)))
    texts = ["Größe, größe it's IT'S né. (869) ana.bo@mail6.example.com", "größe password=90a4 … und"]
    assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    assert [w for w in seen if w] == ["…"]


def test_a_distinct_word_of_some_texts_is_looked_up_once(monkeypatch):
    e, seen = WordEncoder(PATH), []
    monkeypatch.setattr(e, "_look_up", lambda words: seen.extend(words) or WordEncoder._look_up(e, words))
    e.encode(["The cat, the Cat.", "cat\nTHE cat"] * 50)
    assert sorted(seen) == sorted({"the", "cat", ",", "."})


def brute(rows):
    out, start = [], 0
    for i, t in sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = PLAIN.encode(t, add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark, tmp_path):
    rows = [(i * 37 % 500, f"Text number {i}, it's   long\n" * (i % 17)) for i in range(500)] + [(10**6, "a b " * 200000)]
    write_tokens(make_docs(spark, rows).repartition(6), str(tmp_path / "t"), PATH, 2)
    got = [tuple(r) for r in token_digest(spark, str(tmp_path / "t")).collect()]
    assert sorted(got) == brute(rows)
    found = documents_by_id(spark, str(tmp_path / "t"), [37, 444])
    assert sorted(r.doc_id for r in found.collect()) == [37, 444]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan and "tie" not in plan


def test_awkward_and_empty(spark, tmp_path):
    base = make_docs(spark, AWKWARD).withColumn("ids", F.lit(1)).withColumn("tie", F.lit("clash"))
    write_tokens(base, str(tmp_path / "a"), PATH, 2)
    got = [tuple(r) for r in token_digest(spark, str(tmp_path / "a")).collect()]
    assert sorted(got, key=str) == sorted(brute(AWKWARD), key=str)
    write_tokens(make_docs(spark, []), str(tmp_path / "e"), PATH, 2)
    assert token_digest(spark, str(tmp_path / "e")).count() == 0


def test_memory_is_bounded(monkeypatch):
    import tessera.llm.tokenfiles as m

    monkeypatch.setattr(m, "REMEMBER", 100)
    e = WordEncoder(PATH)
    for i in range(20):
        texts = [" ".join(f"w{i}x{j}" for j in range(40)), "same words again"]
        assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(e.words) + len(e.words.old) <= 200


def test_no_empty_cell_outlives_a_failure(monkeypatch):
    e = WordEncoder(PATH)
    with monkeypatch.context() as m:
        m.setattr(e, "_whole", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            e.encode(["plain words", "né 12"])
    assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(["plain words né 12"])] == [PLAIN.encode("plain words né 12", add_special_tokens=False).ids]


def test_other_steps_before_the_merges_take_whole_words():
    from tokenizers import normalizers

    e = WordEncoder(PATH)
    e.tokenizer.normalizer = normalizers.Sequence([normalizers.NFKC(), normalizers.Lowercase()])
    assert e._takes_parts() is False and WordEncoder(PATH).parts


def test_other_added_tokens_take_whole_words(tmp_path):
    other = Tokenizer.from_file(PATH)
    other.add_special_tokens(["[pad]"])
    other.save(str(tmp_path / "t.json"))
    texts = ["a [pad] b", "x[pad], (it's)."]
    got = WordEncoder(str(tmp_path / "t.json")).encode(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [other.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("text", ["", " ", "\n\n"])
def test_blank_texts(text):
    assert FAST.encode([text]) == [b""]

from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from llm_fixtures import AWKWARD, make_docs
from pyspark.sql import functions as F

from tessera.llm.mixing import mix, mixed_documents, source_targets, split_blocks


@given(st.dictionaries(st.one_of(st.none(), st.text(max_size=3)), st.integers(0, 10**6), max_size=9))
def test_targets_share_and_stop(sizes):
    t = source_targets(sizes, (5, 2, 1), 1.5, 2)
    assert set(t) == set(sizes)
    assert sum(t.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(t[s] <= 2 * sizes[s] * (1 + 1e-9) for s in sizes)


@given(st.lists(st.integers(0, 500), min_size=1, max_size=6), st.integers(1, 9))
def test_tree_keeps_quotas(quotas, shards):
    got = split_blocks(quotas, shards, 3)
    assert got.shape == (shards, len(quotas)) and (got >= 0).all()
    assert got.sum(axis=0).tolist() == quotas
    assert np.ptp(got.sum(axis=1)) <= shards.bit_length()


def test_mix_meets_targets(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 50)), f"s{i % 4}" if i % 9 else None) for i in range(900)]
    got = mix(make_docs(spark, rows).repartition(5), block_words=16).collect()
    size = Counter()
    taken, target = Counter(), {}
    for r in got:
        assert r["size"] == 1 + r.doc_id * 7 % 50
        assert r.taken <= 2 * r["size"] and r.taken == sum(c.words for c in r.copies)
        size[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert target == pytest.approx(source_targets(dict(size), (5, 2, 1), 1.5, 2))
    assert all(r.source_size == size[r.source] for r in got)
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    # shards hold disjoint blocks, and the number of blocks the tree gave them
    blocks = {}
    for r in got:
        for c in r.copies:
            blocks.setdefault((r.source, c.block), set()).add(c.shard)
    assert all(len(x) == 1 for x in blocks.values())
    per = Counter(min(x) for x in blocks.values())
    assert set(per) == set(range(8)) and max(per.values()) <= 2 * min(per.values())
    again = mix(make_docs(spark, rows).repartition(2), block_words=16).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_whole_documents(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 30)), f"s{i % 3}") for i in range(600)]
    base = make_docs(spark, rows).withColumn("copies", F.lit("clash"))
    got = mixed_documents(base)
    assert got.columns == base.columns
    seen = Counter(r.doc_id for r in got.collect())
    assert max(seen.values()) <= 2
    plan = {r.doc_id: len(r.copies) for r in mix(base, whole_documents=True).collect()}
    assert {k: v for k, v in plan.items() if v} == dict(seen)


def test_awkward_and_empty(spark):
    rows = [(*r, None if i % 3 else "s") for i, r in enumerate(AWKWARD)]
    got = mix(make_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    assert sorted(r["size"] for r in got) == sorted(len((r[1] or "").split()) for r in rows)
    assert mix(make_docs(spark, [])).count() == 0
    assert mixed_documents(make_docs(spark, [])).count() == 0


def test_rows_that_share_an_id_are_drawn_apart(spark):
    rows = [(7, "a b c", "s"), (7, "d e f g h", "s"), (None, "i j", "t"), (None, "k l m n", "t"), (1, "o p q r s t", "s")]
    docs = make_docs(spark, rows)
    first, again = (sorted(r.text for r in mixed_documents(docs, share=2.0, max_repeat=2).collect()) for _ in range(2))
    assert first == again and len(set(first)) >= 4 and all(first.count(t) <= 2 for t in first)

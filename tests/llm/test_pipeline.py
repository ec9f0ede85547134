"""The pipeline against plain versions of its stages."""

import importlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import SF0001
from llm_fixtures import AWKWARD, make_docs
from test_decontam import brute as brute_leaks
from test_hyperminhash import plain_set
from tokenizers import Tokenizer

corpus_pipeline = importlib.import_module("corpus_pipeline")
STAGES = dict(corpus_pipeline.STAGES)


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "decontamination", "mixing", "token_output"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage, as the next stage reads them."""
    from tessera.llm.common import saved

    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF0001), "test_" + name)
        out.append(docs)
    return out


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_quality_stage(spark, stages):
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF0001}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    good = [d for d, x in labels.items() if x == (1, 0)]
    bad = [d for d, x in labels.items() if x[0] == 0]
    assert sum(d in kept for d in good) >= 0.95 * len(good) and sum(d in kept for d in bad) <= 0.3 * len(bad)  # 87 ratings in all


def test_dedup_stage(stages):
    """Of each component of links one document stays, by comparing all pairs."""
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    sets = [plain_set(t, 5) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    want = {}
    for i, (d, _) in enumerate(rows):
        want[root(i)] = min(d, want.get(root(i), d))
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(want.values())


def test_decontamination_stage(spark, stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    bad = {d for d, _ in brute_leaks(rows, bench)}
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(d for d, _ in rows if d not in bad)


def test_mixing_stage(stages):
    from tessera.llm.mixing import source_targets

    rows = {r.doc_id: r for r in stages[3].collect()}
    words = lambda r: len((r.text or "").split())
    sizes = Counter()
    for r in rows.values():
        sizes[r.source] += words(r)
    target = source_targets(dict(sizes), (5, 2, 1), 1.5, 2)
    taken, copies = Counter(), Counter()
    for r in stages[4].collect():
        assert tuple(r) == tuple(rows[r.doc_id])
        taken[r.source] += words(r)
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 2
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(words(r) for r in rows.values() if r.source == s)


def test_token_stage(stages):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r.doc_id: plain.encode(r.text or "", add_special_tokens=False).ids + [2] for r in stages[4].collect()}
    at = 0
    for r in sorted(stages[5].collect()):
        x = ids[r.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        at += len(x)


def test_stages_take_awkward_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(5, 1, 0), (4, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (AWKWARD, []):
        make_docs(spark, rows).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        assert corpus_pipeline.run(spark, str(tmp_path)).count() <= 2 * len(rows)

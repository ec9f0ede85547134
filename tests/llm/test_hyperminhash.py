import random

import numpy as np
import pytest
from llm_fixtures import AWKWARD, make_docs
from pyspark.sql import functions as F

from tessera.llm import hyperminhash
from tessera.llm.components import connected_components
from tessera.llm.hyperminhash import BUCKETS, band_keys, least_agreeing, near_duplicates, one_of_each, registers, shingle_sets, short_registers


def plain_set(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(rows, size, percent):
    """doc index -> smallest id of its component, by comparing all pairs."""
    sets = [plain_set(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(d)
    return sorted((str(rows[i][0]), len(sets[i]), str(min((x for x in ids[root(i)] if x is not None), default=None))) for i in range(len(rows)))


def corpus(seed, n=260):
    """Texts of all lengths, exact and near copies in chains, shared passages."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeABé") for _ in range(rnd.randint(1, 4)))
    texts, passage = [], [word() for _ in range(30)]
    while len(texts) < n:
        w = [word() for _ in range(rnd.choice([1, 2, 3, 8, 20, 60, 300]))]
        if rnd.random() < 0.4:
            w = w[:len(w) // 3] + passage + w[len(w) // 3:]
        texts.append(" ".join(w))
        for _ in range(rnd.choice([0, 0, 1, 6])):
            w = list(w)
            for _ in range(rnd.choice([0, 1, 1, 2, len(w) // 15])):
                w[rnd.randrange(len(w))] = word()
            texts.append("  ".join(w))
    rnd.shuffle(texts)
    return list(enumerate(texts[:n]))


@pytest.mark.parametrize("size, percent, seed", [(3, 85, 1), (5, 80, 2)])
def test_components_equal_all_pairs(spark, size, percent, seed):
    rows = corpus(seed)
    got = near_duplicates(make_docs(spark, rows).repartition(5), size, percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_blocks_of_a_key_find_the_same(spark, monkeypatch):
    from tessera.llm import hyperminhash as m

    monkeypatch.setattr(m, "BLOCK_SHINGLES", 60)
    monkeypatch.setattr(m, "BLOCK_MEMBERS", 2)
    rnd, base = random.Random(11), [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):  # a cloud of near copies around the bound
        w = list(base)
        for _ in range(rnd.choice([1, 1, 2, 3])):
            w[rnd.randrange(60)] = rnd.choice("abcdefgh")
        rows.append((i, " ".join(w)))
    got = near_duplicates(make_docs(spark, rows).repartition(3), 3, 85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, 3, 85)


def test_registers_estimate_similarity():
    rnd = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.85, 0.95):
        errors = []
        for _ in range(40):
            u = np.unique(rnd.integers(0, 2**64, 2000, dtype=np.uint64))
            common = int(len(u) * share)
            reg = registers(_two(u, common, rnd))
            a, b = (short_registers(reg[i:i + 1]) for i in (0, 1))
            differ = sum(bin(int(((a[k] ^ b[k]) | (a[k + 2] ^ b[k + 2]))[0]) & (2**64 - 1)).count("1") for k in (0, 1))
            p = 1 - differ / BUCKETS
            errors.append((4 * p - 1) / 3 - common / len(u))
            if share >= 0.85:
                assert BUCKETS - differ >= least_agreeing(0.85)
        assert abs(np.mean(errors)) < 0.03
    assert band_keys(reg).shape == (2, 32)


def _two(u, common, rnd):
    u = rnd.permutation(u)
    half = common + (len(u) - common) // 2
    return [np.sort(u[:half]), np.sort(np.concatenate([u[:common], u[half:]]))]


def test_shingles_are_exact():
    a, b, c, e = shingle_sets(["A b c d", "a B c", "a b", ""], 3)
    assert len(a) == 2 and len(b) == 1 and len(c) == 1 and len(e) == 0
    assert b[0] in a and c[0] not in a


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_large_groups_of_copies(spark):
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base)) for i in range(400)]
    for i in range(400, 800):
        w = list(base)
        w[rnd.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = near_duplicates(make_docs(spark, rows).repartition(4), 3, 85).collect()
    assert len(got) == 800 and {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_awkward_and_empty(spark):
    base = make_docs(spark, AWKWARD).withColumn("node", F.lit("clash")).withColumn("key", F.lit(1))
    got = near_duplicates(base, 3, 85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute([r[:2] for r in AWKWARD], 3, 85)
    kept = one_of_each(base, shingle_words=3, percent=85)
    assert kept.columns == base.columns and kept.count() == len(AWKWARD) - 1
    assert near_duplicates(make_docs(spark, []), 3, 85).count() == 0
    assert one_of_each(make_docs(spark, [])).count() == 0


def test_different_texts_of_one_id_stay(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(40))
    rows = [(None, text("a")), (None, text("b")), (7, text("c")), (7, text("d")), (7, text("d")), (3, text("c") + " more"), (9, text("e")), (None, None), (2, "")]
    left = one_of_each(make_docs(spark, rows)).collect()
    got = sorted((r.doc_id or 0, (r.text or "")[:2]) for r in left)
    assert got == [(0, ""), (0, "a0"), (0, "b0"), (2, ""), (3, "c0"), (7, "d0"), (9, "e0")]


def test_links_of_a_block_are_a_forest():
    a, b = np.nonzero(np.tri(60, k=-1))
    assert hyperminhash._forest(a, b).sum() == 59


@pytest.mark.parametrize("members", [60, 240])
def test_links_grow_with_the_members(spark, monkeypatch, members):
    rnd, seen = random.Random(1), []
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(members):
        w = list(base)
        for _ in range(rnd.randint(1, 14)):
            w[rnd.randrange(120)] = f"x{rnd.randrange(10**6)}"
        rows.append((d, " ".join(w)))
    plain = hyperminhash.connected_components
    monkeypatch.setattr(hyperminhash, "connected_components", lambda links: (seen.append(links.count()), plain(links))[1])
    near_duplicates(make_docs(spark, rows), shingle_words=5, percent=80).count()
    assert max(seen) < 2 * members

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from arrearly.llm import jaccard_join as J


def brute(rows, threshold=0.8):
    sets = [set(s.tolist()) for s in J.shingle_sets([t for _, t in rows])]
    parent = list(range(len(rows)))

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    links = Counter()
    where = {}
    for i, s in enumerate(sets):
        for h in s:
            where.setdefault(h, []).append(i)
    common = Counter(p for own in where.values() for p in combinations(own, 2))
    for (a, b), c in common.items():
        if c >= threshold * (len(sets[a]) + len(sets[b]) - c) - 1e-9:
            links[a] += 1
            links[b] += 1
            parent[max(top(a), top(b))] = min(top(a), top(b))
    members = {}
    for i in range(len(rows)):
        members.setdefault(top(i), []).append(i)
    out = []
    for own in members.values():
        ids = [rows[i][0] for i in own if rows[i][0] is not None]
        out += [(rows[i][0], min(ids) if ids else None, links[i]) for i in own]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def edited(text, *at):
    w = text.split()
    for i in at:
        w[i] = "edit" + str(i)
    return " ".join(w)


def test_small_table_against_brute_force(small):
    docs = small("documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert rows(J.contract(docs)) == want
    assert any(x[2] for x in want)


def test_chains_copies_and_edges(docs_of, words):
    long = words(1, 400)
    chain = [long, edited(long, 40), edited(long, 40, 120, 121, 122, 123, 124, 125, 126, 127, 128, 129, 130), words(77, 400)]
    texts = [(10 + i, t) for i, t in enumerate(chain)]
    texts += [(5, long), (6, long.upper()), (6, long.upper()), (None, long.replace(" ", ",  "))]
    texts += [(30, None), (31, ""), (32, "?!"), (33, "two words"), (34, "Two, words."), (35, "one"), (36, "words two"), (37, words(5, 40000)),
              (38, words(5, 40000) + " more"), (None, None), (None, "lone text of six words here")]
    got = rows(J.contract(docs_of(texts)))
    assert got == brute(texts)
    assert (35, 35, 0) in got and (34, 33, 1) in got and (None, None, 0) in got


def test_chain_whose_ends_differ(docs_of, words):
    a = words(2, 300)
    b = edited(a, *range(10, 40))
    c = edited(b, *range(100, 130))
    sets = J.shingle_sets([a, b, c])
    similarity = [len(np.intersect1d(x, y)) / len(np.union1d(x, y)) for x, y in combinations(sets, 2)]
    assert similarity[0] >= 0.78 and similarity[1] < 0.8
    assert rows(J.contract(docs_of([(1, a), (2, b), (3, c)]))) == brute([(1, a), (2, b), (3, c)])


def test_large_group_of_near_copies(docs_of, words):
    base = words(3, 160)
    texts = [(i, edited(base, (7 * i) % 160, (31 * i + 5) % 160)) for i in range(700)] + [(2000 + i, words(100 + i, 80)) for i in range(50)]
    assert rows(J.contract(docs_of(texts))) == brute(texts)


@pytest.mark.parametrize("size", [5_000])
def test_large_group_in_blocks_and_bands(docs_of, words, monkeypatch, size):
    """A group that falls into many blocks: copies of one page, cut shorter and shorter, so
    that neighbours are linked over many size bands, and edited ones."""
    monkeypatch.setattr(J, "BLOCK_BYTES", size)
    base = words(3, 400)
    texts = [(i, " ".join(base.split()[: 400 - i])) for i in range(0, 280, 2)]
    texts += [(1000 + i, edited(base, (7 * i) % 160, (31 * i + 5) % 160)) for i in range(60)] + [(5000, base), (5001, base)]
    assert rows(J.contract(docs_of(texts))) == brute(texts)


def test_tiles_of_blocks_are_all_pairs():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(23)]
    whole = J.compare(sets, None, 0.4)
    for tile in (1, 4, 23, 50):
        got = np.zeros_like(whole)
        for i, j, m in J.compare_blocks(sets, None, 0.4, tile):
            got[i: i + m.shape[0], j: j + m.shape[1]] |= m
            got[j: j + m.shape[1], i: i + m.shape[0]] |= m.T
        assert (got == whole).all()
        got = np.zeros((9, 14), bool)
        for i, j, m in J.compare_blocks(sets[:9], sets[9:], 0.4, tile):
            got[i: i + m.shape[0], j: j + m.shape[1]] |= m
        assert (got == whole[:9, 9:]).all()


def test_bands_that_never_meet_cannot_be_linked():
    far = J.reach()
    assert far == 3
    for n in range(1, 3000):
        least = int(np.ceil(0.8 * n))  # the smallest set that a set of n can be linked to
        bands = [int(np.floor(np.log(x) / -np.log(J.BAND))) for x in (least, n)]
        assert bands[1] - bands[0] <= far


def test_crowded_branches_of_unlike_documents(docs_of):
    """Pages put together from the same passages (similarity about 0.45), with a
    pair of 0.8 here and there: a pair's branches hold many others too."""
    rng = np.random.default_rng(7)
    slots = 160

    def page(pick):  # a passage is one of two words among four fixed ones, so its five n-grams are its own
        return " ".join(f"a{i} b{i} c{i} d{i} {'xy'[p]}{i}" for i, p in enumerate(pick))

    picks = [(rng.random(slots) < 0.25).astype(int) for _ in range(1000)]
    for k in range(60):
        twin = picks[k].copy()
        at = rng.choice(slots, 17, replace=False)
        twin[at] = 1 - twin[at]
        picks.append(twin)
    m = np.array(picks)
    common = m @ m.T + (1 - m) @ (1 - m).T
    linked = common >= 0.8 * (2 * slots - common)
    np.fill_diagonal(linked, False)
    assert linked.sum() >= 120
    label = J.forest(linked)
    want = {i: (int(label[i]), int(linked[i].sum())) for i in range(len(m))}
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.contract(docs_of([(i, page(p)) for i, p in enumerate(picks)])).collect()}
    assert {i: (got[i], want[i]) for i in want if got[i] != want[i]} == {}


@pytest.mark.parametrize("most", [1, 40])
def test_crowded_links_in_blocks(spark, monkeypatch, most):
    """All cross-group pairs of a branch meet, however it is cut into blocks."""
    monkeypatch.setattr(J, "BRANCH", 7)
    rng = np.random.default_rng(most)
    base = rng.integers(0, 1 << 32, J.TREES * J.DEPTH, dtype=np.uint32)
    sigs = []
    for i in range(60):
        s = rng.integers(0, 1 << 32, J.TREES * J.DEPTH, dtype=np.uint32)
        s[: J.DEPTH] = base[: J.DEPTH]
        sigs.append(s)
    for k in range(20):  # 59-k is like k
        sigs[59 - k] = sigs[k].copy()
        sigs[59 - k][-20:] += np.uint32(1)
    group = [0 if i < most else i for i in range(60)]
    nodes = spark.createDataFrame([(i, bytearray(s.tobytes()), g) for i, (s, g) in enumerate(zip(sigs, group))], "node long, signature binary, label long")
    got = {tuple(sorted((r.a, r.b))) for r in J.crowded_links(nodes, 5, 0.64).collect()}
    assert got == {(k, 59 - k) for k in range(20)}


def test_keep_one(spark, docs_of, words):
    a, b = words(4, 200), words(5, 200)
    texts = [(3, a), (2, edited(a, 50)), (2, edited(a, 50)), (7, b), (None, b), (8, ""), (9, ""), (None, None)]
    docs = docs_of(texts)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()) == sorted([(2, edited(a, 50)), (7, b), (8, ""), (9, "")])
    assert kept.where("doc_id is null").count() == 1
    assert J.keep_one(docs.limit(0)).count() == 0 and J.contract(docs.limit(0)).count() == 0


def test_forest_depth_and_components(spark):
    assert J.stop_depth(0.8, 16, 6, 0.995) == 5
    assert 1 - (1 - 0.8 ** J.stop_depth()) ** J.TREES >= J.RECALL
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90)], "a long, b long")
    got = {r.node: r.label for r in J.components(chain, "t").collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 100: 90}


@pytest.mark.parametrize("seed", range(3))
def test_compare(seed):
    rng = np.random.default_rng(seed)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(12)]
    exact = np.array([[len(np.intersect1d(a, b)) / len(np.union1d(a, b)) >= 0.4 for b in sets] for a in sets])
    np.fill_diagonal(exact, False)
    assert (J.compare(sets, None, 0.4) == exact).all()
    assert (J.compare(sets[:5], sets[5:], 0.4) == exact[:5, 5:]).all()
    label = J.forest(exact)
    assert all(label[a] == label[b] for a, b in zip(*np.nonzero(exact)))

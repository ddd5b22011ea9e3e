from __future__ import annotations

import numpy as np

from arrearly.llm import nearest as N


def brute(rows, k=10):
    rows = [(i, np.array(v, np.float64)) for i, v in rows]
    out = {}
    for q, x in rows:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in rows if i != q and len(v) == len(x))
            out[q] = [(i, s) for s, i in near[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        own = out.setdefault(r.query_id, [])
        own.append((r.vec_id, r.score))
        assert r["rank"] == len(own)
    return out


def test_recall_on_small_table(small):
    emb = small("embeddings")
    want = brute([(r.vec_id, r.embedding) for r in emb.collect()])
    got = found(N.contract(emb))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in near}) for q, near in want.items())
    assert set(got) == set(want) and hits >= 0.9 * sum(map(len, want.values()))
    exact = {i: s for near in want.values() for i, s in near}
    assert all(len(x) == 10 and x == sorted(x, key=lambda y: (y[1], y[0])) for x in got.values()) and exact
    # many small shards and blocks, and certainty: all of them
    rows = N.nearest(emb, emb.where("vec_id % 100 = 0"), confidence=1 - 1e-12, shard_rows=60, block=2)
    assert found(rows) == want


def clustered(n, heads, dim=16, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((heads, dim)) * 20
    return [(i, (centres[i % heads] + rng.standard_normal(dim)).astype(np.float32).tolist()) for i in range(n)]


def test_cells_are_skipped_and_answers_stay(spark, docs_of):
    rows = clustered(4000, 40)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    want = brute([(i, np.array(v, np.float32)) for i, v in rows])
    # cut over a small sample, over all rows, and with a cell that holds several trees
    for kw in (dict(shard_rows=100, sample=500), dict(shard_rows=100), dict(shard_rows=60, cells=20)):
        got = found(N.nearest(df, df.where("vec_id % 100 = 0"), **kw))
        hits = sum(len({i for i, _ in got[q]} & {i for i, _ in near}) for q, near in want.items())
        assert hits >= 0.9 * 400 and set(got) == set(want)
    assert found(N.nearest(df, df.where("vec_id % 100 = 0"), confidence=1 - 1e-12, shard_rows=100)) == want
    # the cells that queries visit besides their own
    candidates = N.valid(df)
    space = N.cells_of(candidates, 100)
    assert list(space) == [16] and space[16].count == 40
    placed = N.in_cells(candidates, space)
    trees = N.index(placed, 100).persist()
    assert trees.count() >= 40 and placed.select("cell").distinct().count() == 40
    asked = placed.where("vec_id % 100 = 0").selectExpr("*", "0D AS bound")
    bounds = spark.createDataFrame([(q, near[-1][1]) for q, near in want.items()], "vec_id long, worst double")
    visited = N.visits(asked, bounds, trees, space, N.stop_ratio()).count()
    trees.unpersist()
    assert visited < 0.5 * 40 * 39, visited  # all would be 40 queries in 39 other cells


def test_cells_part_any_points():
    rng = np.random.default_rng(1)
    for points, most in ((rng.standard_normal((1000, 8)), 16), (np.repeat(rng.standard_normal((3, 8)), 300, axis=0), 8), (np.zeros((50, 8)), 4),
                         (np.zeros((0, 8)), 3), (rng.integers(0, 2, (500, 8)).astype(float), 100)):
        cells = N.Cells(points, most)
        of = cells.of(points)
        assert cells.count <= most and (not len(of) or 0 <= of.min() and of.max() < cells.count)
        _, where = np.unique(points, axis=0, return_inverse=True)
        assert all(len(set(of[where.ravel() == w].tolist())) == 1 for w in set(where.ravel().tolist()))
    assert np.bincount(N.Cells(rng.standard_normal((4096, 8)), 32).of(rng.standard_normal((4096, 8))), minlength=32).min() > 50


def test_copies_over_many_cells_and_infinite_distances(spark, docs_of):
    rows = clustered(600, 6) + [(i, [1.0] * 16) for i in range(1000, 1700)] + [(5000, [1e200] + [0.0] * 15), (5001, [-1e200] + [0.0] * 15), (6000, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = found(N.nearest(df, df.where("vec_id % 100 = 0"), shard_rows=50, block=3))
    assert got[1500] == [(i, 0.0) for i in range(1000, 1010)] and got[1000] == [(i, 0.0) for i in range(1001, 1011)]
    assert 6000 not in got and len(got[5000]) == 10 and all(s == float("inf") for _, s in got[5000])


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    hot = [(i, [1.0, 2.0, 3.0]) for i in range(100, 160)]
    rows = hot + [(0, [1.0, 2.0, 3.5]), (200, [1.0, 2.0, 3.5]), (200, [1.0, 2.0, 3.5]), (7, [0.0, 0.0, 0.0]), (300, None), (8, []), (9, [nan, 1.0, 1.0]),
                  (10, [inf, 1.0, 1.0]), (11, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (400, [5.0, 5.0]), (12, [5.0, 6.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS shard", "2 AS score", "3 AS dim").repartition(4)
    got = found(N.nearest(df, df.where("vec_id % 100 = 0"), shard_rows=10))
    assert got[100] == [(i, 0.0) for i in range(101, 111)]
    assert got[0] == [(200, 0.0)] + [(i, 0.5) for i in range(100, 109)]
    assert got[200] == [(0, 0.0)] + [(i, 0.5) for i in range(100, 109)]
    assert got[400] == [(12, 1.0)] and set(got) == {0, 100, 200, 400}
    assert N.contract(df.limit(0)).count() == 0


def test_chi_square():
    assert abs(N.chi_square_cdf(15.507, 8) - 0.95) < 1e-4
    assert abs(N.stop_ratio(0.95, 8) ** 2 - 15.507) < 1e-2
